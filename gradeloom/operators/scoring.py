"""Grading as one projection: no shuffle, rows in equal rows out."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.functions.rewards import completion_text, reward_components, score_by_source, scorer_names

UNSCORED = "no reward scorer for data_source"


EMPTY_COMPLETION = "empty completion"


def score_completions(
    df: DataFrame, task: str, completion: str = "completion", gold: str = "answer", fail: bool = True
) -> DataFrame:
    """Add one column per reward of the task and `reward_total`, their sum.

    A completion without messages fails the job, or with `fail=False` scores null with a `reject_reason`.
    """
    text, answer = completion_text(df, completion, fail), F.col(gold)
    empty = F.lit(False)
    if not fail and isinstance(df.schema[completion].dataType, T.ArrayType):
        empty = F.coalesce(F.size(completion) <= 0, F.lit(True))
    parts = {name: build(text, answer) if fail else F.when(~empty, build(text, answer)) for name, build in reward_components(task).items()}
    total = sum(list(parts.values())[1:], start=list(parts.values())[0])
    scored = df.withColumns({**parts, "reward_total": total})
    return scored if fail else scored.withColumn("reject_reason", F.when(empty, EMPTY_COMPLETION))


def score_routed(
    df: DataFrame,
    data_source: str = "data_source",
    solution: str = "solution_str",
    gold: str = "ground_truth",
    fail: bool = True,
) -> DataFrame:
    """Add `score` by the scorer that each row's data source names.

    An unknown source fails the job, or with `fail=False` scores null with a `reject_reason`.
    """
    source = F.col(data_source)
    scored = df.withColumn("score", score_by_source(source, F.col(solution), F.col(gold), fail))
    if fail:
        return scored
    why = F.concat(F.lit(f"{UNSCORED}: "), F.coalesce(source, F.lit("null")))
    known = F.coalesce(source.isin(*scorer_names()), F.lit(False))
    return scored.withColumn("reject_reason", F.when(~known, why))


def score_samples(df: DataFrame, fail: bool = True) -> DataFrame:
    """Score `(response, label, metadata.data_source)`; a row without metadata has no known source."""
    routed = df.withColumn("_source", F.col("metadata")["data_source"])
    return score_routed(routed, "_source", "response", "label", fail).drop("_source")
