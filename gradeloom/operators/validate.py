"""Canonical records of each method, and the split of a table into usable and rejected rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.messages import has_unknown_role, n_messages, normalize_messages, reason_of, reject_reason
from gradeloom.operators.conversations import with_whole

REASON = "reject_reason"


def _first_reason(names: list[str]) -> Column:
    return F.coalesce(*[reject_reason(F.col(n)) for n in names])


def with_reject_reason(df: DataFrame, names: list[str], conv: str | None = None) -> DataFrame:
    """Add why the first bad conversation column of a row is not usable, or null.

    With `conv`, rows are parts of conversations (`part`, `n_parts`) and the reason is that of the whole
    conversation, the same for all of its parts.
    """
    if conv is None:
        return df.withColumn(REASON, _first_reason(names))
    facts = {}
    for name in names:
        n, odd = n_messages(F.col(name)), has_unknown_role(F.col(name))
        facts[f"_n_{name}"] = (F.sum(n), n)
        facts[f"_odd_{name}"] = (F.coalesce(F.bool_or(odd), F.lit(False)), odd)
    whole = with_whole(df, facts, conv)
    reasons = [reason_of(F.col(f"_n_{name}"), F.col(f"_odd_{name}")) for name in names]
    return whole.withColumn(REASON, F.coalesce(*reasons)).drop(*facts)


def validate_messages(
    df: DataFrame, names: list[str], observe: str | None = None, conv: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Usable rows, and the rest with a reason; with `conv`, by whole conversations.

    With `observe`, a `DataFrame.observe` metric of that name counts rows and rejections of the
    run that computes the usable rows.
    """
    marked = with_reject_reason(df, names, conv)
    counted = marked
    if observe:
        counted = marked.observe(
            observe, F.count(F.lit(1)).alias("rows"), F.count(F.col(REASON)).alias("rejected")
        )
    good = counted.where(F.col(REASON).isNull()).drop(REASON)
    return good, marked.where(F.col(REASON).isNotNull())


def _canonical(df: DataFrame, names: list[str], mode: str, keep: list[str], extra: list[Column]) -> DataFrame:
    if mode not in ("drop", "fail"):
        raise ValueError(f"unknown validation mode: {mode!r}")
    rows = df if mode == "fail" else df.where(_first_reason(names).isNull())
    clean = [normalize_messages(df, n, fail=mode == "fail").alias(n) for n in names]
    return rows.select(*keep, *clean, *extra)


def normalize_sft(df: DataFrame, mode: str = "fail", keep: list[str] | None = None) -> DataFrame:
    return _canonical(df, ["messages"], mode, keep or [], [])


def normalize_preference(df: DataFrame, mode: str = "fail", keep: list[str] | None = None) -> DataFrame:
    return _canonical(df, ["chosen", "rejected"], mode, keep or [], [])


def normalize_rl_prompt(df: DataFrame, mode: str = "fail", keep: list[str] | None = None) -> DataFrame:
    answer = F.coalesce(F.col("answer").cast("string"), F.lit("None")).alias("answer")
    return _canonical(df, ["prompt"], mode, keep or [], [answer])


def normalize_prompt_only(df: DataFrame, mode: str = "fail", keep: list[str] | None = None) -> DataFrame:
    return _canonical(df, ["prompt"], mode, keep or [], [])
