"""Operators over the completions of one prompt."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gradeloom.operators.skew import HOT_ROWS, crowded_places, replicated, with_salt


def _spread(reward: Column, ddof: int) -> Column:
    if ddof not in (0, 1):
        raise ValueError("ddof must be 0 or 1")
    return F.stddev_samp(reward) if ddof else F.stddev_pop(reward)


def advantage(reward: Column, mean: Column, std: Column, eps: float) -> Column:
    """(reward - mean) / (std + eps); 0 in a group of one or without spread."""
    width = F.coalesce(std, F.lit(0.0)) + F.lit(float(eps))
    return F.when(width == 0.0, F.lit(0.0)).otherwise((reward - mean) / width)


def group_advantage(
    df: DataFrame,
    group: list[str],
    reward: str | Column,
    eps: float = 1e-4,
    ddof: int = 1,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add `group_mean`, `group_std` and `advantage`, the reward normalised within its group.

    `reward` names a column, or is an expression that is added as column `reward`.

    One shuffle of the rows, on (group, salt). Ordinary groups have one salt, and a window gives their
    statistics. Groups of more than `hot_rows` rows, if they are large beside the table as well, have many salts:
    their statistics are aggregated with map-side combine, written out once for every salt and met by the rows
    where these lie already, so no group of any size is in one task. Give `hot_rows=None` where the
    group size is fixed by construction.
    """
    name = reward if isinstance(reward, str) else "reward"
    r = F.col(name)

    def rewarded(rows: DataFrame) -> DataFrame:
        return rows if isinstance(reward, str) else rows.withColumn(name, reward)

    stats = {"group_mean": F.avg(r), "group_std": _spread(r, ddof)}
    if hot_rows is None:
        window = W.partitionBy(*group)
        placed = rewarded(df).withColumns({n: s.over(window) for n, s in stats.items()})
    else:
        crowded = crowded_places(df, group, hot_rows)
        window = W.partitionBy("_group", "_salt")
        rows = rewarded(with_salt(df, group, crowded))
        rows = rows.withColumns({f"_own_{n}": s.over(window) for n, s in stats.items()})
        hot = rewarded(with_salt(df, group, crowded).where(F.col("_salts").isNotNull()))
        of_group = hot.groupBy(*group).agg(*[s.alias(n) for n, s in stats.items()])
        joined = rows.join(replicated(of_group, group, crowded, False), ["_group", "_salt"], "left")
        chosen = {n: F.when(F.col("_salts").isNull(), F.col(f"_own_{n}")).otherwise(F.col(n)) for n in stats}
        placed = joined.withColumns(chosen).select(*rewarded(df).columns, *stats)
    return placed.withColumn("advantage", advantage(r, F.col("group_mean"), F.col("group_std"), eps))


def group_summary(df: DataFrame, group: list[str], reward: str) -> DataFrame:
    """Size, mean and spread per group; `degenerate` groups have equal rewards and teach nothing."""
    r = F.col(reward)
    return df.groupBy(*group).agg(
        F.count(r).alias("n"),
        F.avg(r).alias("reward_mean"),
        F.stddev_samp(r).alias("reward_std"),
        F.min(r).alias("reward_min"),
        F.max(r).alias("reward_max"),
        (F.min(r) == F.max(r)).alias("degenerate"),
    )


def online_preference_pairs(
    df: DataFrame, group: list[str], completion: str = "completion", score: str = "score"
) -> DataFrame:
    """Best and worst completion of each prompt as chosen and rejected; prompts without a difference
    give no pair. Equal scores are settled by the text. Best and worst are kept per task before the
    shuffle, so a prompt with very many completions moves a handful of rows."""
    text, s = F.col(completion), F.col(score)
    ranked = F.struct(s.alias("score"), text.alias("text"))
    best = df.where(s.isNotNull()).groupBy(*group).agg(F.max(ranked).alias("best"), F.min(ranked).alias("worst"))
    return best.where(F.col("best.score") > F.col("worst.score")).select(
        *group,
        F.col("best.text").alias("chosen"),
        F.col("worst.text").alias("rejected"),
        F.col("best.score").alias("chosen_score"),
        F.col("worst.score").alias("rejected_score"),
    )
