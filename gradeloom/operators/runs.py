"""Comparison of training runs from tables of settings and metrics."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gradeloom.functions import runs as R
from gradeloom.operators.skew import BROADCAST_ROWS, lookup

# Column of whatever is not in a list of methods or frameworks.
OTHER = "other"

# Settings in which runs of one method may differ.
FREE_KEYS = ("framework", "tuning", "image", "scale.nodes", "scale.gpus")


def describe_runs(runs: DataFrame, prefix: str = "runs", smoke_project: str | None = None) -> DataFrame:
    """Name, scale, labels, project and logging interval of each run."""
    return runs.select(
        "run_id",
        R.run_name().alias("run_name"),
        R.tier().alias("tier"),
        R.tags().alias("tags"),
        R.is_smoke().alias("is_smoke"),
        R.project(prefix, smoke_project).alias("project"),
        R.log_every().alias("log_every"),
    )


def measured_only(runs: DataFrame) -> DataFrame:
    """Runs that measure something: smoke runs left out."""
    return runs.where(~R.is_smoke())


def log_thin(metrics: DataFrame, runs: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Metric rows at step 1 and at every multiple of the run's logging interval."""
    every = runs.select("run_id", R.log_every().alias("_every"))
    joined = lookup(metrics, every, "run_id", "inner", broadcast_rows)
    return joined.where(R.is_logged(F.col("step"), F.col("_every"))).drop("_every")


def coverage_matrix(runs: DataFrame, methods: tuple[str, ...] = R.METHODS) -> DataFrame:
    """Per framework and method, the tunings that runs exist for: `full|lora`, `full`, `lora`, `none`.

    Pretraining trains all parameters by definition. Methods that are not listed share the column `other`.
    """
    method = F.coalesce(F.col("method"), F.lit("sft"))
    method = F.when(method.isin(*methods), method).otherwise(F.lit(OTHER))
    tuning = F.when(method == "pretrain", "full").otherwise(F.coalesce(F.col("tuning"), F.lit("full")))

    def label(name: str):
        full = F.max((method == name) & (tuning == "full"))
        lora = F.max((method == name) & (tuning == "lora"))
        return (
            F.when(full & lora, "full|lora").when(full, "full").when(lora, "lora").otherwise("none").alias(name)
        )

    return runs.groupBy("framework").agg(*[label(m) for m in (*methods, OTHER)])


def metric_overlay(
    metrics: DataFrame,
    runs: DataFrame,
    frameworks: tuple[str, ...] = R.FRAMEWORKS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per (method, metric, step) with the mean of each framework side by side. Frameworks that
    are not listed, and runs without one, share the column `other`."""
    listed = F.when(F.col("framework").isin(*frameworks), F.col("framework")).otherwise(F.lit(OTHER))
    labels = runs.select("run_id", F.coalesce(F.col("method"), F.lit("sft")).alias("method"), listed.alias("framework"))
    joined = lookup(metrics, labels, "run_id", "inner", broadcast_rows)
    columns = [*frameworks, OTHER]
    return joined.groupBy("method", "metric", "step").pivot("framework", columns).agg(F.avg("value"))


def percentile_name(p: float) -> str:
    """`p50` for 0.5, `p99_9` for 0.999."""
    return "p" + f"{round(p * 100, 9):.12g}".replace(".", "_")


def metric_percentiles(
    metrics: DataFrame,
    runs: DataFrame,
    points: tuple[float, ...] = (0.5, 0.95),
    pieces: int = 256,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Exact percentiles of each metric per (method, framework): the least value that the share `p` of the
    group's values does not exceed. Nulls do not count.

    Groups may be of any size. A mergeable sketch gives splitters that cut a group into about `pieces`
    pieces, the pieces are counted exactly, and only the pieces in which a percentile falls are ranked: equal
    values are counted before they are, so a value that is most of a group is one row.
    """
    labels = runs.select("run_id", F.coalesce(F.col("method"), F.lit("sft")).alias("method"), "framework")
    joined = lookup(metrics, labels, "run_id", "inner", broadcast_rows)
    group = ["method", "framework", "metric"]
    known = joined.select(*group, "value").where(F.col("value").isNotNull())
    counted = known.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("c"))
    cuts = F.percentile_approx("value", [i / pieces for i in range(1, pieces)], 10 * pieces)
    splitters = known.groupBy(*group).agg(F.array_distinct(cuts).alias("cuts"), F.count(F.lit(1)).alias("n"))

    def renamed(df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed({c: f"_{c}" for c in group})

    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group])

    # A piece is named by the number of splitters below it.
    piece = F.size(F.filter("cuts", lambda c: c < F.col("value")))
    placed = counted.join(renamed(splitters), same).select(*group, "value", "c", "n", piece.alias("piece"))
    sizes = placed.groupBy(*group, "n", "piece").agg(F.sum("c").alias("size"))
    before = W.partitionBy(*group).orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.ceil(F.lit(p) * F.col("n")).alias("place")) for i, p in enumerate(points)]))
    asked = sizes.select(*group, "n", "piece", "before", "size", wanted.alias("w")).select(
        *group, "n", "piece", "before", F.col("w.i").alias("i"), F.greatest("w.place", F.lit(1)).alias("place"), "size"
    )
    asked = asked.where((F.col("before") < F.col("place")) & (F.col("place") <= F.col("before") + F.col("size")))
    asked = renamed(asked).select(*[f"_{c}" for c in group], F.col("piece").alias("_piece"), "before", "i", "place")
    met = placed.join(asked, same & (F.col("piece") == F.col("_piece")))
    up_to = W.partitionBy(*group, "i").orderBy("value")
    reached = met.withColumn("up_to", F.col("before") + F.sum("c").over(up_to)).where(F.col("up_to") >= F.col("place"))
    found = reached.groupBy(*group, "n").agg(
        *[F.min(F.when(F.col("i") == i, F.col("value"))).alias(percentile_name(p)) for i, p in enumerate(points)]
    )
    return found.select(*group, "n", *[percentile_name(p) for p in points])


def control_audit(
    run_config: DataFrame,
    runs: DataFrame,
    free_keys: tuple[str, ...] = FREE_KEYS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Settings that should be pinned but take several values among runs of one method and tuning."""
    labels = runs.select(
        "run_id",
        F.coalesce(F.col("method"), F.lit("sft")).alias("method"),
        F.coalesce(F.col("tuning"), F.lit("full")).alias("tuning"),
    )
    pinned = run_config.where(~F.col("key").isin(*free_keys))
    joined = lookup(pinned, labels, "run_id", "inner", broadcast_rows)
    counted = joined.groupBy("method", "tuning", "key").agg(F.count_distinct("value").alias("n_values"))
    return counted.where(F.col("n_values") > 1)


def offline_online_diff(
    metrics: DataFrame,
    runs: DataFrame,
    offline: str = "dpo",
    online: str = "online_dpo",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Mean of a metric at a step under two methods, and online minus offline, where both exist.

    Both sides come from one aggregation rather than a join of two.
    """
    labels = runs.where(F.col("method").isin(offline, online)).select("run_id", "method")
    joined = lookup(metrics, labels, "run_id", "inner", broadcast_rows)
    sides = joined.groupBy("metric", "step").pivot("method", [offline, online]).agg(F.avg("value"))
    both = F.col(offline).isNotNull() & F.col(online).isNotNull()
    return sides.where(both).withColumn("diff", F.col(online) - F.col(offline))
