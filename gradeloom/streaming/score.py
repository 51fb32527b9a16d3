"""Stateless and windowed grading of a stream of completions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from gradeloom.operators.groups import advantage
from gradeloom.operators.scoring import score_samples
from gradeloom.operators.skew import join_stats
from gradeloom.streaming.folders import different, existing, name_of, read_folders, remove, versions, write_folders

WINDOW = "window_start"
# Folders of the key index: a batch reads those that its keys hash to.
BUCKETS = 256
# After this many batches the folders that a bucket has from each of them become one.
FOLD = 64

_BUCKET, _LEVEL, _BATCH, _AT, _VERSION = "bucket", "level", "batch", "at", "version"
_MOMENTS = [T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType()), T.StructField("m2", T.DoubleType())]


def stream_score(samples: DataFrame, fail: bool = False) -> DataFrame:
    """Score samples as they arrive; the batch operator as it is, append mode, no state.

    The metric `scoring` counts the `scored` and `rejected` rows of every batch; see `BatchCounts`.
    """
    scored = score_samples(samples, fail)
    if fail:
        return scored.observe("scoring", F.count(F.lit(1)).alias("scored"), F.lit(0).cast("long").alias("rejected"))
    rejected = F.count("reject_reason")
    return scored.observe("scoring", (F.count(F.lit(1)) - rejected).alias("scored"), rejected.alias("rejected"))


def _counts(spark: SparkSession, path: str, number: int, **counts: int) -> None:
    """What became of the rows of a batch, one row per batch."""
    row = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts/{name_of(_BATCH, number)}")


def landed_counts(spark: SparkSession, path: str) -> DataFrame:
    """A row for each batch of a landed stream: `batch` and what became of its rows."""
    return spark.read.parquet(f"{path}/counts")


def stream_once(
    samples: DataFrame, unique_by: list[str], path: str, checkpoint: str, buckets: int = BUCKETS, fold: int = FOLD
) -> DataStreamWriter:
    """Land samples in `path`, each key once, however late and in whichever batch it comes again.

    The keys that have landed are indexed by hash in `buckets` folders, and a batch is compared with those of
    its own keys' buckets only, so nothing is dropped for being late, no state has to be held open and a
    batch does not read what earlier batches landed elsewhere. Every `fold` batches the index folders of
    the buckets that a batch reads become one. Which of the copies in one batch stays is open if
    they differ. `landed_once` reads the table, `landed_counts` the delivered, landed and repeated rows of each batch.
    A stream keeps the `buckets` it began with.
    """
    plain = samples.schema
    bucket = F.pmod(F.xxhash64(*unique_by), F.lit(buckets)).cast("int")
    of_index = T.StructType(
        [*[plain[k] for k in unique_by], T.StructField(_BUCKET, T.IntegerType()), T.StructField(_LEVEL, T.IntegerType()), T.StructField(_BATCH, T.LongType())]
    )

    def land(batch: DataFrame, number: int) -> None:
        spark, keys, rows = batch.sparkSession, f"{path}/keys", f"{path}/rows/{name_of(_BATCH, number)}"
        delivered = batch.withColumn("_bucket", bucket).persist()
        try:
            touched = existing(spark, keys, [name_of(_BUCKET, b) for b in different(delivered, "_bucket")])  # `buckets` at most
            seen = read_folders(spark, keys, touched, of_index).where(F.col(_BATCH) < number)
            if number and number % fold == 0:
                seen = _folded(spark, seen, keys, touched, number)
            before = seen.select(*[F.col(k).alias(f"_{k}") for k in unique_by], F.col(_BUCKET).alias("_b"))
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in unique_by]
            first = delivered.dropDuplicates(unique_by).join(before, [F.col("_bucket") == F.col("_b"), *same], "left_anti")
            first.select(*plain.names).write.mode("overwrite").parquet(rows)
            # The index is made from what has just been written, so that rows and keys agree.
            landed = spark.read.schema(plain).parquet(rows)
            indexed = landed.select(*unique_by, bucket.alias(_BUCKET), F.lit(0).alias(_LEVEL), F.lit(number).cast("long").alias(_BATCH))
            write_folders(indexed, keys, [_BUCKET, _LEVEL, _BATCH])
            total, kept = delivered.count(), landed.count()
            _counts(spark, path, number, delivered=total, landed=kept, repeated=total - kept)
        finally:
            delivered.unpersist()

    return samples.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)


def _folded(spark: SparkSession, seen: DataFrame, keys: str, touched: list[str], number: int) -> DataFrame:
    """The index of the touched buckets in one folder each. A folder is removed only after its keys are
    written again, so a batch that breaks off leaves some keys twice, which the index does not mind."""
    last = number - 1
    whole = seen.withColumns({_LEVEL: F.lit(1), _BATCH: F.lit(last).cast("long")})
    write_folders(whole.distinct(), keys, [_BUCKET, _LEVEL, _BATCH])
    for folder in touched:
        for level in versions(spark, f"{keys}/{folder}", _LEVEL):
            for batch in versions(spark, f"{keys}/{folder}/{name_of(_LEVEL, level)}", _BATCH):
                if batch < number and (level, batch) != (1, last):
                    remove(spark, f"{keys}/{folder}/{name_of(_LEVEL, level)}/{name_of(_BATCH, batch)}")
    return read_folders(spark, keys, touched, seen.schema).where(F.col(_BATCH) < number)


def landed_once(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/rows")


def stream_group_advantage(
    scored: DataFrame, ts: str, group: list[str], reward: str, width: str, path: str, checkpoint: str, eps: float = 1e-4,
    windows_per_folder: int = 1,
) -> DataStreamWriter:
    """Land scored rows in `path` and keep their group-normalised advantages per event-time window.

    Rows lie in one folder per window, or per `windows_per_folder` windows that follow each other, and a batch reads
    the folders of its own windows, no others. The size, mean and squared deviations of every group of a window are kept
    too: a batch works them out for its own rows and merges them with those before. With them the rows of the
    touched folders get their advantages, so a late row reopens its window, the last window needs no later event to
    come out, and nothing is held in stream state. A batch and the version before it stay, older versions of a
    folder are removed. Rows without a timestamp form a window of their own. Take more windows to a folder where a
    batch spans many: every folder costs the driver a few file operations. `landed_advantages` reads the
    latest versions, `landed_counts` the landed rows of each batch and those that came late, to a window of an
    earlier batch.
    """
    plain = scored.schema
    of_rows = T.StructType([*plain, T.StructField(WINDOW, T.TimestampType()), T.StructField(_AT, T.LongType()), T.StructField(_BATCH, T.LongType())])
    of_moments = T.StructType([T.StructField(WINDOW, T.TimestampType()), *[plain[g] for g in group], *_MOMENTS, T.StructField(_AT, T.LongType()), T.StructField(_VERSION, T.LongType())])
    keys = [_AT, WINDOW, *group]

    def land(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = _windowed(batch, ts, width, windows_per_folder).withColumn(_BATCH, F.lit(number).cast("long")).persist()
        try:
            write_folders(rows, f"{path}/rows", [_AT, _BATCH])
            names = [name_of(_AT, w) for w in different(rows, _AT)]  # as many as the batch's times span
            old = set(existing(spark, f"{path}/moments", names))
            last = {n: [v for v in versions(spark, f"{path}/moments/{n}", _VERSION) if v < number][-1:] if n in old else [] for n in names}
            known = [f"{n}/{name_of(_VERSION, v)}" for n, vs in last.items() for v in vs]
            before = read_folders(spark, f"{path}/moments", known, of_moments).drop(_VERSION)
            merged = _merged(_moments(rows, keys, reward), before, keys)
            write_folders(merged.withColumn(_VERSION, F.lit(number).cast("long")), f"{path}/moments", [_AT, _VERSION])

            now = read_folders(spark, f"{path}/moments", [f"{n}/{name_of(_VERSION, number)}" for n in names], of_moments)
            again = read_folders(spark, f"{path}/rows", names, of_rows).where(F.col(_BATCH) <= number)
            placed = join_stats(again.drop(_BATCH), now.drop(_VERSION), keys)
            spread = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
            sized = placed.withColumns({"group_mean": F.col("mean"), "group_std": spread}).withColumn(
                "advantage", advantage(F.col(reward), F.col("group_mean"), F.col("group_std"), eps)
            )
            sized = sized.select(*plain.names, WINDOW, "group_mean", "group_std", "advantage", _AT, F.lit(number).cast("long").alias(_VERSION))
            write_folders(sized, f"{path}/advantages", [_AT, _VERSION])

            seen = before.select(F.col(WINDOW).alias("_seen")).distinct()
            late = rows.join(seen, F.col(WINDOW).eqNullSafe(F.col("_seen")), "left_semi").count() if known else 0
            _counts(spark, path, number, landed=rows.count(), late=late)
            for n in [n for n in names if last[n]]:  # the version before stays for readers that are at it
                for table in ("moments", "advantages"):
                    for v in versions(spark, f"{path}/{table}/{n}", _VERSION):
                        if v < last[n][0]:
                            remove(spark, f"{path}/{table}/{n}/{name_of(_VERSION, v)}")
        finally:
            rows.unpersist()

    return scored.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)


def _moments(rows: DataFrame, keys: list[str], reward: str) -> DataFrame:
    r = F.col(reward).cast("double")
    m2 = F.coalesce(F.var_pop(r), F.lit(0.0)) * F.count(r)
    return rows.groupBy(*keys).agg(F.count(r).alias("n"), F.avg(r).alias("mean"), m2.alias("m2"))


def _merged(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Moments of two sets of rows from the moments of each, without a difference of large sums. A group
    without rewards has no mean."""
    both = new.unionByName(old).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("mean"), F.collect_list(F.struct("n", "mean", "m2")).alias("_of")
    )  # two rows of a group at most
    part = lambda m: F.when(m["n"] > 0, m["m2"] + m["n"] * F.pow(m["mean"] - F.col("mean"), 2)).otherwise(0.0)
    return both.withColumn("m2", F.aggregate("_of", F.lit(0.0), lambda a, m: a + part(m))).drop("_of")


def _windowed(batch: DataFrame, ts: str, width: str, per_folder: int) -> DataFrame:
    """Rows with the start of their window and, as seconds, that of their folder's first window. `window` leaves
    rows without a time out; they are put back."""
    window = F.window(ts, width)
    start, end = F.unix_seconds(F.col("_w.start")), F.unix_seconds(F.col("_w.end"))
    span = (end - start) * per_folder
    timed = batch.where(F.col(ts).isNotNull()).withColumn("_w", window)
    timed = timed.withColumns({WINDOW: F.col("_w.start"), _AT: start - F.pmod(start, F.greatest(span, F.lit(1)))}).drop("_w")
    untimed = batch.where(F.col(ts).isNull()).withColumns({WINDOW: F.lit(None).cast("timestamp"), _AT: F.lit(None).cast("long")})
    return timed.unionByName(untimed)


def landed_advantages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of `schema` with `group_mean`, `group_std` and `advantage`, one version of each window."""
    made = [T.StructField(n, T.DoubleType()) for n in ("group_mean", "group_std", "advantage")]
    folders = [T.StructField(_AT, T.LongType()), T.StructField(_VERSION, T.LongType())]
    kind = T.StructType([*schema, T.StructField(WINDOW, T.TimestampType()), *made, *folders])
    rows = spark.read.schema(kind).parquet(f"{path}/advantages")
    # Versions are folder names, two to a folder at most: nothing but these is read to find the latest.
    latest = rows.groupBy(F.col(_AT).alias("_w")).agg(F.max(_VERSION).alias("_v"))
    last = F.col(_AT).eqNullSafe(F.col("_w")) & (F.col(_VERSION) == F.col("_v"))
    return rows.join(latest, last, "left_semi").drop(_AT, _VERSION)
