"""Streaming queries: run over all files that are there, write to the shared folder, read back."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from gradeloom.plans.grading import ORACLE as GRADING
from gradeloom.plans.grading import sample_rows
from gradeloom.plans.inputs import ROLLOUT, derive
from gradeloom.session import shared_dir
from gradeloom.sources.readers import read_table
from gradeloom.streaming.score import (
    landed_advantages,
    landed_once,
    stream_group_advantage,
    stream_once,
    stream_score,
)

# Files of one micro-batch.
FILES = 1000


def read_stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The table as a stream of files, some at a time. A file source wants a folder or, as here, a glob."""
    schema = read_table(spark, folder, table).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES).parquet(f"{folder.rstrip('/')}/{table}.parquet*")


def run_to_end(stream: DataFrame, path: str) -> DataFrame:
    """Process what has arrived, then stop; the written table is the result."""
    spark = stream.sparkSession
    writer = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    query = writer.option("checkpointLocation", f"{path}/checkpoint").start(f"{path}/table")
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def score_stream(spark: SparkSession, folder: str) -> DataFrame:
    samples = sample_rows(derive(read_stream(spark, folder, "lineitem"), ROLLOUT))
    scored = stream_score(samples).select("prompt_id", "sample_no", "score", "reject_reason")
    return run_to_end(scored, shared_dir(spark))


def run_writer(writer: DataStreamWriter) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return read_stream(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value"
    )


def group_advantage_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Groups are a user's events of one hour; every event comes out."""
    events, path = _events(spark, folder), shared_dir(spark)
    writer = stream_group_advantage(
        events, "ts", ["user_id"], "value", "1 hour", f"{path}/table", f"{path}/checkpoint", windows_per_folder=7 * 24
    )
    run_writer(writer)
    done = landed_advantages(spark, f"{path}/table", events.schema)
    return done.select("event_id", "user_id", F.round("group_mean", 6).alias("group_mean"), F.round("advantage", 6).alias("advantage"))


def delivered_once_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives twice; the second copy is dropped."""
    twice = _events(spark, folder).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    path = shared_dir(spark)
    run_writer(stream_once(twice, ["event_id"], f"{path}/table", f"{path}/checkpoint", buckets=16))
    return landed_once(spark, f"{path}/table", twice.schema).select("event_id", "user_id", "value")


QUERIES = {
    "stream_score": score_stream,
    "stream_group_advantage": group_advantage_stream,
    "stream_once": delivered_once_stream,
}

_HOURLY = "date_trunc('hour', ts)"

ORACLE = {
    "stream_score": GRADING["score_samples"],
    "stream_group_advantage": f"""SELECT event_id, user_id, round(avg(value) OVER w, 6) AS group_mean,
        round(CASE WHEN count(*) OVER w = 1 THEN 0.0
        ELSE (value - avg(value) OVER w) / (stddev_samp(value) OVER w + 0.0001) END, 6) AS advantage
        FROM events WINDOW w AS (PARTITION BY user_id, {_HOURLY})""",
    "stream_once": "SELECT event_id, user_id, value FROM events",
}
