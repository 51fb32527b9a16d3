"""Canonical Spark schemas, one per training method, and the table schemas around them."""

from pyspark.sql import types as T

# The only roles a conversation may use.
ROLES = ("system", "user", "assistant")

MESSAGE = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)
MESSAGES = T.ArrayType(MESSAGE)

SFT = T.StructType([T.StructField("messages", MESSAGES)])
PREFERENCE = T.StructType([T.StructField("chosen", MESSAGES), T.StructField("rejected", MESSAGES)])
RL_PROMPT = T.StructType([T.StructField("prompt", MESSAGES), T.StructField("answer", T.StringType())])
PROMPT_ONLY = T.StructType([T.StructField("prompt", MESSAGES)])
MATH_RAW = T.StructType([T.StructField("question", T.StringType()), T.StructField("answer", T.StringType())])
CORPUS_RAW = T.StructType([T.StructField("text", T.StringType())])

SAMPLE = T.StructType(
    [
        T.StructField("response", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("metadata", T.StructType([T.StructField("data_source", T.StringType())])),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("method", T.StringType()),
        T.StructField("framework", T.StringType()),
        T.StructField("tuning", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("model_size", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("nodes", T.IntegerType()),
        T.StructField("gpus", T.IntegerType()),
        T.StructField("smoke", T.BooleanType()),
        T.StructField("max_steps", T.IntegerType()),
        T.StructField("project", T.StringType()),
        T.StructField("log_every", T.IntegerType()),
    ]
)
RUN_CONFIG = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
RUN_METRICS = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("step", T.LongType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("ts", T.TimestampType()),
    ]
)
