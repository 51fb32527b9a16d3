"""Queries that write training files to the shared folder and read them back."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.operators.sampling import mark_split
from gradeloom.plans import chats, corpora
from gradeloom.plans.inputs import MATH_SQL, conversations, math_problems
from gradeloom.schemas import CORPUS_RAW, MATH_RAW, MESSAGES, SAMPLE, SFT
from gradeloom.session import shared_dir
from gradeloom.sinks.writers import write_corpus_jsonl, write_jsonl, write_parquet
from gradeloom.sources.adapters import get_source
from gradeloom.sources.readers import read_dataset

VERL_FILE = T.StructType(
    [
        T.StructField("prompt", MESSAGES),
        T.StructField(
            "reward_model",
            T.StructType([T.StructField("style", T.StringType()), T.StructField("ground_truth", T.StringType())]),
        ),
        T.StructField("data_source", T.StringType()),
    ]
)
SLIME_FILE = T.StructType([T.StructField("prompt", T.StringType()), SAMPLE["label"], SAMPLE["metadata"]])


def sft_parquet_file(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_dir(spark)}/train.parquet"
    layout = ["conv_id", "part", "n_parts"]
    records = get_source("traceinversion")(conversations(spark, folder), keep=layout)
    write_parquet(records, path)
    back = read_dataset(spark, path, schema=T.StructType([*records.select(*layout).schema, *SFT]))
    return back.select(*layout, chats.count_of("messages").alias("n_messages"), chats.flat("messages").alias("text"))


def verl_parquet_file(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_dir(spark)}/train.parquet"
    write_parquet(chats.verl_rows(spark, folder), path)
    back = read_dataset(spark, path, schema=VERL_FILE)
    return back.select(
        chats.flat("prompt").alias("prompt_text"),
        F.col("reward_model.style").alias("style"),
        F.col("reward_model.ground_truth").alias("ground_truth"),
        "data_source",
    )


def slime_jsonl_file(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_dir(spark)}/train.jsonl"
    write_jsonl(chats.slime_rows(spark, folder), path)
    back = read_dataset(spark, path, schema=SLIME_FILE, fmt="json")
    return back.select("prompt", "label", F.col("metadata.data_source").alias("data_source"))


def corpus_jsonl_file(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_dir(spark)}/corpus.jsonl"
    write_corpus_jsonl(corpora.corpus_strip(spark, folder), path)
    return read_dataset(spark, path, schema=CORPUS_RAW, fmt="json")


def dataset_split(spark: SparkSession, folder: str) -> DataFrame:
    """Store raw problems under config and split folders; grade-ready records of one split come back."""
    path = f"{shared_dir(spark)}/math"
    stored = mark_split(math_problems(spark, folder), ["o_orderkey"], 0.1, names=("train", "test"))
    write_parquet(stored.drop("o_orderkey").withColumn("config", F.lit("main")), path, ["config", "split"])
    raw = read_dataset(spark, path, "main", "test", MATH_RAW)
    records = get_source("gsm8k")(raw)
    return records.select(F.element_at("prompt", -1)["content"].alias("question"), "answer")


QUERIES = {
    "sft_parquet_file": sft_parquet_file,
    "verl_parquet_file": verl_parquet_file,
    "slime_jsonl_file": slime_jsonl_file,
    "corpus_jsonl_file": corpus_jsonl_file,
    "dataset_split": dataset_split,
}

ORACLE = {
    "sft_parquet_file": chats.ORACLE["sft_messages"],
    "verl_parquet_file": chats.ORACLE["verl_format"],
    "slime_jsonl_file": chats.ORACLE["slime_format"],
    "corpus_jsonl_file": corpora.ORACLE["corpus_strip"],
    "dataset_split": f"""SELECT question, CAST(whole AS VARCHAR) AS answer FROM {MATH_SQL}
        WHERE substr(md5('42:' || o_orderkey), 1, 8) < '19999999'""",
}
