"""A corpus made ready for training: language, near-duplicates, benchmark leaks, personal data, packing.

Every stage takes what the stage before it kept. All but the last return the columns of `documents`.
A null doc_id is a document like any other; rows that share a doc_id are told apart where a stage has to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm import decontamination, language, packing, pii, simhash
from gradeloom.llm.shared import keep
from gradeloom.sources.readers import read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear stay. Languages are learnt from the `lang` of the rows that are
    not held out; texts without a letter, null ones included, and texts whose margin is narrow go. Texts of any
    length are judged whole, repeated rows alike, and an empty table stays empty."""
    learnt = docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    return language.accepted_rows(docs, language.fit(learnt))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the one with the least doc_id.

    Called with the shingle length and the distance of the operator itself; texts of any length are taken whole, texts
    without words are alike, and an empty table stays empty. A document without a doc_id counts as one with a large id of its own that its text gives. Rows that
    share a doc_id and a text are copies, of which one stays; with different texts each is judged by its own.
    """
    own = F.lit(1 << 62).bitwiseOR(F.pmod(F.xxhash64("text"), F.lit(1 << 61)))
    keyed = docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("long"), own))
    found = simhash.near_duplicates(keyed, key="__key").where(F.col("doc_id") == F.col("component_id"))
    first = keep(found.groupBy(F.col("doc_id").alias("__key")).agg(F.count("*").alias("n")))
    # The list of keepers grows with the documents, so it is never broadcast: one shuffle, at every size.
    single = keyed.join(first.where("n = 1").hint("merge"), "__key", "left_semi").select(*docs.columns)
    shared = keyed.join(first.where("n > 1").hint("merge"), "__key", "left_semi")
    others = [c for c in docs.columns if c != "text"]
    one = shared.groupBy("__key", "text").agg(F.min(F.struct(*others)).alias("m")).select("m.*", "text")
    return single.unionByName(one.select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark stay, null and empty texts among them; each row is judged by its
    own whole text, repeated ones alike. Without a benchmark all rows stay."""
    return decontamination.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the new text. Null and empty texts stay as they are,
    texts of any length are searched whole, and a table without examples has the rules alone."""
    found = docs.withColumn("__found", pii.find(pii.fit(docs)))
    text = found.withColumn("text", pii.redacted("__found.spans")).drop("__found")
    return text.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048 tokens. A null or empty text is one token, a long one many
    pieces; repeated rows are packed as often as they come, and an empty table has no sequences."""
    return packing.pack(
        packing.token_pieces(
            docs,
            public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.path("byte_bpe_50k.tiktoken"),
            public_tokenizers.PATTERN,
        )
    )


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact),
    ("packing", pack),
]

#: Compression, XXH64 fingerprints, fitted trees and tokens are beyond SQL; tests hold brute force against the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
