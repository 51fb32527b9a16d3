"""Corpus queries."""

from pyspark.sql import DataFrame, SparkSession

from gradeloom.plans.inputs import CORPUS_LINE_SQL, corpus_lines
from gradeloom.sources.adapters import from_corpus
from gradeloom.sources.readers import read_table


def corpus_strip(spark: SparkSession, folder: str) -> DataFrame:
    return from_corpus(corpus_lines(spark, folder))


def corpus_documents(spark: SparkSession, folder: str) -> DataFrame:
    return from_corpus(read_table(spark, folder, "documents"))


def corpus_passthrough(spark: SparkSession, folder: str) -> DataFrame:
    return from_corpus(corpus_lines(spark, folder), drop_blank=False)


_SPACE = "[\\s\\p{Z}\\x{85}]"


def _stripped(source: str) -> str:
    cleaned = f"regexp_replace(coalesce(text, ''), '^{_SPACE}+|{_SPACE}+$', '', 'g')"
    return f"SELECT text FROM (SELECT {cleaned} AS text FROM {source}) WHERE text <> ''"


QUERIES = {
    "corpus_strip": corpus_strip,
    "corpus_documents": corpus_documents,
    "corpus_passthrough": corpus_passthrough,
}

ORACLE = {
    "corpus_strip": _stripped(CORPUS_LINE_SQL),
    "corpus_documents": _stripped("documents"),
    "corpus_passthrough": f"SELECT text FROM {CORPUS_LINE_SQL}",
}
