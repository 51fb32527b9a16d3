"""Readers and writers."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.schemas import CORPUS_RAW, MATH_RAW
from gradeloom.session import shared_dir
from gradeloom.sinks.writers import write_corpus_jsonl, write_jsonl, write_parquet
from gradeloom.sources.adapters import from_corpus
from gradeloom.sources.readers import read_dataset


def test_reading_one_split_prunes_the_others(spark, tmp_path):
    rows = [("main", s, f"q{i}", "#### 1") for s in ("train", "test") for i in range(4)]
    df = spark.createDataFrame(rows, "config string, split string, question string, answer string")
    write_parquet(df, str(tmp_path / "d"), ["config", "split"])
    part = read_dataset(spark, str(tmp_path / "d"), "main", "test", MATH_RAW)
    assert part.columns == ["question", "answer"] and part.count() == 4
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "split" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert read_dataset(spark, str(tmp_path / "d"), split="train").columns == ["question", "answer", "config"]
    with pytest.raises(ValueError):
        read_dataset(spark, str(tmp_path / "d"), fmt="csv")


class _Stub:
    """A session of a cluster that names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)


def test_cluster_needs_a_shared_folder(spark):
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark) != shared_dir(spark)
    with pytest.raises(RuntimeError):
        shared_dir(_Stub)


def lines(path):
    return [json.loads(x) for f in Path(path).glob("part-*") for x in f.read_text("utf-8").splitlines()]


def test_jsonl_keeps_nulls_and_letters(spark, tmp_path):
    df = spark.createDataFrame([("é\n日", None)], "prompt string, label string")
    write_jsonl(df, str(tmp_path / "j"), files=1)
    assert lines(tmp_path / "j") == [{"prompt": "é\n日", "label": None}]
    assert "é" in next(Path(tmp_path / "j").glob("part-*")).read_text("utf-8")


def test_corpus(spark, tmp_path):
    raw = spark.createDataFrame([("  a b \n",), (None,), (" \t \x1c",), ("",), ("c",)], CORPUS_RAW)
    write_corpus_jsonl(from_corpus(raw), str(tmp_path / "c"))
    assert sorted(x["text"] for x in lines(tmp_path / "c")) == ["a b", "c"]
    assert from_corpus(raw, drop_blank=False).count() == 5
    assert from_corpus(raw.withColumn("more", F.lit(1))).columns == ["text"]


def test_a_broken_line_is_not_lost(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"text": "one"}\n{"text": bad\n{"text": "two"}\n')
    with pytest.raises(Exception):
        read_dataset(spark, str(tmp_path / "in"), schema=CORPUS_RAW, fmt="json").collect()
    aside = T.StructType([*CORPUS_RAW, T.StructField("_corrupt_record", T.StringType())])
    rows = read_dataset(spark, str(tmp_path / "in"), schema=aside, fmt="json", mode="PERMISSIVE").collect()
    assert [(r["text"], r["_corrupt_record"]) for r in rows] == [("one", None), (None, '{"text": bad'), ("two", None)]
