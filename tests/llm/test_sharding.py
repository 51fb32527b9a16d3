import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.llm.sharding import Feistel, locate, row_at, shard_rows, write_shards


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 97, 1000, 4096, 12_345])
def test_feistel_is_a_permutation_with_an_inverse(n):
    places = Feistel(n, 7).place(np.arange(n))
    assert sorted(places.tolist()) == list(range(n))
    assert Feistel(n, 7).number(places).tolist() == list(range(n))


def test_seed_decides_and_large_numbers_stay_inside():
    numbers = np.arange(1000)
    assert Feistel(1000, 1).place(numbers).tolist() != Feistel(1000, 2).place(numbers).tolist()
    n = 10**12 + 39
    places = Feistel(n, 3).place(np.arange(n - 1000, n))
    assert places.min() >= 0 and places.max() < n and len(set(places.tolist())) == 1000
    with pytest.raises(ValueError):
        Feistel(10, 1).place([10])


def _rows(df):
    return {(r["k"], r["x"]): (r["shard"], r["slot"]) for r in df.collect()}


def test_law_of_rows_in_any_layout(spark):
    df = spark.range(1003).select((F.col("id") * 7919 % 1003).alias("k"), F.col("id").cast("string").alias("x"))
    one = shard_rows(df, ["k", "x"], 16)
    got = one.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m"), F.countDistinct("slot").alias("d")).collect()
    assert len(got) == 16 and max(r["n"] for r in got) - min(r["n"] for r in got) <= 1
    assert all(r["m"] == r["n"] - 1 and r["d"] == r["n"] for r in got)
    assert _rows(one) == _rows(shard_rows(df.repartition(7).orderBy(F.desc("x")), ["k", "x"], 16))
    for r in one.limit(20).collect():
        shard, slot = locate([r["row_number"]], 1003, 16, 42)
        assert (shard[0], slot[0]) == (r["shard"], r["slot"])
        assert row_at(r["shard"], r["slot"], 1003, 16, 42) == r["row_number"]


def test_hot_key_nulls_repeats_clashing_names(spark):
    df = spark.range(300).selectExpr("if(id < 100, 5, if(id < 110, null, id)) k", "'same' x", "9 as shard", "'y' as row_number")
    got = shard_rows(df, ["k", "x"], 7).collect()
    assert len(got) == 300 and len({(r["shard"], r["slot"]) for r in got}) == 300
    assert {r["row_number"] for r in got if r["k"] is None} == set(range(10))


def test_empty_table_and_files(spark, tmp_path):
    df = spark.range(0).selectExpr("id k", "'a' x")
    assert shard_rows(df, ["k"], 4).collect() == []
    some = shard_rows(spark.range(50).selectExpr("id k"), ["k"], 4)
    write_shards(some, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).where("shard = 2").count() == some.where("shard = 2").count()
    with pytest.raises(ValueError):
        shard_rows(df, ["k"], 0)
