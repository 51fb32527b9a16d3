"""Samples, orders, batches and splits: exact, and the same however the rows are laid out."""

import hashlib

import pytest
from pyspark.sql import functions as F

from gradeloom.operators import sampling as S


def digest(*parts):
    return hashlib.md5(":".join(str(p) for p in parts).encode()).hexdigest()


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))


def test_epoch_order_is_a_seeded_permutation(keyed):
    for epoch in (0, 1):
        wanted = {k: i for i, k in enumerate(sorted(range(5000), key=lambda k: digest(42, epoch, k)))}
        for parts in (1, 7, 200):
            rows = S.epoch_order(keyed.repartition(parts), ["k"], 42, epoch).collect()
            assert {r["k"]: r["pos"] for r in rows} == wanted
            assert all(r["v"] == 2 * r["k"] for r in rows)


@pytest.mark.parametrize("prefix", [1, 2, 4])
def test_bucket_width_does_not_matter(keyed, prefix):
    narrow = S.epoch_order(keyed, ["k"], 7, 0, prefix=prefix).select("k", "pos").collect()
    assert sorted(narrow) == sorted(S.epoch_order(keyed, ["k"], 7).select("k", "pos").collect())


def test_order_with_copies(spark):
    # One key holds a third of all rows.
    rows = [(i,) for i in range(200)] + [(7,)] * 100
    df = spark.createDataFrame(rows, "k long").repartition(6)
    got = S.epoch_order_with_copies(df, ["k"], 5, chunk=9).collect()
    ordered = sorted((k for (k,) in rows), key=lambda k: (digest(5, 0, k), k))
    assert [r["k"] for r in sorted(got, key=lambda r: r["pos"])] == ordered
    assert sorted(r["pos"] for r in got) == list(range(300))


@pytest.mark.parametrize("n", [1, 64, 999, 4999, 5000, 9000])
@pytest.mark.parametrize("top_rows", [0, 10_000])
def test_subsample(keyed, n, top_rows):
    wanted = set(sorted(range(5000), key=lambda k: digest(42, k))[:n])
    got = S.subsample_exact(keyed.repartition(5), n, ["k"], 42, prefix=2, top_rows=top_rows).collect()
    assert len(got) == len(wanted) and {r["k"] for r in got} == wanted


@pytest.mark.parametrize("n", [5, 40, 100, 149, 150, 151])
def test_subsample_where_rows_share_keys(spark, n):
    # Null and repeated keys, one of them with a third of all rows.
    rows = [(None if i % 10 == 1 else (7 if i % 3 == 0 else i // 2), i) for i in range(150)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(4)
    got = S.subsample_exact(df, n, ["k"], 42, prefix=1, top_rows=0).collect()
    hashed = sorted(digest(42, "" if k is None else k) for k, _ in rows)
    assert len(got) == len({r["v"] for r in got}) == min(n, 150)
    mine = sorted(digest(42, "" if r["k"] is None else r["k"]) for r in got)
    assert mine == hashed[: len(got)]


def test_no_limit_means_everything(keyed):
    assert S.subsample_exact(keyed, None, ["k"]).count() == S.subsample_exact(keyed, 0, ["k"]).count() == 5000


def test_resume_and_batches(keyed):
    ordered = S.epoch_order(keyed, ["k"], 1)
    assert S.resume_from(ordered, 4990).count() == 10
    planned = S.batch_plan(ordered, 64).collect()
    assert all(r["pos"] == r["step"] * 64 + r["slot"] and 0 <= r["slot"] < 64 for r in planned)
    whole = S.batch_plan(ordered, 64, total=5000, drop_last=True)
    assert whole.count() == 5000 // 64 * 64
    with pytest.raises(ValueError):
        S.batch_plan(ordered, 64, drop_last=True)


def test_batch_arithmetic():
    assert S.global_batch(2, 8, gpus=8, nodes=2) == 256
    assert S.global_batch(8, 4, gpus=8) == 256
    assert S.rollout_batch(32, 8) == 256
    assert S.mini_batch(None, 32) == 32 and S.mini_batch(64, 32) == 32 and S.mini_batch(16, 32) == 16
    assert S.train_steps(15000, 64) == 234 and S.train_steps(3, 64) == 1


def test_group_expansion(keyed):
    got = S.prompt_group_expand(keyed.limit(3), 8).groupBy("k").agg(F.sort_array(F.collect_list("sample_no")).alias("s"))
    assert [r["s"] for r in got.collect()] == [list(range(8))] * 3


def test_length_budget(spark):
    df = spark.createDataFrame([("a b c",), ("a",)], "t string")
    words = S.length_budget(df, F.size(F.split("t", " ")), 2)
    assert [r["t"] for r in words.collect()] == ["a"]
    flags = S.length_budget(df, F.length("t"), 2, flag_only=True).collect()
    assert [(r["length"], r["within_budget"]) for r in flags] == [(5, False), (1, True)]


def test_split(keyed):
    train, validation = S.split_train_validation(keyed, ["k"], 0.1, 3)
    a, b = {r["k"] for r in train.collect()}, {r["k"] for r in validation.collect()}
    assert not a & b and len(a | b) == 5000 and 400 < len(b) < 600
    again = S.split_train_validation(keyed.repartition(9), ["k"], 0.1, 3)[1]
    assert {r["k"] for r in again.collect()} == b
    same = S.split_train_validation(keyed, ["k"], 0.1, val_equals_train=True)
    assert [s.count() for s in same] == [5000, 5000]
    for fraction, n in ((0.0, 0), (1.0, 5000)):
        assert S.split_train_validation(keyed, ["k"], fraction)[1].count() == n


def uneven(spark):
    rows = [(0 if i % 3 == 0 else i, i % 50 if i % 3 == 0 else i) for i in range(60_00)]
    return spark.createDataFrame(rows, "key long, x long")


@pytest.mark.parametrize("n", [1, 1500, 2000, 2500, 5999, 6000, 9000])
def test_sample_with_repeated_keys_is_the_same_in_any_layout(spark, n):
    df = uneven(spark)
    layouts = [df, df.repartition(3, "x"), df.orderBy(F.desc("key"), "x").coalesce(1)]
    got = [sorted(map(tuple, S.subsample_exact(d, n, ["key"], top_rows=0).collect())) for d in layouts]
    assert len(got[0]) == min(n, 6000) and got[0] == got[1] == got[2]
    assert got[0] == sorted(map(tuple, S.subsample_exact(df, n, ["key"]).collect()))


def test_sample_of_equal_rows(spark):
    df = spark.createDataFrame([(1, "a")] * 300, "key long, x string")
    assert S.subsample_exact(df, 123, ["key"], top_rows=0).collect() == df.limit(123).collect()
    plan = S.subsample_exact(df, 123, ["key"], top_rows=0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1  # one row, to be written out again


def test_hot_keys_that_are_broadcast_are_bounded(spark, monkeypatch):
    from gradeloom.operators import skew

    monkeypatch.setattr(skew, "HOT_KEYS", 3)
    df = spark.range(1000).selectExpr("id % 20 as k", "id")
    ordinary, hot = skew.split_hot(df, ["k"], hot_rows=10)
    assert hot.select("k").distinct().count() == 3 and ordinary.count() + hot.count() == 1000
    wide = spark.range(20).selectExpr("id as k", "repeat('x', 1000) as w")
    for limit in (10, 1 << 30):
        joined = skew.lookup(df, wide, "k", hot_rows=10, broadcast_bytes=limit)
        assert joined.count() == 1000 and joined.select("w").distinct().count() == 1
