"""Group statistics, pairs and advantages against brute force, with one group of a third of all rows."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from gradeloom.operators import groups as G
from gradeloom.operators import skew
from gradeloom.operators.gae import gae


@pytest.fixture(scope="module")
def rewards(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        group = 0 if i % 3 == 0 else (None if i % 50 == 1 else rng.randint(1, 90))
        rows.append((i, group, rng.choice([0.0, 0.1, 1.0, 1.1]), f"t{rng.randint(0, 40)}"))
    return rows, spark.createDataFrame(rows, "id long, g long, r double, text string").repartition(5)


def by_group(rows):
    found = {}
    for i, g, r, text in rows:
        found.setdefault(g, []).append((i, r, text))
    return found


@pytest.mark.parametrize("hot_rows", [None, 1_000_000, 50, 1])
@pytest.mark.parametrize("ddof", [0, 1])
def test_group_advantage(rewards, hot_rows, ddof):
    rows, df = rewards
    got = {r["id"]: r["advantage"] for r in G.group_advantage(df, ["g"], "r", ddof=ddof, hot_rows=hot_rows).collect()}
    assert len(got) == len(rows)
    for members in by_group(rows).values():
        values = [r for _, r, _ in members]
        std = 0.0 if len(values) == 1 else (statistics.stdev if ddof else statistics.pstdev)(values)
        for i, r, _ in members:
            assert got[i] == pytest.approx((r - statistics.fmean(values)) / (std + 1e-4), abs=1e-9)


def test_reward_given_as_an_expression(rewards):
    _, df = rewards
    named = G.group_advantage(df, ["g"], "r", hot_rows=50).select("id", "advantage").collect()
    made = G.group_advantage(df, ["g"], F.col("r") * 1.0, hot_rows=50).select("id", "advantage").collect()
    assert sorted(named) == sorted(made)


def test_no_group_is_in_one_task(spark):
    """A group with one row in 20,000, far from the largest that a short list of groups would name."""
    df = spark.range(1_000_000).select(F.when(F.col("id") % 20_000 == 0, -1).otherwise(F.col("id")).alias("g"), F.lit(1.0).alias("r"))
    crowded = skew.crowded_places(df, ["g"], hot_rows=20)
    assert [r["_salts"] for r in crowded.collect()] == [5]
    salted = skew.with_salt(df, ["g"], crowded).where("g = -1").agg(F.count_distinct("_salt"), F.count("*")).first()
    assert salted[0] >= 4 and salted[1] == 50
    got = G.group_advantage(df, ["g"], "r", hot_rows=20).where("g = -1").agg(F.count("*"), F.min("group_mean"), F.max("group_std")).first()
    assert tuple(got) == (50, 1.0, 0.0)


def test_statistics_reach_rows_of_all_groups(rewards):
    rows, df = rewards
    stats = df.groupBy("g").agg(F.max("r").alias("top"))
    for hot_rows in (5, 100, 10_000):
        got = {r["id"]: r["top"] for r in skew.join_stats(df, stats, ["g"], hot_rows).collect()}
        assert got == {i: max(r for _, r, _ in members) for members in by_group(rows).values() for i, _, _ in members}


def test_no_spread_and_no_eps(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.5), (2, 1.0)], "g long, r double")
    assert [r["advantage"] for r in G.group_advantage(df, ["g"], "r", eps=0.0).collect()] == [0.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        G.group_advantage(df, ["g"], "r", ddof=2)


def test_group_summary(rewards):
    rows, df = rewards
    got = {r["g"]: r for r in G.group_summary(df, ["g"], "r").collect()}
    for g, members in by_group(rows).items():
        values = [r for _, r, _ in members]
        row = got[g]
        assert (row["n"], row["reward_min"], row["reward_max"]) == (len(values), min(values), max(values))
        assert row["degenerate"] == (min(values) == max(values))


def test_pairs(rewards):
    rows, df = rewards
    got = {r["g"]: (r["chosen"], r["rejected"]) for r in G.online_preference_pairs(df, ["g"], "text", "r").collect()}
    wanted = {}
    for g, members in by_group(rows).items():
        ranked = sorted((r, text) for _, r, text in members)
        if ranked[0][0] < ranked[-1][0]:
            wanted[g] = (ranked[-1][1], ranked[0][1])
    assert got == wanted


def plain_gae(rewards, values, gamma, lam):
    out, carried = [], 0.0
    for t in reversed(range(len(rewards))):
        after = values[t + 1] if t + 1 < len(values) else 0.0
        carried = rewards[t] + gamma * after - values[t] + gamma * lam * carried
        out.append(carried)
    return out[::-1]


@pytest.mark.parametrize("gamma, lam", [(1.0, 1.0), (0.99, 0.95), (0.5, 0.5), (1.0, 0.0), (0.0, 1.0)])
@pytest.mark.parametrize("chunk", [1, 5, 16, 4096])
def test_gae(spark, gamma, lam, chunk):
    rng = random.Random(9)
    data = {k: [(rng.random(), rng.random()) for _ in range(n)] for k, n in [(1, 1), (2, 5), (3, 33), (4, 170), (5, 16)]}
    rows = [(k, t, r, v) for k, steps in data.items() for t, (r, v) in enumerate(steps)]
    df = spark.createDataFrame(rows, "k long, step long, reward double, value double").repartition(3)
    got = {(r["k"], r["step"]): r for r in gae(df, ["k"], gamma=gamma, lam=lam, chunk=chunk).collect()}
    assert len(got) == len(rows)
    for k, steps in data.items():
        wanted = plain_gae([r for r, _ in steps], [v for _, v in steps], gamma, lam)
        for t, a in enumerate(wanted):
            assert got[k, t]["advantage"] == pytest.approx(a, abs=1e-9)
            assert got[k, t]["value_target"] == pytest.approx(a + steps[t][1], abs=1e-9)


@pytest.mark.parametrize("fan", [2, 3, 100])
def test_gae_over_many_chunks(spark, fan):
    rows = [("a", i, float(i % 5), float(i % 3)) for i in range(40)] + [("b", i, 1.0, 0.0) for i in range(333)]
    df = spark.createDataFrame(rows, "k string, step long, reward double, value double")
    for gamma in (1.0, 0.9):
        got = {(r["k"], r["step"]): r["advantage"] for r in gae(df, ["k"], gamma=gamma, chunk=8, fan=fan).collect()}
        for k in "ab":
            steps = [(r[2], r[3]) for r in rows if r[0] == k]
            wanted = plain_gae([r for r, _ in steps], [v for _, v in steps], gamma, 1.0)
            assert [got[k, i] for i in range(len(steps))] == pytest.approx(wanted)
    assert gae(df.limit(0), ["k"]).count() == 0


@pytest.mark.parametrize("steps, chunk", [([0, 1, 1, 4, 4], c) for c in (1, 2, 3, 5, 4096)] + [([1, 2], 2), ([0, 2], 1), ([0, 0], 4), ([0, None], 4), ([-1, 0], 1)])
def test_gae_refuses_what_does_not_count(spark, steps, chunk):
    good = [("b", i, 1.0, 0.0) for i in range(7)]
    df = spark.createDataFrame([("a", i, 1.0, 0.0) for i in steps] + good, "k string, step long, reward double, value double")
    with pytest.raises(Exception, match="do not count"):
        gae(df, ["k"], chunk=chunk).select("advantage").collect()


@pytest.mark.parametrize("left_out, fan", [(0, 4096), (8, 2), (31, 3)])
def test_gae_refuses_gaps_and_repeats(spark, left_out, fan):
    rows = [("a", i, 1.0, 0.0) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, step long, reward double, value double")
    for wrong in (df.where(F.col("step") != left_out), df.union(df.where(F.col("step") == left_out)), df.where(F.floor(F.col("step") / 8) != left_out // 8)):
        with pytest.raises(Exception, match="do not count"):
            gae(wrong, ["k"], gamma=0.9, chunk=8, fan=fan).select("value_target").collect()


def test_gae_limits(spark):
    df = spark.createDataFrame([(1, 0, 1.0, 0.0)], "k long, step long, reward double, value double")
    with pytest.raises(ValueError):
        gae(df, ["k"], gamma=1.5)
