import random

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from gradeloom.llm.components import components
from gradeloom.llm import simhash as S
from gradeloom.llm.simhash import GrayTree, fingerprint, near_duplicates, similar_edges, stars


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\x09\x0a\x0b\x0c\x0d":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints():
    rnd = random.Random(1)
    texts = [None, "", " \t\n", "One", "one TWO", "Ä ä b c", "a b c", "x " * 5000]
    texts += [" ".join(rnd.choice(["Ab", "cd", "É", "e\tf", "g"]) for _ in range(rnd.randint(1, 40))) for _ in range(100)]
    assert [fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert fingerprint(None) == fingerprint("") == 0


def sample(seed=2, crowd=400):
    rng, out = np.random.default_rng(seed), []
    for base in rng.integers(0, 2**63, 40, dtype=np.uint64).tolist():
        for _ in range(20):
            x = base
            for k in rng.choice(64, rng.integers(0, 5), replace=False):
                x ^= 1 << int(k)
            out.append(x)
    for _ in range(crowd):
        x = 0
        for k in rng.choice(64, rng.integers(1, 4), replace=False):
            x ^= 1 << int(k)
        out.append(x)
    return sorted({*out, 0})


def brute_sets(fps):
    low = {f: f for f in fps}
    def root(x):
        while low[x] != x:
            x = low[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                low[max(root(a), root(b))] = min(root(a), root(b))
    return {f: root(f) for f in fps}


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def partition(sets):
    groups = {}
    for x, s in sets.items():
        groups.setdefault(s, set()).add(x)
    return {frozenset(g) for g in groups.values()}


def test_tree_search_finds_all_and_only_near_leaves():
    fps = np.array(sample(crowd=50), dtype=np.uint64)
    tree = GrayTree(np.full(len(fps), ~np.uint64(0)), fps)
    pairs = set()
    for q, leaf in tree.search(fps, 3, 64):
        pairs |= set(zip(q.tolist(), leaf.tolist()))
    want = {(i, j) for i, a in enumerate(fps.tolist()) for j, b in enumerate(fps.tolist()) if (a ^ b).bit_count() <= 3}
    assert pairs == want


def test_edges_connect_as_all_pairs_do(spark):
    fps = sample()
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = similar_edges(df)
    assert edges.count() <= 2 * 4 * len(fps)
    got = {signed(f): signed(f) for f in fps} | {r["node"]: r["component"] for r in components(edges).collect()}
    assert partition(got) == partition({signed(f): s for f, s in brute_sets(fps).items()})


def test_stars_without_members_or_visitors():
    none = np.empty(0, np.uint64)
    u, v = stars(np.array([1, 3], dtype=np.uint64), none, 3)
    assert (u.tolist(), v.tolist()) == ([3], [1])


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(300)] + [(5000, 5000), (7, 7)]
    df = spark.createDataFrame(chain + star + [(None, 3)], "u long, v long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[1000 + i] for i in range(300)} == {1000}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_documents(spark):
    long = " ".join(f"w{i % 997}" for i in range(30_000))
    rows = [(3, "a b c d"), (1, "A b\tc d"), (7, None), (2, ""), (5, long), (5, long), (None, "a b c d"), (None, "q r s t u v")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x"))
    got = sorted(((r["doc_id"], r["component_id"]) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(3, 1), (1, 1), (7, 2), (2, 2), (5, 5), (5, 5), (None, 1), (None, None)], key=str)
    assert near_duplicates(df.limit(0)).collect() == []


def near_pairs(fps):
    """All pairs within 3 bits: they agree in one of four quarters at least."""
    pairs = set()
    for shift in (0, 16, 32, 48):
        buckets = {}
        for f in fps:
            buckets.setdefault(f >> shift & 0xFFFF, []).append(f)
        for members in buckets.values():
            for i, a in enumerate(members):
                pairs.update((min(a, b), max(a, b)) for b in members[:i] if (a ^ b).bit_count() <= 3)
    return pairs


def many(n, seed=5):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, n, dtype=np.uint64)
    flips = sum(np.uint64(1) << rng.integers(0, 64, n // 10, dtype=np.uint64) for _ in range(3))
    return np.unique(np.concatenate([base, base[: n // 10] ^ flips])).astype(np.int64)


def test_groups_stay_small_and_few_rows_are_sent(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP_SIZE", 64)
    fps = many(20_000)
    df = spark.createDataFrame(pd.DataFrame({"v": fps}))
    want = None
    for most in (400, 20):  # all tasks hold all groups, or groups are told by way of 20 partitions
        monkeypatch.setattr(S, "GROUPS", most)
        members = S.grouped(df, len(fps))
        sizes = members.groupBy("g").count().agg(F.max("count"), F.count("*")).first()
        assert sizes[0] <= 64 and sizes[1] <= 2 * len(fps) / 64 + most
        assert members.select(F.shiftright("g", 32)).distinct().count() <= most
        sent = S.visits(members, 3).agg(F.count("*"), F.count_distinct("g", "v")).first()
        assert sent[0] == sent[1] < 40 * len(fps)
        assert want is None or abs(sent[0] - want) < 0.2 * want
        want = sent[0]


def test_two_steps_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP_SIZE", 32)
    monkeypatch.setattr(S, "GROUPS", 12)
    monkeypatch.setattr(S, "VISITORS", 500)
    fps = sorted({*many(2_000).tolist(), *(signed(f) for f in sample())})
    got = {f: f for f in fps} | {r["node"]: r["component"] for r in components(similar_edges(spark.createDataFrame([(f,) for f in fps], "fp long"))).collect()}
    low = {f: f for f in fps}

    def root(x):
        while low[x] != x:
            low[x] = x = low[low[x]]
        return x

    for a, b in near_pairs([f % 2**64 for f in fps]):
        a, b = root(signed(a)), root(signed(b))
        low[max(a, b)] = min(a, b)
    assert partition(got) == partition({f: root(f) for f in fps})
