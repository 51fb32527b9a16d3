"""Vector codes against a plain version, and the equal-average search against all distances."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradeloom.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 20), st.integers(1, 6), st.integers(0, 10**6), st.sampled_from([2, 50, 10_000]))
def test_search_is_exact(k, d, seed, span):
    rng = np.random.default_rng(seed)
    x, book = rng.integers(-span, span, (30, d)), rng.integers(-span, span, (k, d))
    index, best, compared = codes.nearest(x, book)
    all_ = ((x[:, None] - book) ** 2).sum(axis=2)
    assert (index == all_.argmin(axis=1)).all() and (best == all_.min(axis=1)).all()
    assert 30 <= compared <= 30 * k


def test_search_leaves_entries_out():
    book = np.arange(256)[:, None] * np.full(8, 100)
    x = book[:100] + 1
    assert codes.nearest(x, book)[2] <= 200


def plain(rows, parts=8, entries=16, rounds=6):
    """vec_id, code, error, label_error and the digest of the codebooks, in Python's whole numbers."""
    kept = [(i, [math.floor(4096 * c) for c in v], lab) for i, v, lab in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda a, book: min((gap(a, b), e) for e, b in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            met = {}
            for _, v, _ in kept:
                met.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            for e, vs in met.items():
                books[p][e] = [sum(c) // len(vs) for c in zip(*vs)]
    sha = hashlib.sha256(",".join(str(c) for book in books for b in book for c in b).encode()).hexdigest()
    found = [(i, lab, [near(cut(v, p), books[p]) for p in range(parts)]) for i, v, lab in kept]
    sums = {}
    for _, lab, best in found:
        sums[lab] = sums.get(lab, 0) + sum(d for d, _ in best)
    return sorted((str(i), "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), sums[lab], sha) for i, lab, best in found)


def compressed(df, **how):
    return sorted((str(r[0]), *r[1:]) for r in codes.compress(df, **how).collect())


def vectors(seed, n, d=16, ids=None):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(c)) for c in rng.normal(size=d).round(2)], int(rng.integers(3))) for i in (ids or range(n))]


def test_against_plain(spark):
    rows = vectors(1, 120)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert compressed(df) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None, 0), (2, [1.0] * 15 + [nan], 0), (3, [inf] + [0.0] * 15, 0), (4, [None] + [0.0] * 15, 0), (5, [], 1)]
    rows = [*vectors(2, 0, ids=[9, 9, 9, 7, 7, -3, 40, 41, 42]), (8, [0.0] * 16, None), (8, [0.0] * 16, None), (None, [-0.5] * 16, None)]
    df = spark.createDataFrame([*odd, *rows], SCHEMA).withColumns({"code": F.lit("x"), "error": F.lit(1), "of": F.lit(2), "place": F.lit(0), "salt": F.lit(0), "v": F.lit(0)})
    assert compressed(df) == plain(rows)
    assert compressed(df.where("vec_id < 6 and vec_id > 0")) == [] == compressed(df.limit(0))
    same = [(i, [0.25] * 8, 1) for i in range(40)]
    assert compressed(spark.createDataFrame(same, SCHEMA)) == plain(same)


def test_hot_label(spark):
    rows = [(i, v, 7 if i % 3 else lab) for i, v, lab in vectors(3, 90)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert compressed(df) == plain(rows)


@pytest.mark.parametrize("bad", [[[1.0] * 16, [1.0] * 8], [[1.0] * 12], [[1e9] * 16]])
def test_refused(spark, bad):
    with pytest.raises(Exception, match="differ in length|no multiple"):
        codes.compress(spark.createDataFrame([(i, v, 0) for i, v in enumerate(bad)], SCHEMA)).collect()
