import numpy as np
from pyspark.sql import functions as F

from gradeloom.llm import embeddings as E
from gradeloom.llm.embeddings import Descent, audit, near_links

SCHEMA = "vec_id long, embedding array<double>, label int, n_links string"


def brute(rows):
    links, comp = {r[0]: set() for r in rows}, {r[0]: r[0] for r in rows}
    ok = {}
    for i, v, label, *_ in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = (label, np.array(v) / np.linalg.norm(v))
    for i, (a, x) in ok.items():
        for j, (b, y) in ok.items():
            if i < j and a == b and len(x) == len(y) and x @ y >= 0.93:
                links[i].add(j), links[j].add(i)
    changed = True
    while changed:
        changed = False
        for i in comp:
            least = min([comp[i], *(comp[j] for j in links[i])])
            changed, comp[i] = changed or least < comp[i], least
    return {i: (len(links[i]), comp[i]) for i in comp}


def found(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in df.collect()}


def test_links_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(60):
        center = rng.normal(size=24)
        for _ in range(int(rng.integers(1, 5))):
            rows.append((len(rows), (center + rng.normal(size=24) * rng.choice([0.02, 0.2, 0.4])).tolist(), c % 3, "x"))
    center = rng.normal(size=24)
    for _ in range(90):  # a crowd, larger than a list
        rows.append((len(rows), (center + rng.normal(size=24) * 0.05).tolist(), 1, "x"))
    for _ in range(40):  # copies
        rows.append((len(rows), rows[0][1], 0, "x"))
    odd = [None, [], [0.0] * 24, [1.0, None] * 12, [float("nan")] * 24, [float("inf")] + [0.0] * 23, [1.0, 2.0], [1.0, 2.0]]
    for v in odd:
        rows.append((len(rows), v, 0, "x"))
    rows.append((len(rows), rows[0][1], None, "x"))
    df = spark.createDataFrame(rows, SCHEMA)
    got = near_links(df)
    assert found(got) == brute(rows)
    asked = audit(df, got, every=10, block=7).collect()
    assert asked and all(r["n_true"] == r["n_links"] for r in asked)


def test_clumps_whose_lists_are_full_of_their_own_still_link(spark):
    rng = np.random.default_rng(6)
    a, b, c = np.linalg.qr(rng.normal(size=(64, 3)))[0].T
    centers = [a, 0.953 * a + np.sqrt(1 - 0.953**2) * b, 0.5 * a + np.sqrt(0.75) * c]  # the third is far from both
    rows = []
    for i in range(120):
        rows.append((i, (centers[i % 3] + rng.normal(size=64) * 0.0065).tolist(), 1, "x"))
    rows += [(120 + i, rows[i][1], 1, "x") for i in range(5)] + [(125 + i, rows[i][1], 2, "x") for i in range(60)]
    want = brute(rows)
    assert len({want[i][1] for i in range(120)}) == 2 and want[6][0] >= 60
    assert found(near_links(spark.createDataFrame(rows, SCHEMA))) == want


def test_one_label_with_most_rows_and_few_neighbours_kept(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 16))
    rows = [(i, base[i % 150].tolist() if i % 3 else (base[i % 150] * 2).tolist(), 5, "x") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(near_links(df, how=Descent(neighbours=2, trees=2, rounds=2))) == brute(rows)


def test_empty_table(spark):
    assert near_links(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = spark.createDataFrame([(None, [1.0, 2.0], 1, ""), (4, None, 1, "")], SCHEMA)
    got = near_links(alone).orderBy(F.col("vec_id").asc_nulls_first()).collect()
    assert [tuple(r) for r in got] == [(None, 0, None), (4, 0, 4)]


def test_long_vectors_with_an_outlier_component(spark):
    """One component holds nearly all of the length; what the others add still counts."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(60):
        v = rng.choice([-1.0, 1.0], size=2048) * 0.0041
        v[i % 3] = 1.0
        rows.append((i, v.tolist(), 1, "x"))
    want = brute(rows)
    assert want[0][0] >= 1
    got = near_links(spark.createDataFrame(rows, SCHEMA))
    assert found(got) == want
    asked = audit(spark.createDataFrame(rows, SCHEMA), got, every=5).collect()
    assert sum(r["n_links"] for r in asked) >= 0.999 * sum(r["n_true"] for r in asked) > 0


def compared_pairs(spark, monkeypatch, clumps, wide):
    """Pairs of vectors that are compared one by one, for a label with so many clumps of 64."""
    monkeypatch.setattr(E, "BLOCK", 16)
    rng = np.random.default_rng(9)
    rows = []
    for c in range(clumps):
        center = rng.normal(size=32)
        rows += [(64 * c + i, 64 * c, (center + rng.normal(size=32) * wide).tobytes()) for i in range(64)]
    table = spark.createDataFrame([(i, s, 1, 32.0, v, 1) for i, s, v in rows], "rid long, set long, label int, dim double, raw binary, copies long")
    sets = table.select(F.lit(0).cast("long").alias("set"), F.col("set").alias("own_set"), "rid")
    members, blocks = E._blocks(sets, table.drop("set"), ["own_set", "rid"], "own_set")
    across = E._meetings(blocks, 0.93, True).where(F.col("kind") == E.SOME).count()
    within = E._blocks(table.select("set", "rid"), table.drop("set"), ["rid"], "set")[1]
    return 256 * across, 256 * E._meetings(within, 0.93, False).where(F.col("kind") == E.SOME).count()


def test_work_on_a_label_is_not_quadratic(spark, monkeypatch):
    """Clumps lie apart, and a tight clump needs no comparison at all to know its links."""
    few, many = (compared_pairs(spark, monkeypatch, n, 0.01) for n in (8, 32))
    assert many[0] <= 4.5 * max(few[0], 256 * 2) and many[1] == few[1] == 0
    loose = compared_pairs(spark, monkeypatch, 8, 0.15)
    assert 0 < loose[1] <= 8 * 64 * 64


def test_blocks_settled_as_a_whole_count_the_same(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 8)
    rng = np.random.default_rng(10)
    a, b = np.linalg.qr(rng.normal(size=(24, 2)))[0].T
    rows = []
    for i in range(160):  # two tight clumps that link with each other, one further away, and copies
        center = (a, 0.96 * a + np.sqrt(1 - 0.96**2) * b, b)[i % 3]
        rows.append((i, (center + rng.normal(size=24) * 0.003).tolist(), 1, "x"))
    rows += [(160 + i, rows[i][1], 1, "x") for i in range(7)]
    assert found(near_links(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
