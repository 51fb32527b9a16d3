"""The endless order: places over several epochs, and which folders a read touches."""

import re

import pytest
from pyspark.sql import functions as F

from gradeloom.operators import order as O
from gradeloom.operators.sampling import epoch_order
from gradeloom.operators.scan import sum_before


def test_spans():
    assert O.spans(0, 0, 7) == []
    assert O.spans(5, 4, 7) == [(0, 5, 2), (1, 0, 2)]
    assert O.spans(6, 16, 7) == [(0, 6, 1), (1, 0, 7), (2, 0, 7), (3, 0, 1)]
    for first, count, rows in ((-1, 1, 7), (0, -1, 7), (0, 1, 0)):
        with pytest.raises(ValueError):
            O.spans(first, count, rows)


def test_places_are_epochs_and_positions(spark):
    df = spark.range(30).select("id", O.epoch_of(F.col("id"), 7).alias("e"), O.pos_of(F.col("id"), 7).alias("p"))
    for r in df.withColumn("back", O.place_of(F.col("e"), F.col("p"), 7)).collect():
        assert divmod(r["id"], 7) == (r["e"], r["p"]) and r["back"] == r["id"]


def test_read_places(spark, tmp_path):
    df, path = spark.range(100).withColumn("text", F.concat(F.lit("t"), "id")), str(tmp_path / "order")
    for epoch in (0, 1, 2, 1):  # writing an epoch again changes nothing
        O.write_epoch(df, ["id"], 7, epoch, path, range_rows=10)
    want = {}
    for epoch in (0, 1, 2):
        for r in epoch_order(df, ["id"], 7, epoch).collect():
            want[100 * epoch + r["pos"]] = r["id"]
    for first, count in ((0, 1), (95, 10), (95, 110), (0, 300), (200, 100), (40, 0)):
        got = {r["place"]: r["id"] for r in O.read_places(spark, path, first, count, 100, range_rows=10).collect()}
        assert got == {p: want[p] for p in range(first, first + count)}
    plan = O.read_places(spark, path, 95, 10, 100, range_rows=10)._jdf.queryExecution().optimizedPlan().toString()
    physical = O.read_places(spark, path, 95, 10, 100, range_rows=10)._jdf.queryExecution().sparkPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*)", physical).group(1)
    assert "place_range" in plan
    assert "epoch" in filters and "place_range" in filters
    one = O.read_places(spark, path, 130, 10, 100, range_rows=10)
    assert {r[0] for r in one.select(F.input_file_name()).distinct().collect()} and one.select(F.input_file_name()).distinct().count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        O.read_places(spark, path, 300, 1, 100, range_rows=10)


@pytest.mark.parametrize("fan, levels", [(4, 5), (4, 0), (2, 1), (3, 2), (4096, 2)])
def test_sum_before(spark, fan, levels):
    rows = [(k, i, (i * 7 + len(k)) % 11) for k, n in (("a", 1), ("bb", 5), ("ccc", 1100)) for i in range(n) if (i + len(k)) % 13]
    df = spark.createDataFrame(rows, "k string, place long, v long").repartition(5)
    got = {(r["k"], r["place"]): r["before"] for r in sum_before(df, ["k"], "place", "v", "before", fan, levels).collect()}
    running = {}
    for k, i, v in rows:
        assert got[k, i] == running.get(k, 0)
        running[k] = running.get(k, 0) + v
    with pytest.raises(ValueError):
        sum_before(df, ["k"], "place", "v", "before", fan=1)


def test_no_window_over_a_whole_key(spark):
    df = spark.range(5000).select((F.col("id") % 1).alias("k"), F.col("id").alias("place"), F.lit(1).alias("v"))
    plan = sum_before(df, ["k"], "place", "v", "before", fan=4, levels=5)._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"_we0#\w+\], \[([^\]]*)\]", plan)
    # Six windows; the top one alone has the key by itself, and 5000 / 4**5 rows in it.
    assert len(windows) == 6 and sum("_piece" not in w for w in windows) == 1
