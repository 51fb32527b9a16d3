"""Streams over small files: equal to batch, groups complete, repeats dropped."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from gradeloom.operators.groups import group_advantage
from gradeloom.operators.scoring import score_samples
from gradeloom.plans.streams import run_to_end, run_writer
from gradeloom.streaming import folders
from gradeloom.streaming import score as stream_module
from gradeloom.streaming.progress import BatchCounts
from gradeloom.streaming.score import (
    landed_advantages,
    landed_counts,
    landed_once,
    stream_group_advantage,
    stream_once,
    stream_score,
)

START = dt.datetime(2024, 1, 1)


def as_stream(df, path):
    df.repartition(2).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    rows = [(i, f"#### {i % 5}", "4", ("gsm8k",) if i % 4 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, response string, label string, metadata struct<data_source:string>")
    streamed = run_to_end(stream_score(as_stream(df, str(tmp_path / "in"))), str(tmp_path / "out"))
    assert sorted(streamed.collect(), key=lambda r: r["id"]) == sorted(
        score_samples(df, fail=False).select(*streamed.columns).collect(), key=lambda r: r["id"]
    )


def in_pieces(df, path, pieces):
    """A stream that takes one file at a time, in an order that has nothing to do with event time."""
    df.repartition(pieces, F.xxhash64("id")).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("pieces, per_folder", [(1, 3), (4, 1)])
def test_every_row_gets_its_advantage(spark, tmp_path, pieces, per_folder):
    # A third of the rows belong to group 0; one row has no time.
    rows = [(i, START + dt.timedelta(minutes=i), i % 9 if i % 3 else 0, float(i % 7)) for i in range(240)]
    df = spark.createDataFrame([*rows, (240, None, 3, 1.0)], "id long, ts timestamp, g long, r double")
    out = str(tmp_path / "out")
    run_writer(stream_group_advantage(in_pieces(df, str(tmp_path / "in"), pieces), "ts", ["g"], "r", "1 hour", out, str(tmp_path / "cp"), windows_per_folder=per_folder))
    done = landed_advantages(spark, out, df.schema).collect()
    got = {r["id"]: r["advantage"] for r in done}
    hourly = df.withColumn("h", F.date_trunc("hour", "ts"))
    wanted = {r["id"]: r["advantage"] for r in group_advantage(hourly, ["h", "g"], "r").collect()}
    assert len(done) == 241 and got.keys() == wanted.keys()
    assert all(got[i] == pytest.approx(wanted[i], abs=1e-9) for i in wanted)


@pytest.mark.parametrize("pieces", [1, 4])
def test_repeats_are_dropped_and_late_rows_kept(spark, tmp_path, pieces):
    rows = [(i // 2, START + dt.timedelta(days=30 - i), float(i % 2)) for i in range(100)] + [(None, None, 1.0)] * 2
    df = spark.createDataFrame(rows, "id long, ts timestamp, r double")
    out = str(tmp_path / "out")
    df.repartition(pieces, "r", "id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run_writer(stream_once(stream, ["id"], out, str(tmp_path / "cp")))
    assert sorted((r["id"] for r in landed_once(spark, out, df.schema).collect()), key=str) == sorted([*range(50), None], key=str)


def one_by_one(spark, batches, schema, path):
    """A stream that gives the batches one after the other."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def by_batch(spark, path):
    return [{k: v for k, v in r.asDict().items() if k != "batch"} for r in landed_counts(spark, path).orderBy("batch").collect()]


KEYED = "id long, name string, r double"


def test_counts_of_repeats(spark, tmp_path):
    batches = [[(1, "a", 0.0), (2, "b", 0.0)], [(1, "a", 1.0), (3, None, 0.0), (3, None, 2.0)], [(2, "b", 0.0)], [(3, None, 0.0), (4, "d", 0.0), (1, "b", 0.0)]]
    out = str(tmp_path / "out")
    run_writer(stream_once(one_by_one(spark, batches, KEYED, str(tmp_path / "in")), ["id", "name"], out, str(tmp_path / "cp"), buckets=4))
    made = by_batch(spark, out)
    assert sum(c["delivered"] for c in made) == 9 and sum(c["repeated"] for c in made) == 4 and len(made) == 4
    assert all(c["landed"] + c["repeated"] == c["delivered"] for c in made)
    assert sorted(((r["id"], r["name"]) for r in landed_once(spark, out, spark.createDataFrame([], KEYED).schema).collect()), key=str) == [(1, "a"), (1, "b"), (2, "b"), (3, None), (4, "d")]


def test_a_batch_reads_its_own_buckets(spark, tmp_path, monkeypatch):
    """Every batch has keys of its own and one that came before; what a batch reads does not grow with the batches."""
    read, real = [], stream_module.read_folders

    def counted(session, path, names, schema):
        df = real(session, path, names, schema)
        if path.endswith("keys"):
            read.append((len(names), len(df.inputFiles()) if names else 0))
        return df

    monkeypatch.setattr(stream_module, "read_folders", counted)
    batches = [[(i, "x", 0.0), (max(0, i - 1), "x", 1.0)] for i in range(10)]
    out = str(tmp_path / "out")
    run_writer(stream_once(one_by_one(spark, batches, KEYED, str(tmp_path / "in")), ["id"], out, str(tmp_path / "cp"), buckets=64, fold=1000))
    assert sorted(r["id"] for r in landed_once(spark, out, spark.createDataFrame([], KEYED).schema).collect()) == list(range(10))
    # Two keys a batch: two buckets at most, whatever came before, with a file or two in each.
    assert len(read) >= 10 and max(n for n, _ in read) <= 2 and max(files for _, files in read) <= 5
    assert sum(c["repeated"] for c in by_batch(spark, out)) == 10


def test_folding_the_index_loses_nothing(spark, tmp_path):
    batches = [[(i % 5, "x", float(i)), (i, "y", 0.0)] for i in range(9)]
    out = str(tmp_path / "out")
    run_writer(stream_once(one_by_one(spark, batches, KEYED, str(tmp_path / "in")), ["id", "name"], out, str(tmp_path / "cp"), buckets=1, fold=4))
    assert landed_once(spark, out, spark.createDataFrame([], KEYED).schema).count() == 14
    assert folders.versions(spark, f"{out}/keys/bucket=0", "level") == [0, 1]
    assert folders.versions(spark, f"{out}/keys/bucket=0/level=1", "batch") == [7]
    assert folders.versions(spark, f"{out}/keys/bucket=0/level=0", "batch") in ([8], [])


TIMED = "id long, ts timestamp, g long, r double"


def test_windows_late_rows_and_versions(spark, tmp_path, monkeypatch):
    at = lambda hour, minute=0: START + dt.timedelta(hours=hour, minutes=minute)
    batches = [
        [(0, at(0), 1, 1.0), (1, at(0, 5), 1, 3.0), (2, at(1), 1, 5.0)],
        [(3, at(2), 1, 1.0), (4, at(2), 2, None)],
        [(5, at(0, 30), 1, 8.0), (6, None, 1, 2.0)],
        [(7, at(0, 59), 1, 0.5), (8, at(0, 59), 2, 0.5), (9, None, 1, 4.0)],
    ]
    read, real = [], stream_module.read_folders

    def counted(session, path, names, schema):
        if path.endswith("rows"):
            read.append(len(names))
        return real(session, path, names, schema)

    monkeypatch.setattr(stream_module, "read_folders", counted)
    out, schema = str(tmp_path / "out"), spark.createDataFrame([], TIMED).schema
    run_writer(stream_group_advantage(one_by_one(spark, batches, TIMED, str(tmp_path / "in")), "ts", ["g"], "r", "1 hour", out, str(tmp_path / "cp")))
    df = spark.createDataFrame([r for b in batches for r in b], TIMED)
    wanted = {r["id"]: r for r in group_advantage(df.withColumn("h", F.date_trunc("hour", "ts")), ["h", "g"], "r").collect()}
    got = {r["id"]: r for r in landed_advantages(spark, out, schema).collect()}
    assert got.keys() == wanted.keys()
    for i, w in wanted.items():
        for c in ("group_mean", "group_std", "advantage"):
            assert got[i][c] == (w[c] if w[c] is None else pytest.approx(w[c], abs=1e-12))
    counts = by_batch(spark, out)
    assert sorted(c["landed"] for c in counts) == [2, 2, 3, 3] and max(read) == 2
    names = [s for s in folders.different(spark.read.parquet(f"{out}/advantages"), "at")]
    for w in names:  # the latest version and the one before it
        assert len(folders.versions(spark, f"{out}/advantages/{folders.name_of('at', w)}", "version")) <= 2
    assert sum(c["late"] for c in counts) == 4


def test_counts_from_progress(spark, tmp_path):
    kind = "id long, response string, label string, metadata struct<data_source:string>"
    good, bad = ("gsm8k",), ("nobody",)
    batches = [[(1, "#### 4", "4", good)], [(2, "x", "4", bad), (3, "#### 1", "4", good)], [(4, "x", "4", None)], [(5, "x", "4", good)] * 3]
    counts = BatchCounts()
    spark.streams.addListener(counts)
    try:
        run_to_end(stream_score(one_by_one(spark, batches, kind, str(tmp_path / "in"))), str(tmp_path / "out"))
        for _ in range(100):
            if counts.batches and len(next(iter(counts.batches.values()))) >= 4:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counts)
    (run,) = counts.batches
    assert sorted(tuple(c.values()) for c in counts.batches[run].values()) == sorted([(1, 0), (1, 1), (0, 1), (3, 0)])
    assert counts.total(run) == {"scored": 5, "rejected": 2}
