"""Run names, labels, logging rules and comparisons."""

import pytest
from pyspark.sql import functions as F

from gradeloom.functions import runs as R
from gradeloom.operators import runs as O
from gradeloom.operators.skew import lookup
from gradeloom.schemas import RUN_CONFIG, RUN_METRICS, RUNS

BLANK = dict.fromkeys(RUNS.fieldNames())


def table(spark, *rows):
    return spark.createDataFrame([BLANK | {"run_id": i} | row for i, row in enumerate(rows)], RUNS)


SFT_LORA = {"method": "sft", "framework": "trl", "tuning": "lora", "model_name": "Qwen/Qwen3-4B-Base",
            "source": "traceinversion", "nodes": 1, "gpus": 1, "max_steps": -1}
PRETRAIN = {"method": "pretrain", "framework": "torchtitan", "model_size": "4b", "source": "wikitext"}
SMOKE = PRETRAIN | {"nodes": 2, "gpus": 4, "max_steps": 5}
BARE = {"framework": "verl", "smoke": True, "max_steps": 0, "log_every": 3}


def test_descriptions(spark):
    got = {r["run_id"]: r for r in O.describe_runs(table(spark, SFT_LORA, PRETRAIN, SMOKE, BARE), "lab").collect()}
    assert [got[i]["run_name"] for i in range(4)] == [
        "sft-Qwen3-4B-Base-traceinversion-trl-lora",
        "pretrain-4b-wikitext-torchtitan",
        "pretrain-4b-wikitext-torchtitan-mn2",
        "sft-?-?-verl-full",
    ]
    assert [got[i]["tier"] for i in range(4)] == ["snsg", "snsg", "mnmg", "snsg"]
    assert got[0]["tags"] == ["sft", "trl", "lora", "snsg", "nodes-1", "gpus-1"]
    assert got[2]["tags"] == ["pretrain", "torchtitan", "full", "mnmg", "nodes-2", "gpus-4", "smoke", "mech-torchrun"]
    assert got[3]["tags"][-1] == "smoke"
    assert [got[i]["project"] for i in range(4)] == ["lab-sft", "lab-pretrain", "lab-smoke", "lab-smoke"]
    assert [got[i]["log_every"] for i in range(4)] == [10, 10, 1, 3]


def test_own_project_and_unwired_pair(spark):
    runs = table(spark, SFT_LORA | {"project": "mine", "gpus": 8}, SFT_LORA | {"framework": "unsloth", "nodes": 2})
    got = {r["run_id"]: r for r in O.describe_runs(runs).collect()}
    assert got[0]["project"] == "mine" and got[0]["tier"] == "snmg"
    assert not any(t.startswith("mech") for t in got[1]["tags"])
    assert set(R.MECHANISMS.values()) == {"torchrun", "ray", "hf-torchrun", "megatron"}


def test_coverage(spark):
    runs = table(spark, SFT_LORA, SFT_LORA | {"tuning": "full"}, SFT_LORA | {"method": "dpo"}, PRETRAIN)
    got = {r["framework"]: r for r in O.coverage_matrix(runs).collect()}
    assert got["trl"]["sft"] == "full|lora" and got["trl"]["dpo"] == "lora" and got["trl"]["ppo"] == "none"
    assert got["torchtitan"]["pretrain"] == "full" and got["torchtitan"]["sft"] == "none"


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_log_thin(spark, broadcast_rows):
    runs = table(spark, SFT_LORA, SMOKE)
    metrics = spark.createDataFrame([(i, s, "loss", 1.0, None) for i in (0, 1, 9) for s in range(1, 31)], RUN_METRICS)
    kept = O.log_thin(metrics, runs, broadcast_rows).collect()
    assert sorted(r["step"] for r in kept if r["run_id"] == 0) == [1, 10, 20, 30]
    assert sorted(r["step"] for r in kept if r["run_id"] == 1) == list(range(1, 31))
    assert not [r for r in kept if r["run_id"] == 9]


def test_lookup_keeps_every_row_of_a_hot_key(spark):
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 != 0, F.col("id"))
    facts = spark.range(3000).select(key.alias("k"), "id")
    names = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("name"))
    for how, n in (("inner", facts.where("k < 2000").count()), ("left", 3000)):
        ways = [
            sorted(lookup(facts, names, "k", how, b, hot).select("k", "id", "name").collect(), key=str)
            for b, hot in ((5000, 100), (10, 100), (10, 5000))
        ]
        assert len(ways[0]) == n and ways[0] == ways[1] == ways[2]
    with pytest.raises(ValueError):
        lookup(facts, names, "k", "outer")


def test_overlay_percentiles_and_diff(spark):
    runs = table(spark, SFT_LORA | {"method": "dpo"}, SFT_LORA | {"method": "online_dpo"},
                 SFT_LORA | {"method": "dpo", "framework": "unsloth"}, SMOKE | {"method": "dpo"})
    data = [(i, s, "loss", float(s + i), None) for i in range(4) for s in range(1, 101)] + [(0, 101, "loss", 1.0, None)]
    metrics = spark.createDataFrame(data, RUN_METRICS)
    over = {(r["method"], r["step"]): r for r in O.metric_overlay(metrics, O.measured_only(runs)).collect()}
    assert over["dpo", 5]["trl"] == 5.0 and over["dpo", 5]["unsloth"] == 7.0 and over["dpo", 5]["torchtitan"] is None
    diff = {r["step"]: r for r in O.offline_online_diff(metrics, O.measured_only(runs)).collect()}
    assert len(diff) == 100 and diff[5]["diff"] == pytest.approx(6.0 - (5.0 + 7.0) / 2)
    p = O.metric_percentiles(metrics, runs).where("framework = 'unsloth'").first()
    assert (p["n"], p["p50"], p["p95"]) == (100, 52.0, 97.0)


def test_audit(spark):
    runs = table(spark, SFT_LORA, SFT_LORA, SFT_LORA | {"tuning": "full"})
    config = [(0, "hp.lr", "1"), (1, "hp.lr", "2"), (2, "hp.lr", "3"), (0, "hp.epochs", "3"), (1, "hp.epochs", "3"),
              (0, "scale.gpus", "1"), (1, "scale.gpus", "8")]
    found = O.control_audit(spark.createDataFrame(config, RUN_CONFIG), runs).collect()
    assert [tuple(r) for r in found] == [("sft", "lora", "hp.lr", 2)]


def test_percentiles_are_exact_in_large_and_lopsided_groups(spark):
    runs = spark.createDataFrame([(1, "sft", "trl"), (2, "sft", "own")], "run_id long, method string, framework string")
    rows = spark.range(200_000).selectExpr("1L run_id", "'loss' metric", "id step", "cast((id * 7919) % 200003 as double) value")
    flat = spark.range(3000).selectExpr("2L run_id", "'loss' metric", "id step", "if(id < 2900, 5.0D, if(id < 2990, id, null)) value")
    got = {r["framework"]: r for r in O.metric_percentiles(rows.union(flat), runs).collect()}
    values = sorted((i * 7919) % 200003 for i in range(200_000))
    assert (got["trl"]["p50"], got["trl"]["p95"], got["trl"]["n"]) == (values[99_999], values[189_999], 200_000)
    assert (got["own"]["p50"], got["own"]["p95"], got["own"]["n"]) == (5.0, 5.0, 2990)


def test_what_is_not_listed_is_other(spark):
    runs = spark.createDataFrame([(1, "sft", "own", "full"), (2, "mine", "trl", "lora")], "run_id long, method string, framework string, tuning string")
    metrics = spark.createDataFrame([(1, "loss", 1, 2.0), (2, "loss", 1, 4.0)], "run_id long, metric string, step long, value double")
    over = {r["method"]: r for r in O.metric_overlay(metrics, runs).collect()}
    assert (over["sft"]["other"], over["mine"]["trl"], over["mine"]["other"]) == (2.0, 4.0, None)
    cover = {r["framework"]: r for r in O.coverage_matrix(runs).collect()}
    assert (cover["trl"]["other"], cover["own"]["sft"], cover["own"]["other"]) == ("lora", "full", "none")


def test_percentile_names_differ():
    from gradeloom.operators.runs import percentile_name

    assert [percentile_name(p) for p in (0.5, 0.95, 0.99, 0.995, 0.999, 0.9999, 1.0)] == ["p50", "p95", "p99", "p99_5", "p99_9", "p99_99", "p100"]
