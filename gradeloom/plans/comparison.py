"""Queries that compare training runs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions import runs as R
from gradeloom.operators import runs as O
from gradeloom.plans.inputs import CONFIG_SQL, METRIC_SQL, RUN_SQL, run_config, run_metrics, runs


def run_name(spark: SparkSession, folder: str) -> DataFrame:
    return runs(spark, folder).select("run_id", R.run_name().alias("run_name"))


def run_tags(spark: SparkSession, folder: str) -> DataFrame:
    told = O.describe_runs(runs(spark, folder))
    return told.select("run_id", "tier", F.array_join("tags", ",").alias("tags"))


def run_project(spark: SparkSession, folder: str) -> DataFrame:
    return O.describe_runs(runs(spark, folder)).select("run_id", "is_smoke", "project", "log_every")


def log_thin(spark: SparkSession, folder: str) -> DataFrame:
    return O.log_thin(run_metrics(spark, folder), runs(spark, folder)).drop("ts")


def log_thin_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The same by the way that is taken where the runs table is too large to broadcast."""
    return O.log_thin(run_metrics(spark, folder), runs(spark, folder), broadcast_rows=10).drop("ts")


def coverage_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return O.coverage_matrix(runs(spark, folder))


def metric_overlay(spark: SparkSession, folder: str) -> DataFrame:
    made = O.metric_overlay(run_metrics(spark, folder), O.measured_only(runs(spark, folder)))
    named = [F.round(F.col(f"`{f}`"), 6).alias(f.replace("-", "_")) for f in (*R.FRAMEWORKS, O.OTHER)]
    return made.select("method", "metric", "step", *named)


def metric_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    return O.metric_percentiles(run_metrics(spark, folder), O.measured_only(runs(spark, folder)))


def control_audit(spark: SparkSession, folder: str) -> DataFrame:
    return O.control_audit(run_config(spark, folder), runs(spark, folder))


def offline_online_diff(spark: SparkSession, folder: str) -> DataFrame:
    made = O.offline_online_diff(run_metrics(spark, folder), O.measured_only(runs(spark, folder)))
    return made.withColumns({c: F.round(c, 6) for c in ("dpo", "online_dpo", "diff")})


_R = f"""(SELECT *, coalesce(method, 'sft') AS m, coalesce(tuning, 'full') AS t, coalesce(nodes, 1) AS nn,
    coalesce(gpus, 1) AS gg, smoke OR coalesce(max_steps, 0) > 0 AS sm FROM {RUN_SQL})"""
_MECH = " ".join(
    f"WHEN m = '{k.split('/')[0]}' AND framework = '{k.split('/')[1]}' THEN ',mech-{v}'" for k, v in R.MECHANISMS.items()
)
_TIER = "CASE WHEN nn > 1 THEN 'mnmg' WHEN gg > 1 THEN 'snmg' ELSE 'snsg' END"
_EVERY = "coalesce(log_every, CASE WHEN sm THEN 1 ELSE 10 END)"
_JOINED = f"(SELECT e.*, r.m, r.framework, r.sm, {_EVERY} AS every FROM {METRIC_SQL} e JOIN {_R} r USING (run_id))"


def _cover(method: str) -> str:
    tuning = "'full'" if method == "pretrain" else "t"
    listed = ", ".join(f"'{m}'" for m in R.METHODS)
    here = f"m NOT IN ({listed})" if method == O.OTHER else f"m = '{method}'"
    full = f"coalesce(bool_or({here} AND {tuning} = 'full'), false)"
    lora = f"coalesce(bool_or({here} AND {tuning} = 'lora'), false)"
    return f"""CASE WHEN {full} AND {lora} THEN 'full|lora' WHEN {full} THEN 'full' WHEN {lora} THEN 'lora'
        ELSE 'none' END AS {method}"""


_PER_FRAMEWORK = ", ".join(
    f"round(avg(value) FILTER (framework = '{f}'), 6) AS {f.replace('-', '_')}" for f in R.FRAMEWORKS
)
_LISTED = ", ".join(f"'{f}'" for f in R.FRAMEWORKS)
_PER_FRAMEWORK += f", round(avg(value) FILTER (framework IS NULL OR framework NOT IN ({_LISTED})), 6) AS other"
_THIN = f"SELECT run_id, step, metric, value FROM {_JOINED} WHERE step = 1 OR step % every = 0"

QUERIES = {
    "run_name": run_name,
    "run_tags": run_tags,
    "run_project": run_project,
    "log_thin": log_thin,
    "log_thin_shuffled": log_thin_shuffled,
    "coverage_matrix": coverage_matrix,
    "metric_overlay": metric_overlay,
    "metric_percentiles": metric_percentiles,
    "control_audit": control_audit,
    "offline_online_diff": offline_online_diff,
}

ORACLE = {
    "run_name": f"""SELECT run_id, m || '-' || list_extract(string_split(CASE WHEN model_name IS NULL OR model_name = ''
        THEN coalesce(model_size, '?') ELSE model_name END, '/'), -1) || '-' || coalesce(source, '?') || '-' || framework
        || CASE WHEN m = 'pretrain' THEN '' ELSE '-' || t END || CASE WHEN nn > 1 THEN '-mn' || nn ELSE '' END
        AS run_name FROM {_R}""",
    "run_tags": f"""SELECT run_id, {_TIER} AS tier, m || ',' || framework || ',' || t || ',' || {_TIER} || ',nodes-' || nn
        || ',gpus-' || gg || CASE WHEN sm THEN ',smoke' ELSE '' END
        || CASE WHEN nn > 1 THEN CASE {_MECH} ELSE '' END ELSE '' END AS tags FROM {_R}""",
    "run_project": f"""SELECT run_id, sm AS is_smoke, CASE WHEN sm THEN 'runs-smoke'
        ELSE coalesce(project, 'runs-' || m) END AS project, {_EVERY} AS log_every FROM {_R}""",
    "log_thin": _THIN,
    "log_thin_shuffled": _THIN,
    "coverage_matrix": f"SELECT framework, {', '.join(_cover(m) for m in (*R.METHODS, O.OTHER))} FROM {_R} GROUP BY framework",
    "metric_overlay": f"""SELECT m AS method, metric, step, {_PER_FRAMEWORK} FROM {_JOINED} WHERE NOT sm
        GROUP BY 1, 2, 3""",
    "metric_percentiles": f"""SELECT m AS method, framework, metric, count(value) AS n,
        quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95 FROM {_JOINED} WHERE NOT sm
        GROUP BY 1, 2, 3""",
    "control_audit": f"""SELECT m AS method, t AS tuning, key, count(DISTINCT value) AS n_values
        FROM {CONFIG_SQL} c JOIN {_R} r USING (run_id) WHERE key <> 'scale.nodes' GROUP BY 1, 2, 3
        HAVING count(DISTINCT value) > 1""",
    "offline_online_diff": f"""SELECT metric, step, round(a, 6) AS dpo, round(b, 6) AS online_dpo, round(b - a, 6) AS diff
        FROM (SELECT metric, step, avg(value) FILTER (m = 'dpo') AS a, avg(value) FILTER (m = 'online_dpo') AS b
        FROM {_JOINED} WHERE NOT sm GROUP BY 1, 2) WHERE a IS NOT NULL AND b IS NOT NULL""",
}
