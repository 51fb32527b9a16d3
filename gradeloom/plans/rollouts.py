"""Queries over groups of completions and over trajectories."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions import rewards as R
from gradeloom.operators import groups as G
from gradeloom.operators.gae import gae
from gradeloom.plans.grading import SCORED_SQL, scored_rollouts
from gradeloom.plans.inputs import ROLLOUT_SQL, STEP_SQL, rollouts, steps

_KEY = ["prompt_id", "sample_no", "completion"]


def group_advantage(spark: SparkSession, folder: str) -> DataFrame:
    """Grade, then normalise within each prompt's group: the whole way from text to advantage."""
    reward = R.gsm8k_score(F.col("completion"), F.col("gold"))
    placed = G.group_advantage(rollouts(spark, folder), ["prompt_id"], reward)
    return placed.select(*_KEY, "reward", F.round("advantage", 6).alias("advantage"))


def group_advantage_hot(spark: SparkSession, folder: str) -> DataFrame:
    """The same with uneven groups, one of which holds a third of all rows and counts as hot."""
    bucket = F.when(F.col("prompt_id") % 3 == 0, -1).otherwise(F.col("prompt_id") % 997)
    reward = R.gsm8k_score(F.col("completion"), F.col("gold"))
    placed = G.group_advantage(rollouts(spark, folder).withColumn("bucket", bucket), ["bucket"], reward, hot_rows=1000)
    return placed.select(*_KEY, "bucket", F.round("advantage", 6).alias("advantage"))


def group_summary(spark: SparkSession, folder: str) -> DataFrame:
    made = G.group_summary(scored_rollouts(spark, folder), ["prompt_id"], "reward")
    return made.withColumns({c: F.round(c, 6) for c in ("reward_mean", "reward_std")})


def online_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return G.online_preference_pairs(rollouts(spark, folder), ["prompt_id"], "completion", "rm_score")


def eos_penalty(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs chosen after rollouts that never ended have lost one point."""
    score = R.missing_eos_penalty(F.col("rm_score"), F.col("has_eos"), 1.0)
    penalised = rollouts(spark, folder).withColumn("score", score)
    pairs = G.online_preference_pairs(penalised, ["prompt_id"])
    return pairs.withColumns({c: F.round(c, 6) for c in ("chosen_score", "rejected_score")})


def kl_shaped_reward(spark: SparkSession, folder: str) -> DataFrame:
    shaped = R.kl_shaped_reward(F.col("reward"), F.col("kl"), 0.04)
    return scored_rollouts(spark, folder).select(*_KEY, F.round(shaped, 6).alias("shaped"))


def _gae(df: DataFrame, **options) -> DataFrame:
    made = gae(df, ["trajectory"], **options)
    return made.select("trajectory", "step", *[F.round(c, 7).alias(c) for c in ("advantage", "value_target")])


def gae_undiscounted(spark: SparkSession, folder: str) -> DataFrame:
    return _gae(steps(spark, folder))


def gae_discounted(spark: SparkSession, folder: str) -> DataFrame:
    return _gae(steps(spark, folder), gamma=0.99, lam=0.95)


def gae_chunked(spark: SparkSession, folder: str) -> DataFrame:
    """The same numbers when a trajectory is worked on in pieces of 7 steps."""
    return _gae(steps(spark, folder), gamma=0.99, lam=0.95, chunk=7)


def _advantage_sql(group: str, source: str) -> str:
    return f"""round(CASE WHEN count(*) OVER w = 1 THEN 0.0
        ELSE (reward - avg(reward) OVER w) / (stddev_samp(reward) OVER w + 0.0001) END, 6) AS advantage
        FROM {source} WINDOW w AS (PARTITION BY {group})"""


def _pairs_sql(score: str) -> str:
    ranked = f"(SELECT prompt_id, completion, {score} AS score FROM {ROLLOUT_SQL})"
    return f"""SELECT prompt_id,
        max({{'s': score, 't': completion}}).t AS chosen, min({{'s': score, 't': completion}}).t AS rejected,
        max(score) AS chosen_score, min(score) AS rejected_score
        FROM {ranked} GROUP BY prompt_id HAVING max(score) > min(score)"""


_ROUNDED_PAIRS = f"""SELECT prompt_id, chosen, rejected, round(chosen_score, 6) AS chosen_score,
    round(rejected_score, 6) AS rejected_score
    FROM ({_pairs_sql("rm_score - CASE WHEN has_eos THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END")})"""

# The definition itself: every later delta of the trajectory, weighted by its distance.
_DELTA = f"""(SELECT *, reward + {{gamma}} * coalesce(lead(value) OVER (PARTITION BY trajectory ORDER BY step), 0.0)
    - value AS delta FROM {STEP_SQL})"""
_GAE = f"""SELECT trajectory, step, round(a, 7) AS advantage, round(a + value, 7) AS value_target FROM (
    SELECT x.trajectory, x.step, any_value(x.value) AS value, sum(power({{g}}, y.step - x.step) * y.delta) AS a
    FROM {_DELTA} x JOIN {_DELTA} y ON x.trajectory = y.trajectory AND y.step >= x.step GROUP BY 1, 2)"""
_GAE_ONE = _GAE.format(gamma="1.0::DOUBLE", g="1.0::DOUBLE")
_GAE_LAM = _GAE.format(gamma="0.99::DOUBLE", g="(0.99::DOUBLE * 0.95::DOUBLE)")
_BUCKETED = f"""(SELECT *, CASE WHEN prompt_id % 3 = 0 THEN -1 ELSE prompt_id % 997 END AS bucket FROM {SCORED_SQL})"""

QUERIES = {
    "group_advantage": group_advantage,
    "group_advantage_hot": group_advantage_hot,
    "group_summary": group_summary,
    "online_pairs": online_pairs,
    "eos_penalty": eos_penalty,
    "kl_shaped_reward": kl_shaped_reward,
    "gae": gae_undiscounted,
    "gae_discounted": gae_discounted,
    "gae_chunked": gae_chunked,
}

ORACLE = {
    "group_advantage": f"""SELECT prompt_id, sample_no, completion, reward,
        {_advantage_sql("prompt_id", SCORED_SQL)}""",
    "group_advantage_hot": f"""SELECT prompt_id, sample_no, completion, bucket,
        {_advantage_sql("bucket", _BUCKETED)}""",
    "group_summary": f"""SELECT prompt_id, count(*) AS n, round(avg(reward), 6) AS reward_mean,
        round(stddev_samp(reward), 6) AS reward_std, min(reward) AS reward_min, max(reward) AS reward_max,
        min(reward) = max(reward) AS degenerate FROM {SCORED_SQL} GROUP BY prompt_id""",
    "online_pairs": _pairs_sql("rm_score"),
    "eos_penalty": _ROUNDED_PAIRS,
    "kl_shaped_reward": f"""SELECT prompt_id, sample_no, completion, round(reward - 0.04::DOUBLE * kl, 6) AS shaped
        FROM {SCORED_SQL}""",
    "gae": _GAE_ONE,
    "gae_discounted": _GAE_LAM,
    "gae_chunked": _GAE_LAM,
}
