"""Grading queries: answers, rewards, routed scores."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions import rewards as R
from gradeloom.operators.scoring import score_completions, score_routed, score_samples
from gradeloom.plans.inputs import MATH_SQL, ROLLOUT_SQL, math_problems, rollouts
from gradeloom.sources.adapters import from_gsm8k
from gradeloom.sources.readers import read_table

_KEY = ["prompt_id", "sample_no"]


def norm_sql(text: str) -> str:
    found = f"regexp_extract({text}, '-?\\d[\\d,]*\\.?\\d*')"
    return f"nullif(regexp_replace(rtrim(replace({found}, ',', ''), '.'), '\\.0$', ''), '')"


def _boxed(text: str) -> str:
    return f"regexp_extract({text}, '\\\\boxed\\{{([^}}]*)\\}}', 1)"


def _hashed(text: str) -> str:
    return f"regexp_extract({text}, '(?m)####\\s*(.+?)\\s*$', 1)"


def predicted_sql(text: str) -> str:
    tail = f"list_extract(string_split({text}, chr(10)), -1)"
    return (
        f"coalesce({norm_sql(_boxed(text))}, {norm_sql(_hashed(text))}, {norm_sql(tail)}, {norm_sql(text)})"
    )


def correct_sql(text: str, gold: str) -> str:
    return f"CASE WHEN {predicted_sql(text)} = {norm_sql(gold)} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


def format_sql(text: str) -> str:
    return (
        f"CASE WHEN regexp_matches({text}, '\\\\boxed\\{{[^}}]*\\}}') OR regexp_matches({text}, "
        f"'(?m)####\\s*.+?\\s*$') THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END"
    )


def score_sql(text: str = "completion", gold: str = "gold") -> str:
    return f"({correct_sql(text, gold)} + {format_sql(text)})"


SCORED_SQL = f"(SELECT *, {score_sql()} AS reward FROM {ROLLOUT_SQL})"


def scored_rollouts(spark: SparkSession, folder: str) -> DataFrame:
    return rollouts(spark, folder).withColumn("reward", R.gsm8k_score(F.col("completion"), F.col("gold")))


def gold_extract(spark: SparkSession, folder: str) -> DataFrame:
    return math_problems(spark, folder).select("o_orderkey", R.extract_gold(F.col("answer")).alias("gold"))


def gold_last_marker(spark: SparkSession, folder: str) -> DataFrame:
    """Gold answers of texts that hold several markers, or none."""
    return rollouts(spark, folder).select(*_KEY, R.extract_gold(F.col("completion")).alias("gold_text"))


def number_normalize(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    return documents.select("doc_id", R.normalize_number(F.col("text")).alias("number"))


def predicted_answer(spark: SparkSession, folder: str) -> DataFrame:
    return rollouts(spark, folder).select(*_KEY, R.predicted_answer(F.col("completion")).alias("predicted"))


def predicted_answer_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    return documents.select("doc_id", R.predicted_answer(F.col("text")).alias("predicted"))


def correctness_reward(spark: SparkSession, folder: str) -> DataFrame:
    reward = R.correctness_reward(F.col("completion"), F.col("gold"))
    return rollouts(spark, folder).select(*_KEY, reward.alias("correctness"))


def format_reward(spark: SparkSession, folder: str) -> DataFrame:
    return rollouts(spark, folder).select(*_KEY, R.format_reward(F.col("completion")).alias("format"))


def reward_set(spark: SparkSession, folder: str) -> DataFrame:
    scored = score_completions(rollouts(spark, folder), "gsm8k", "completion", "gold")
    return scored.select(*_KEY, "correctness", "format", "reward_total")


def chat_completions(spark: SparkSession, folder: str) -> DataFrame:
    """The reward set over completions that are message lists: the last message is graded."""
    turn = F.array(
        F.struct(F.lit("user").alias("role"), F.lit("1 + 1?").alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.col("completion").alias("content")),
    )
    chats = rollouts(spark, folder).withColumn("completion", turn)
    scored = score_completions(chats, "gsm8k", "completion", "gold")
    return scored.select(*_KEY, "correctness", "format", "reward_total")


def gsm8k_score(spark: SparkSession, folder: str) -> DataFrame:
    return scored_rollouts(spark, folder).select(*_KEY, "reward")


def score_by_data_source(spark: SparkSession, folder: str) -> DataFrame:
    scored = score_routed(rollouts(spark, folder), "data_source", "completion", "gold", fail=False)
    return scored.select(*_KEY, "score", "reject_reason")


def sample_rows(df: DataFrame) -> DataFrame:
    """Rollouts in the shape of delivered samples; a row without data source has no metadata."""
    metadata = F.when(F.col("data_source").isNotNull(), F.struct("data_source"))
    return df.select(
        *_KEY, F.col("completion").alias("response"), F.col("gold").alias("label"), metadata.alias("metadata")
    )


def score_delivered_samples(spark: SparkSession, folder: str) -> DataFrame:
    scored = score_samples(sample_rows(rollouts(spark, folder)), fail=False)
    return scored.select(*_KEY, "score", "reject_reason")


def weighted_rubric(spark: SparkSession, folder: str) -> DataFrame:
    """Rollouts without a usable turn grade as empty text; weights 1.0 and 0.5."""
    turn = F.struct(F.lit("assistant").alias("role"), F.col("completion").alias("content"))
    turns = F.when(F.col("has_eos"), F.array(turn)).otherwise(F.array().cast("array<struct<role:string,content:string>>"))
    text = R.rollout_text(turns)
    total = R.weighted_rubric([(1.0, R.gsm8k_score(text, F.col("gold"))), (0.5, R.format_reward(text))])
    return rollouts(spark, folder).select(*_KEY, F.round(total, 6).alias("rubric"))


def gsm8k_prompt_format(spark: SparkSession, folder: str) -> DataFrame:
    records = from_gsm8k(math_problems(spark, folder), keep=["o_orderkey"])
    lines = F.transform("prompt", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return records.select("o_orderkey", F.array_join(lines, "\n").alias("prompt_text"), "answer")


_ROUTED_SQL = f"""SELECT prompt_id, sample_no,
    CASE WHEN data_source = 'gsm8k' THEN {score_sql()} END AS score,
    CASE WHEN data_source IS DISTINCT FROM 'gsm8k'
        THEN 'no reward scorer for data_source: ' || coalesce(data_source, 'null') END AS reject_reason
    FROM {ROLLOUT_SQL}"""
_SET_SQL = f"""SELECT prompt_id, sample_no, {correct_sql('completion', 'gold')} AS correctness,
    {format_sql('completion')} AS format, {score_sql()} AS reward_total FROM {ROLLOUT_SQL}"""
_TURN_TEXT = "(CASE WHEN has_eos THEN completion ELSE '' END)"

QUERIES = {
    "gold_extract": gold_extract,
    "gold_last_marker": gold_last_marker,
    "number_normalize": number_normalize,
    "predicted_answer": predicted_answer,
    "predicted_answer_documents": predicted_answer_documents,
    "correctness_reward": correctness_reward,
    "format_reward": format_reward,
    "reward_set": reward_set,
    "chat_completions": chat_completions,
    "gsm8k_score": gsm8k_score,
    "score_routed": score_by_data_source,
    "score_samples": score_delivered_samples,
    "weighted_rubric": weighted_rubric,
    "gsm8k_prompt_format": gsm8k_prompt_format,
}

ORACLE = {
    "gold_extract": f"SELECT o_orderkey, CAST(whole AS VARCHAR) AS gold FROM {MATH_SQL}",
    "gold_last_marker": f"""SELECT prompt_id, sample_no, replace(regexp_replace(
        list_extract(string_split(completion, '####'), -1), '^\\s+|\\s+$', '', 'g'), ',', '') AS gold_text
        FROM {ROLLOUT_SQL}""",
    "number_normalize": f"SELECT doc_id, {norm_sql('text')} AS number FROM documents",
    "predicted_answer": f"SELECT prompt_id, sample_no, {predicted_sql('completion')} AS predicted FROM {ROLLOUT_SQL}",
    "predicted_answer_documents": f"SELECT doc_id, {predicted_sql('text')} AS predicted FROM documents",
    "correctness_reward": f"""SELECT prompt_id, sample_no, {correct_sql('completion', 'gold')} AS correctness
        FROM {ROLLOUT_SQL}""",
    "format_reward": f"SELECT prompt_id, sample_no, {format_sql('completion')} AS format FROM {ROLLOUT_SQL}",
    "reward_set": _SET_SQL,
    "chat_completions": _SET_SQL,
    "gsm8k_score": f"SELECT prompt_id, sample_no, reward FROM {SCORED_SQL}",
    "score_routed": _ROUTED_SQL,
    "score_samples": _ROUTED_SQL,
    "weighted_rubric": f"""SELECT prompt_id, sample_no,
        round({score_sql(_TURN_TEXT)} + 0.5::DOUBLE * {format_sql(_TURN_TEXT)}, 6) AS rubric FROM {ROLLOUT_SQL}""",
    "gsm8k_prompt_format": f"""SELECT o_orderkey, 'system: Solve the math problem. Reason step by step, then give the '
        || 'final numeric answer on the last line after ''#### ''.' || chr(10) || 'user: ' || question AS prompt_text,
        CAST(whole AS VARCHAR) AS answer FROM {MATH_SQL}""",
}
