"""Inputs derived from the given tables.

Each derivation is a list of column expressions that Spark SQL and the checking engine both
understand, so the two sides start from the same rows.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.operators.conversations import assemble_conversations, is_last_part
from gradeloom.sources.readers import read_table

_Q = "CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING)"
_NL = "chr(10)"
_BOX = "chr(92) || 'boxed{'"

# Completions in all the shapes that the grading rules tell apart.
_COMPLETION = f"""CASE l_partkey % 12
    WHEN 0 THEN 'work' || {_NL} || '#### ' || {_Q}
    WHEN 1 THEN 'so ' || {_BOX} || CAST(CAST(floor(l_quantity) AS BIGINT) + 1 AS STRING) || '}}'
    WHEN 2 THEN 'just ' || {_Q} || ' somewhere'
    WHEN 3 THEN 'no idea'
    WHEN 4 THEN {_BOX} || {_Q} || '.0}} #### 9'
    WHEN 5 THEN 'try ' || {_Q} || {_NL} || 'it is 1,0' || {_Q} || '.'
    WHEN 6 THEN '####' || {_NL} || {_Q} || '  '
    WHEN 7 THEN {_BOX} || '}} #### ' || {_Q} || '.00'
    WHEN 8 THEN 'a' || {_NL} || {_Q} || ' then 7'
    WHEN 9 THEN {_Q} || ' apples' || {_NL}
    WHEN 10 THEN '#### ' || {_Q} || {_NL} || '#### 2'
    ELSE '####   '
END"""

ROLLOUT = {
    "prompt_id": "l_orderkey",
    "sample_no": "CAST(l_linenumber AS BIGINT)",
    "completion": _COMPLETION,
    "gold": _Q,
    "data_source": "CASE WHEN l_returnflag = 'R' THEN 'unlisted' WHEN l_suppkey % 10 = 0 THEN NULL ELSE 'gsm8k' END",
    "rm_score": "l_extendedprice / 1000.0",
    "has_eos": "l_linestatus = 'F'",
    "kl": "l_discount",
}

STEP = {
    "trajectory": "CAST(floor(event_id / 100) AS BIGINT)",
    "step": "event_id % 100",
    "reward": "value / 7.0",
    "value": "CAST((event_id * 7) % 13 AS DOUBLE) / 9.0",
}

MATH = {
    "o_orderkey": "o_orderkey",
    "question": "'What does order ' || CAST(o_orderkey AS STRING) || ' cost?'",
    "whole": "CAST(floor(o_totalprice) AS BIGINT)",
}

_METHOD = """CASE c_custkey % 7 WHEN 0 THEN 'pretrain' WHEN 1 THEN 'sft' WHEN 2 THEN 'dpo'
    WHEN 3 THEN 'online_dpo' WHEN 4 THEN 'grpo' WHEN 5 THEN 'ppo' ELSE NULL END"""
_FRAMEWORK = """CASE c_nationkey % 6 WHEN 0 THEN 'trl' WHEN 1 THEN 'unsloth' WHEN 2 THEN 'verl'
    WHEN 3 THEN 'slime' WHEN 4 THEN 'megatron-lm' ELSE 'torchtitan' END"""

RUN = {
    "run_id": "c_custkey",
    "method": _METHOD,
    "framework": _FRAMEWORK,
    "tuning": "CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'lora' ELSE 'full' END",
    "model_name": "CASE c_nationkey % 4 WHEN 0 THEN 'hub/' || c_mktsegment WHEN 1 THEN '' WHEN 2 THEN c_mktsegment END",
    "model_size": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '4b' END",
    "source": "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE lower(c_mktsegment) END",
    "nodes": "CASE WHEN c_custkey % 4 > 0 THEN CAST(c_custkey % 4 AS INT) END",
    "gpus": "CASE c_nationkey % 3 WHEN 1 THEN 1 WHEN 2 THEN 8 END",
    "smoke": "c_custkey % 11 = 0",
    "max_steps": "CASE c_custkey % 13 WHEN 0 THEN 5 WHEN 1 THEN 0 WHEN 2 THEN NULL ELSE -1 END",
    "project": "CASE WHEN c_custkey % 3 = 0 THEN 'own-' || lower(c_mktsegment) END",
    "log_every": "CASE WHEN c_custkey % 17 = 0 THEN 25 END",
}

METRIC = {
    "run_id": "user_id",
    "step": "CAST(floor(event_id / 20) AS BIGINT) + 1",
    "metric": "event_type",
    "value": "value",
    "ts": "ts",
}

# One configuration key and value per expression; long form on both sides.
CONFIG = {
    "dataset.source": "c_mktsegment",
    "scale.nodes": "CAST(c_custkey % 4 AS STRING)",
    "hp.epochs": "'3'",
    "hp.lr_scheduler": "CASE WHEN c_nationkey > 12 THEN 'cosine' ELSE 'linear' END",
}


def _select(columns: dict[str, str], table: str) -> str:
    listed = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"(SELECT {listed} FROM {table})"


ROLLOUT_SQL = _select(ROLLOUT, "lineitem")
STEP_SQL = _select(STEP, "events")
RUN_SQL = _select(RUN, "customer")
METRIC_SQL = _select(METRIC, "events")
MATH_SQL = f"""(SELECT *, 'Add up the lines.' || chr(10) || '#### ' || format('{{:,}}', whole) AS answer
    FROM {_select(MATH, "orders")})"""
CONFIG_SQL = "(" + " UNION ALL ".join(
    f"SELECT c_custkey AS run_id, '{key}' AS key, {sql} AS value FROM customer" for key, sql in CONFIG.items()
) + ")"

# Turns of the conversation table, and the same with a role nobody knows in every seventh one.
TURN = {"conv_id": "conv_id", "turn": "turn", "role": "role", "content": "text"}
ODD_TURN = TURN | {
    "role": "CASE WHEN conv_id % 7 = 0 AND role = 'user' AND turn > 2 THEN 'wizard' ELSE role END",
}
TURN_SQL = _select(TURN, "conversations")
ODD_TURN_SQL = _select(ODD_TURN, "conversations")


def derive(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


def rollouts(spark: SparkSession, folder: str) -> DataFrame:
    return derive(read_table(spark, folder, "lineitem"), ROLLOUT)


def steps(spark: SparkSession, folder: str) -> DataFrame:
    return derive(read_table(spark, folder, "events"), STEP)


def runs(spark: SparkSession, folder: str) -> DataFrame:
    return derive(read_table(spark, folder, "customer"), RUN)


def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return derive(read_table(spark, folder, "events"), METRIC)


def run_config(spark: SparkSession, folder: str) -> DataFrame:
    entries = ", ".join(f"'{key}', {sql}" for key, sql in CONFIG.items())
    customers = read_table(spark, folder, "customer")
    return customers.selectExpr("c_custkey AS run_id", f"stack({len(CONFIG)}, {entries}) AS (key, value)")


def math_problems(spark: SparkSession, folder: str) -> DataFrame:
    df = derive(read_table(spark, folder, "orders"), MATH)
    tail = F.format_number("whole", 0)
    return df.select("o_orderkey", "question", F.concat(F.lit("Add up the lines.\n#### "), tail).alias("answer"))


# Events as conversations of thousands of turns, far beyond the size of a part.
LONG_TURN = {
    "conv_id": "event_id % 5",
    "turn": "CAST(floor(event_id / 5) AS BIGINT)",
    "role": """CASE WHEN event_id % 5 = 3 AND floor(event_id / 5) = 3 THEN 'wizard'
        WHEN floor(event_id / 5) % 2 = 0 THEN 'user' WHEN event_id % 5 = 4 THEN 'system' ELSE 'assistant' END""",
    "content": "event_type || ' ' || CAST(user_id AS STRING)",
}
LONG_TURN_SQL = _select(LONG_TURN, "events")


def conversations(
    spark: SparkSession, folder: str, turns: dict[str, str] = TURN, table: str = "conversations", part_turns: int | None = None
) -> DataFrame:
    rows = derive(read_table(spark, folder, table), turns)
    return assemble_conversations(rows, content="content", part_turns=part_turns)


def preference_rows(spark: SparkSession, folder: str, part_turns: int | None = None) -> DataFrame:
    """A conversation as chosen, and as rejected the same with its last message cut to 20 characters."""
    last = F.element_at("messages", -1)
    cut = F.struct(last["role"].alias("role"), F.substring(last["content"], 1, 20).alias("content"))
    shorter = F.array_append(F.slice("messages", 1, F.size("messages") - 1), cut)
    rejected = F.when(is_last_part(), shorter).otherwise(F.col("messages"))
    return conversations(spark, folder, part_turns=part_turns).select(
        "conv_id", "part", "n_parts", F.col("messages").alias("chosen"), rejected.alias("rejected")
    )


def corpus_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the documents, with a blank one and an empty one after each document."""
    padded = F.concat("text", F.lit("\n \t \n"))
    return read_table(spark, folder, "documents").select("doc_id", F.explode(F.split(padded, "\n")).alias("text"))


CORPUS_LINE_SQL = """(SELECT doc_id, unnest(string_split(text || chr(10) || ' ' || chr(9) || ' ' || chr(10), chr(10)))
    AS text FROM documents)"""
