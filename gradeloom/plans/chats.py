"""Conversation queries: assembly, validation, chat text, loss spans, framework rows."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions import chat as C
from gradeloom.operators.conversations import (
    is_last_part,
    part_lengths,
    render_turns,
    split_common_parts,
    with_part_offset,
    with_whole,
)
from gradeloom.operators.conversations import loss_coverage as coverage_of
from gradeloom.operators.formats import get_format, slime_file_rows, with_data_source
from gradeloom.operators.validate import validate_messages, with_reject_reason
from gradeloom.plans.inputs import (
    LONG_TURN,
    LONG_TURN_SQL,
    MATH_SQL,
    ODD_TURN,
    ODD_TURN_SQL,
    TURN,
    TURN_SQL,
    conversations,
    derive,
    math_problems,
    preference_rows,
)
from gradeloom.sources.adapters import GSM8K_SYSTEM, get_source
from gradeloom.sources.readers import read_table


def flat(messages: str) -> Column:
    """Messages as one text, for comparison with plain SQL."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")


def count_of(messages: str) -> Column:
    return F.size(messages).cast("long")


_PARTS = ["conv_id", "part", "n_parts"]


def odd_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations with unknown roles, and every fifth one stripped down to its system messages."""
    system_only = F.filter("messages", lambda m: m["role"] == "system")
    messages = F.when(F.col("conv_id") % 5 == 0, system_only).otherwise(F.col("messages"))
    return conversations(spark, folder, ODD_TURN).withColumn("messages", messages)


def assemble(spark: SparkSession, folder: str) -> DataFrame:
    return conversations(spark, folder).select(
        *_PARTS, count_of("messages").alias("n_messages"), flat("messages").alias("text")
    )


def normalize_conversations(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = validate_messages(odd_conversations(spark, folder), ["messages"], conv="conv_id")
    # A part of a usable conversation may have lost all of its messages.
    records = get_source("traceinversion")(good.where(F.size("messages") > 0), keep=_PARTS)
    return records.select(*_PARTS, count_of("messages").alias("n_messages"), flat("messages").alias("text"))


def reject_conversations(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = validate_messages(odd_conversations(spark, folder), ["messages"], conv="conv_id")
    return bad.select(*_PARTS, "reject_reason", count_of("messages").alias("n_messages"))


def reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations by outcome, each counted at its first part."""
    marked = with_reject_reason(odd_conversations(spark, folder), ["messages"], "conv_id")
    first = with_whole(marked, {"first": (F.min("part"), F.col("part"))}).where(F.col("part") == F.col("first"))
    return first.groupBy(F.coalesce("reject_reason", F.lit("usable")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n")
    )


def sft_messages(spark: SparkSession, folder: str) -> DataFrame:
    rows = get_format("sft", "trl")(get_source("traceinversion")(conversations(spark, folder), keep=_PARTS))
    return rows.select(*_PARTS, count_of("messages").alias("n_messages"), flat("messages").alias("text"))


def _preference_format(rows: DataFrame) -> DataFrame:
    shaped = get_format("dpo", "trl")(get_source("ultrafeedback")(rows, keep=_PARTS))
    return shaped.select(*_PARTS, flat("chosen").alias("chosen_text"), flat("rejected").alias("rejected_text"))


def preference_format(spark: SparkSession, folder: str) -> DataFrame:
    return _preference_format(preference_rows(spark, folder))


def preference_format_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The same with three turns to a part: only the last message of the conversation is cut."""
    return _preference_format(preference_rows(spark, folder, part_turns=3))


def prompt_only_format(spark: SparkSession, folder: str) -> DataFrame:
    prompts = conversations(spark, folder).withColumnRenamed("messages", "prompt")
    rows = get_format("online_dpo", "trl")(get_source("ultrafeedback_prompt")(prompts, keep=_PARTS))
    return rows.select(*_PARTS, flat("prompt").alias("prompt_text"))


def long_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict, size, loss coverage and number of cues of conversations that are longer than a part."""
    parts = conversations(spark, folder, LONG_TURN, "events")
    marked = with_reject_reason(parts, ["messages"], "conv_id")
    chat = C.render_chat(F.col("messages"), is_last_part())
    rows = marked.withColumns({"chars": F.length(chat), "cued": F.endswith(chat, F.lit(C.CUE)).cast("long")})
    whole = rows.groupBy("conv_id", "reject_reason").agg(
        F.sum(count_of("messages")).alias("n_messages"), F.sum("chars").cast("long").alias("chars"), F.sum("cued").alias("n_cues")
    )
    share = coverage_of(parts).select("conv_id", F.round("coverage", 6).alias("coverage"))
    return whole.join(share, "conv_id")


def long_conversation_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Loss spans of the usable ones among them, counted from the start of the conversation."""
    turns = derive(read_table(spark, folder, "events"), LONG_TURN)
    good, _ = validate_messages(conversations(spark, folder, LONG_TURN, "events"), ["messages"], conv="conv_id")
    return _spans(good, turns)


def trl_grpo_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = get_format("grpo", "trl")(get_source("gsm8k")(math_problems(spark, folder)))
    return rows.select(flat("prompt").alias("prompt_text"), "answer")


def verl_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = get_format("grpo", "verl")(get_source("gsm8k")(math_problems(spark, folder)))
    return with_data_source(rows, "gsm8k")


def slime_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = get_format("ppo", "slime")(get_source("gsm8k")(math_problems(spark, folder)))
    return slime_file_rows(rows, "gsm8k")


def verl_format(spark: SparkSession, folder: str) -> DataFrame:
    return verl_rows(spark, folder).select(
        flat("prompt").alias("prompt_text"),
        F.col("reward_model.style").alias("style"),
        F.col("reward_model.ground_truth").alias("ground_truth"),
        "data_source",
    )


def slime_format(spark: SparkSession, folder: str) -> DataFrame:
    return slime_rows(spark, folder).select("prompt", "label", F.col("metadata.data_source").alias("data_source"))


def chat_render(spark: SparkSession, folder: str) -> DataFrame:
    return conversations(spark, folder).select(*_PARTS, C.render_chat(F.col("messages")).alias("chat"))


def chat_render_generation(spark: SparkSession, folder: str) -> DataFrame:
    return conversations(spark, folder).select(*_PARTS, C.render_chat(F.col("messages"), is_last_part()).alias("chat"))


def chat_render_turns(spark: SparkSession, folder: str) -> DataFrame:
    turns = derive(read_table(spark, folder, "conversations"), TURN)
    return render_turns(turns, content="content").select(*_PARTS, F.col("text").alias("chat"))


def _spans(parts: DataFrame, turns: DataFrame) -> DataFrame:
    placed = with_part_offset(parts, part_lengths(turns, content="content"))
    spans = placed.select("conv_id", "offset", F.explode(C.assistant_spans(F.col("messages"))).alias("span"))
    return spans.select(
        "conv_id",
        (F.col("offset") + F.col("span.start")).alias("span_start"),
        (F.col("offset") + F.col("span.end")).alias("span_end"),
    )


def assistant_spans(spark: SparkSession, folder: str) -> DataFrame:
    return _spans(conversations(spark, folder), derive(read_table(spark, folder, "conversations"), TURN))


def loss_coverage(spark: SparkSession, folder: str) -> DataFrame:
    share = coverage_of(conversations(spark, folder))
    return share.select(
        "conv_id", F.round("coverage", 6).alias("coverage"), (F.col("coverage") == 0.0).alias("nothing_to_learn")
    )


def boxed_prompt(spark: SparkSession, folder: str) -> DataFrame:
    asked = F.concat("question", F.lit(" Put the answer in a box."))
    return math_problems(spark, folder).select("o_orderkey", C.render_user_prompt(asked).alias("prompt"))


def common_prompt_split(spark: SparkSession, folder: str) -> DataFrame:
    return split_common_parts(preference_rows(spark, folder)).select(
        *_PARTS,
        count_of("prompt").alias("n_prompt"),
        flat("chosen").alias("chosen_text"),
        flat("rejected").alias("rejected_text"),
    )


def _part_sql(size: int = 1024) -> str:
    """Columns `part` and `n_parts` of turns, for queries over turns of one row each."""
    part = f"CAST(floor(turn / {size}) AS BIGINT)"
    return f"{part} AS part, max({part}) OVER (PARTITION BY conv_id) + 1 AS n_parts"


def _grouped_sql(turns: str) -> str:
    return f"""(SELECT conv_id, part, n_parts, count(*) AS n_messages,
        string_agg(role || ':' || content, '|' ORDER BY turn) AS text
        FROM (SELECT *, {_part_sql()} FROM {turns}) GROUP BY conv_id, part, n_parts)"""


_ODD = f"""(SELECT *, {_part_sql()}, conv_id % 5 <> 0 OR role = 'system' AS kept FROM {ODD_TURN_SQL})"""
_VERDICT = f"""(SELECT *, CASE WHEN total = 0 THEN 'empty conversation' WHEN odd THEN 'unknown role' END AS reject_reason
    FROM (SELECT conv_id, part, n_parts, count(*) FILTER (kept) AS n_messages,
        sum(count(*) FILTER (kept)) OVER (PARTITION BY conv_id) AS total,
        coalesce(bool_or(bool_or(role NOT IN ('system', 'user', 'assistant')) FILTER (kept))
            OVER (PARTITION BY conv_id), false) AS odd,
        string_agg(role || ':' || content, '|' ORDER BY turn) FILTER (kept) AS text
        FROM {_ODD} GROUP BY conv_id, part, n_parts))"""
_CHAT = f"""(SELECT conv_id, part, n_parts, string_agg('<|im_start|>' || role || chr(10) || content || '<|im_end|>'
    || chr(10), '' ORDER BY turn) AS chat FROM (SELECT *, {_part_sql()} FROM {TURN_SQL}) GROUP BY conv_id, part, n_parts)"""
_BLOCKS = f"""(SELECT conv_id, turn, role, length(role) + 13 AS head,
    length('<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10)) AS n FROM {TURN_SQL})"""


def _cut_sql(size: int = 1024) -> str:
    return f"""(SELECT *, turn = max(turn) OVER (PARTITION BY conv_id) AS is_last, substr(content, 1, 20) AS short,
        {_part_sql(size)} FROM {TURN_SQL})"""


def _preference_sql(size: int = 1024) -> str:
    return f"""SELECT conv_id, part, n_parts, string_agg(role || ':' || content, '|' ORDER BY turn) AS chosen_text,
        string_agg(role || ':' || CASE WHEN is_last THEN short ELSE content END, '|' ORDER BY turn) AS rejected_text
        FROM {_cut_sql(size)} GROUP BY conv_id, part, n_parts"""


_LONG_BLOCKS = f"""(SELECT conv_id, turn, role, length(role) + 13 AS head, length(role || content) + 24 AS n FROM {LONG_TURN_SQL})"""
_SYSTEM = GSM8K_SYSTEM.replace("'", "''")
_PROMPT = f"'system:{_SYSTEM}|user:' || question"

QUERIES = {
    "assemble_conversations": assemble,
    "normalize_conversations": normalize_conversations,
    "reject_conversations": reject_conversations,
    "reject_counts": reject_counts,
    "sft_messages": sft_messages,
    "preference_format": preference_format,
    "preference_format_parts": preference_format_parts,
    "prompt_only_format": prompt_only_format,
    "long_conversations": long_conversations,
    "long_conversation_spans": long_conversation_spans,
    "trl_grpo_format": trl_grpo_format,
    "verl_format": verl_format,
    "slime_format": slime_format,
    "chat_render": chat_render,
    "chat_render_generation": chat_render_generation,
    "chat_render_turns": chat_render_turns,
    "assistant_spans": assistant_spans,
    "loss_coverage": loss_coverage,
    "boxed_prompt": boxed_prompt,
    "common_prompt_split": common_prompt_split,
}

ORACLE = {
    "assemble_conversations": f"SELECT * FROM {_grouped_sql(TURN_SQL)}",
    "normalize_conversations": f"""SELECT conv_id, part, n_parts, n_messages, text FROM {_VERDICT}
        WHERE reject_reason IS NULL AND n_messages > 0""",
    "reject_conversations": f"""SELECT conv_id, part, n_parts, reject_reason, n_messages FROM {_VERDICT}
        WHERE reject_reason IS NOT NULL""",
    "reject_counts": f"""SELECT coalesce(reject_reason, 'usable') AS outcome, count(DISTINCT conv_id) AS n
        FROM {_VERDICT} GROUP BY 1""",
    "sft_messages": f"SELECT * FROM {_grouped_sql(TURN_SQL)}",
    "preference_format": _preference_sql(),
    "preference_format_parts": _preference_sql(3),
    "prompt_only_format": f"SELECT conv_id, part, n_parts, text AS prompt_text FROM {_grouped_sql(TURN_SQL)}",
    "long_conversations": f"""SELECT conv_id, CASE WHEN bool_or(role = 'wizard') THEN 'unknown role' END AS reject_reason,
        count(*) AS n_messages, CAST(sum(n) + 22 AS BIGINT) AS chars, CAST(1 AS BIGINT) AS n_cues,
        round(coalesce(sum(n - head) FILTER (role = 'assistant'), 0)::DOUBLE / sum(n), 6) AS coverage
        FROM {_LONG_BLOCKS} GROUP BY conv_id""",
    "long_conversation_spans": f"""SELECT conv_id, CAST(after - n + head AS BIGINT) AS span_start,
        CAST(after AS BIGINT) AS span_end
        FROM (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) AS after FROM {_LONG_BLOCKS})
        WHERE role = 'assistant' AND conv_id NOT IN (SELECT conv_id FROM {_LONG_BLOCKS} WHERE role = 'wizard')""",
    "trl_grpo_format": f"SELECT {_PROMPT} AS prompt_text, CAST(whole AS VARCHAR) AS answer FROM {MATH_SQL}",
    "verl_format": f"""SELECT {_PROMPT} AS prompt_text, 'rule' AS style, CAST(whole AS VARCHAR) AS ground_truth,
        'gsm8k' AS data_source FROM {MATH_SQL}""",
    "slime_format": f"""SELECT '<|im_start|>system' || chr(10) || '{_SYSTEM}' || '<|im_end|>' || chr(10)
        || '<|im_start|>user' || chr(10) || question || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)
        AS prompt, CAST(whole AS VARCHAR) AS label, 'gsm8k' AS data_source FROM {MATH_SQL}""",
    "chat_render": f"SELECT * FROM {_CHAT}",
    "chat_render_generation": f"""SELECT conv_id, part, n_parts, chat || CASE WHEN part = n_parts - 1
        THEN '<|im_start|>assistant' || chr(10) ELSE '' END AS chat FROM {_CHAT}""",
    "chat_render_turns": f"SELECT * FROM {_CHAT}",
    "assistant_spans": f"""SELECT conv_id, CAST(after - n + head AS BIGINT) AS span_start,
        CAST(after AS BIGINT) AS span_end
        FROM (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) AS after FROM {_BLOCKS})
        WHERE role = 'assistant'""",
    "loss_coverage": f"""SELECT conv_id,
        round(coalesce(sum(n - head) FILTER (role = 'assistant'), 0)::DOUBLE / sum(n), 6) AS coverage,
        coalesce(sum(n - head) FILTER (role = 'assistant'), 0) = 0 AS nothing_to_learn FROM {_BLOCKS} GROUP BY conv_id""",
    "boxed_prompt": f"""SELECT o_orderkey, '<|im_start|>user' || chr(10) || question || ' Put the answer in a box.'
        || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt FROM {MATH_SQL}""",
    "common_prompt_split": f"""SELECT conv_id, part, n_parts,
        count(*) - count(*) FILTER (is_last AND length(content) > 20) AS n_prompt,
        coalesce(max(role || ':' || content) FILTER (is_last AND length(content) > 20), '') AS chosen_text,
        coalesce(max(role || ':' || short) FILTER (is_last AND length(content) > 20), '') AS rejected_text
        FROM {_cut_sql()} GROUP BY conv_id, part, n_parts""",
}
