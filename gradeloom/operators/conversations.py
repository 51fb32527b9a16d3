"""From one row per turn to one row per conversation."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gradeloom.functions.chat import block_chars, chat_chars, render_block, trainable_chars
from gradeloom.functions.messages import as_text, common_prefix_size, split_common_prompt
from gradeloom.operators.scan import FAN, LEVELS, sum_before

# Turns per row. A conversation beyond this continues in further rows, so no row and no task has
# to hold an unbounded conversation. A part is storage only: whatever is decided about a conversation
# is decided about all of its parts.
PART_TURNS = 1024


def _part(turn: str, part_turns: int | None) -> Column:
    return F.floor(F.col(turn) / (part_turns or PART_TURNS)).cast("long").alias("part")


def _parts(turns: DataFrame, conv: str, turn: str, part_turns: int | None, payload: list[Column]) -> DataFrame:
    """`(conv, part, n_parts, _turns)`. Only conversations of several parts have a number to join: it comes
    from a narrow aggregate that is there long before the turns are, and Spark broadcasts it if it is small.

    Turns that do not count 0, 1, 2, ... make the job fail when `_turns` is read. A part shows by itself that its
    turns follow each other from its start; then no part is cut short or missing if a conversation has
    as many turns as its last one says.
    """
    size = part_turns or PART_TURNS
    grouped = turns.groupBy(F.col(conv), _part(turn, part_turns)).agg(
        F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), *payload))).alias("_turns")
    )
    in_row = ~F.exists(F.transform("_turns", lambda t, i: F.coalesce(t["turn"] == F.col("part") * size + i, F.lit(False))), lambda ok: ~ok)
    last = turns.groupBy(conv).agg(F.max(_part(turn, part_turns)).alias("_last"), (F.count(turn) == F.max(turn) + 1).alias("_counted"))
    joined = grouped.join(last.where(F.col("_last") > 0), conv, "left")
    wrong = F.raise_error(F.lit("turns of a conversation do not count 0, 1, 2, ...")).cast(grouped.schema["_turns"].dataType)
    checked = F.when(in_row & (F.col("part") >= 0) & F.coalesce("_counted", F.lit(True)), F.col("_turns")).otherwise(wrong)
    return joined.withColumns({"_turns": checked, "n_parts": F.coalesce("_last", F.lit(0)) + 1}).drop("_last", "_counted")


def with_whole(parts: DataFrame, facts: dict[str, tuple[Column, Column]], conv: str = "conv_id") -> DataFrame:
    """Add facts of the whole conversation to each of its parts.

    A fact is an aggregate over parts, and what it comes to for a conversation of one part. Parts of
    long conversations are aggregated with map-side combine and get the result by a join on one row
    per long conversation; other conversations have nothing to join.
    """
    named = [whole.alias(f"_{name}") for name, (whole, _) in facts.items()]
    long = parts.where(F.col("n_parts") > 1).groupBy(conv).agg(*named)
    values = {n: F.when(F.col("n_parts") > 1, F.col(f"_{n}")).otherwise(own) for n, (_, own) in facts.items()}
    return parts.join(long, conv, "left").withColumns(values).drop(*[f"_{name}" for name in facts])


def is_last_part() -> Column:
    return F.col("part") == F.col("n_parts") - 1


def assemble_conversations(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    part_turns: int | None = None,
) -> DataFrame:
    """`(conv, part, n_parts, messages)`, messages in turn order.

    `turn` counts 0, 1, 2, ... within a conversation. One of up to `part_turns` turns is one row
    with part 0; a longer one goes on in parts 1, 2, ... of `part_turns` turns each. Chat text of
    parts, put one after the other, is the chat text of the conversation. One shuffle, on (conv, part).
    """
    grouped = _parts(turns, conv, turn, part_turns, [F.col(role).alias("role"), F.col(content).alias("content")])
    messages = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return grouped.select(conv, "part", "n_parts", messages.alias("messages"))


def render_turns(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    part_turns: int | None = None,
) -> DataFrame:
    """`(conv, part, n_parts, text)`: chat text straight from turns, blocks built before the shuffle."""
    words = as_text(F.col(content), turns.schema[content].dataType)
    block = render_block(F.col(role), words).alias("block")
    grouped = _parts(turns, conv, turn, part_turns, [block])
    return grouped.select(conv, "part", "n_parts", F.array_join(F.col("_turns.block"), "").alias("text"))


def part_lengths(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    part_turns: int | None = None,
) -> DataFrame:
    """`(conv, part, chars)`: length of each part's chat text, added up before the shuffle."""
    words = as_text(F.col(content), turns.schema[content].dataType)
    chars = F.sum(block_chars(F.col(role), words)).alias("chars")
    return turns.groupBy(F.col(conv), _part(turn, part_turns)).agg(chars)


def with_part_offset(
    parts: DataFrame, lengths: DataFrame, conv: str = "conv_id", fan: int = FAN, levels: int = LEVELS
) -> DataFrame:
    """Add `offset`, the number of characters before each part in its whole conversation.

    The running sum goes over `(conv, part, chars)` alone, one row per `part_turns` turns, piece by piece, so
    neither the texts nor the lengths of a long conversation are ever brought together. Only later parts have
    an offset to join; where no conversation is long the join falls away at run time.
    """
    offsets = sum_before(lengths.select(conv, "part", "chars"), [conv], "part", "chars", "_offset", fan, levels)
    offsets = offsets.where(F.col("part") > 0).drop("chars")
    placed = parts.join(offsets, [conv, "part"], "left")
    return placed.withColumn("offset", F.coalesce(F.col("_offset"), F.lit(0)).cast("long")).drop("_offset")


def loss_coverage(parts: DataFrame, conv: str = "conv_id") -> DataFrame:
    """`(conv, coverage)`: share of each whole conversation's chat text that carries loss."""
    trained, all_ = F.sum(trainable_chars(F.col("messages"))), F.sum(chat_chars(F.col("messages")))
    return parts.groupBy(conv).agg(F.try_divide(trained, all_).alias("coverage"))


def split_common_parts(parts: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Shared leading messages of `chosen` and `rejected` as `prompt`, and what is left of either side.

    Both sides have the same parts. Parts before the first one that differs are prompt as they are, parts
    after it belong to the two sides.
    """
    shared = common_prefix_size(F.col("chosen"), F.col("rejected"))
    differs = F.when(shared < F.greatest(F.size("chosen"), F.size("rejected")), F.col("part"))
    placed = with_whole(parts, {"_differs": (F.min(differs), differs)}, conv)
    cut = split_common_prompt(F.col("chosen"), F.col("rejected"))
    later = F.coalesce(F.col("part") > F.col("_differs"), F.lit(False))
    none = F.slice("chosen", 1, 0)
    columns = {
        "prompt": F.when(later, none).otherwise(cut["prompt"]),
        "chosen": F.when(later, F.col("chosen")).otherwise(cut["chosen"]),
        "rejected": F.when(later, F.col("rejected")).otherwise(cut["rejected"]),
    }
    return placed.select(conv, "part", "n_parts", *[c.alias(n) for n, c in columns.items()])
