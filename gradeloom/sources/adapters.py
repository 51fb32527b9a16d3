"""From raw dataset rows to the canonical record of a method.

Every adapter takes the raw table, a validation mode (`fail` raises on the first bad row when the
job runs, `drop` leaves bad rows out; see `validate_messages` for keeping them aside) and the names
of columns to carry along.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.rewards import extract_gold
from gradeloom.operators.corpus import corpus_text
from gradeloom.operators.validate import (
    normalize_preference,
    normalize_prompt_only,
    normalize_rl_prompt,
    normalize_sft,
)

# Fixed value: the instruction that goes before every math problem.
GSM8K_SYSTEM = (
    "Solve the math problem. Reason step by step, then give the final numeric "
    "answer on the last line after '#### '."
)

Source = Callable[..., DataFrame]


def from_traceinversion(df: DataFrame, mode: str = "fail", keep: list[str] | None = None) -> DataFrame:
    """`messages` to SFT records."""
    return normalize_sft(df, mode, keep)


def from_ultrafeedback(df: DataFrame, mode: str = "fail", keep: list[str] | None = None) -> DataFrame:
    """`chosen` and `rejected` conversations to preference records."""
    return normalize_preference(df, mode, keep)


def from_ultrafeedback_prompt(df: DataFrame, mode: str = "fail", keep: list[str] | None = None) -> DataFrame:
    """`prompt` conversations to prompt-only records."""
    return normalize_prompt_only(df, mode, keep)


def from_gsm8k(df: DataFrame, mode: str = "fail", keep: list[str] | None = None) -> DataFrame:
    """`question` and worked `answer` to a two-message prompt and the gold number."""
    prompt = F.array(
        F.struct(F.lit("system").alias("role"), F.lit(GSM8K_SYSTEM).alias("content")),
        F.struct(F.lit("user").alias("role"), F.col("question").cast("string").alias("content")),
    )
    gold = extract_gold(F.col("answer"))
    if mode == "fail":
        gold = F.when(F.col("answer").isNull(), F.raise_error(F.lit("missing answer"))).otherwise(gold)
    else:
        df = df.where(F.col("answer").isNotNull())
    return normalize_rl_prompt(df.select(*(keep or []), prompt.alias("prompt"), gold.alias("answer")), mode, keep)


def from_corpus(df: DataFrame, drop_blank: bool = True) -> DataFrame:
    """Raw text rows; blanks are dropped on one of the two pretraining paths only."""
    return corpus_text(df, drop_blank)


_SOURCES: dict[str, Source] = {
    "traceinversion": from_traceinversion,
    "ultrafeedback": from_ultrafeedback,
    "ultrafeedback_prompt": from_ultrafeedback_prompt,
    "gsm8k": from_gsm8k,
}


def register_source(name: str, adapter: Source) -> None:
    _SOURCES[name] = adapter


def get_source(name: str) -> Source:
    if name not in _SOURCES:
        raise ValueError(f"no source is registered as {name!r}")
    return _SOURCES[name]
