"""Row shapes that training frameworks read, by (method, framework)."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.chat import resolve_chat_template

Format = Callable[[DataFrame], DataFrame]

# Long conversations are stored in parts; these columns say which rows belong together.
LAYOUT = ("conv_id", "part", "n_parts")


def _layout(df: DataFrame) -> list[str]:
    return [c for c in LAYOUT if c in df.columns]


def to_trl(df: DataFrame) -> DataFrame:
    """SFT rows: one `messages` column."""
    return df.select(*_layout(df), "messages")


def to_trl_dpo(df: DataFrame) -> DataFrame:
    """Preference rows whose prompt is the shared start of both sides."""
    return df.select(*_layout(df), "chosen", "rejected")


def to_trl_grpo(df: DataFrame) -> DataFrame:
    """Prompt plus the gold answer that the reward needs."""
    return df.select("prompt", "answer")


def to_trl_online_dpo(df: DataFrame) -> DataFrame:
    """Prompt only; both sides of a pair are generated later."""
    return df.select(*_layout(df), "prompt")


def to_verl_grpo(df: DataFrame) -> DataFrame:
    """Prompt plus a rule reward model that holds the gold answer."""
    reward_model = F.struct(F.lit("rule").alias("style"), F.col("answer").alias("ground_truth"))
    return df.select("prompt", reward_model.alias("reward_model"))


def to_slime_grpo(df: DataFrame) -> DataFrame:
    """Prompt plus the gold answer as `label`."""
    return df.select("prompt", F.col("answer").alias("label"))


# Which method and framework read which row shape.
_FORMATS: dict[str, dict[str, Format]] = {
    "sft": {"trl": to_trl, "unsloth": to_trl, "verl": to_trl, "slime": to_trl},
    "dpo": {"trl": to_trl_dpo, "unsloth": to_trl_dpo},
    "online_dpo": {"trl": to_trl_online_dpo},
    "grpo": {"trl": to_trl_grpo, "unsloth": to_trl_grpo, "verl": to_verl_grpo, "slime": to_slime_grpo},
    "ppo": {"verl": to_verl_grpo, "slime": to_slime_grpo},
}


def register_format(method: str, framework: str, build: Format) -> None:
    _FORMATS.setdefault(method, {})[framework] = build


def get_format(method: str, framework: str) -> Format:
    found = _FORMATS.get(method, {}).get(framework)
    if found is None:
        raise ValueError(f"{framework!r} has no row format for method {method!r}")
    return found


def with_data_source(df: DataFrame, name: str) -> DataFrame:
    """Add the key by which the scorer is chosen, as the verl trainer's file has it."""
    return df.withColumn("data_source", F.lit(name))


def slime_file_rows(df: DataFrame, data_source: str, template: str = "reasoning_chatml") -> DataFrame:
    """Rows of the slime trainer's file: rendered prompt, label, and the scorer's key as metadata."""
    render = resolve_chat_template(template)
    prompt = F.col("prompt") if render is None else render(F.col("prompt"), True)
    metadata = F.struct(F.lit(data_source).alias("data_source"))
    return df.select(prompt.alias("prompt"), "label", metadata.alias("metadata"))
