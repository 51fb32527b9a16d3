"""Names, tags and logging rules of training runs, as expressions over a table of run settings."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The training methods, the frameworks, and which multi-node mechanism a
# (method, framework) pair uses.
METHODS = ("pretrain", "sft", "dpo", "online_dpo", "grpo", "ppo")
FRAMEWORKS = ("trl", "unsloth", "verl", "slime", "megatron-lm", "torchtitan")
MECHANISMS = {
    "pretrain/torchtitan": "torchrun",
    "pretrain/megatron-lm": "megatron",
    "sft/trl": "hf-torchrun",
    "sft/verl": "torchrun",
    "sft/megatron-lm": "megatron",
    "dpo/trl": "hf-torchrun",
    "online_dpo/trl": "hf-torchrun",
    "grpo/trl": "hf-torchrun",
    "grpo/verl": "ray",
    "grpo/slime": "ray",
    "grpo/megatron-lm": "megatron",
    "ppo/verl": "ray",
    "ppo/slime": "ray",
}


def _method() -> Column:
    return F.coalesce(F.col("method"), F.lit("sft"))


def _tuning() -> Column:
    return F.coalesce(F.col("tuning"), F.lit("full"))


def _nodes() -> Column:
    return F.coalesce(F.col("nodes"), F.lit(1))


def _gpus() -> Column:
    return F.coalesce(F.col("gpus"), F.lit(1))


def run_name() -> Column:
    """method-model-source-framework[-tuning][-mnN]; pretraining has no tuning part."""
    model = F.coalesce(F.nullif(F.col("model_name"), F.lit("")), F.col("model_size"), F.lit("?"))
    return F.concat_ws(
        "-",
        _method(),
        F.substring_index(model, "/", -1),
        F.coalesce(F.col("source"), F.lit("?")),
        F.col("framework"),
        F.when(_method() != "pretrain", _tuning()),
        F.when(_nodes() > 1, F.concat(F.lit("mn"), _nodes().cast("string"))),
    )


def tier() -> Column:
    """Scale of a run: one GPU, one node, or several nodes."""
    return F.when(_nodes() > 1, F.lit("mnmg")).when(_gpus() > 1, F.lit("snmg")).otherwise(F.lit("snsg"))


def is_smoke() -> Column:
    """A run cut short to check the wiring; not a measurement."""
    return F.coalesce(F.col("smoke"), F.lit(False)) | (F.coalesce(F.col("max_steps"), F.lit(-1)) > 0)


def mechanism() -> Column:
    """The multi-node mechanism of the run's (method, framework), or null."""
    table = F.create_map(*[F.lit(x) for pair in MECHANISMS.items() for x in pair])
    return F.try_element_at(table, F.concat(_method(), F.lit("/"), F.col("framework")))


def tags() -> Column:
    """Ordered labels of a run."""
    return F.array_compact(
        F.array(
            _method(),
            F.col("framework"),
            _tuning(),
            tier(),
            F.concat(F.lit("nodes-"), _nodes().cast("string")),
            F.concat(F.lit("gpus-"), _gpus().cast("string")),
            F.when(is_smoke(), F.lit("smoke")),
            F.when(_nodes() > 1, F.concat(F.lit("mech-"), mechanism())),
        )
    )


def project(prefix: str = "runs", smoke_project: str | None = None) -> Column:
    """Where a run is shown: smoke runs apart, else its own project, else one per method."""
    smoke = F.lit(smoke_project or f"{prefix}-smoke")
    default = F.concat(F.lit(f"{prefix}-"), _method())
    return F.when(is_smoke(), smoke).otherwise(F.coalesce(F.col("project"), default))


def log_every() -> Column:
    """Steps between logged points: an explicit setting wins, else 1 for smoke runs and 10."""
    return F.coalesce(F.col("log_every"), F.when(is_smoke(), F.lit(1)).otherwise(F.lit(10)))


def is_logged(step: Column, every: Column) -> Column:
    """An interval below one logs the first step alone."""
    return (step == 1) | F.when(every > 0, F.try_mod(step, every) == 0).otherwise(F.lit(False))
