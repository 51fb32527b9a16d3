"""Generalised advantage estimation over trajectories of any length.

A_t = delta_t + g * A_(t+1), with delta_t = r_t + gamma * V_(t+1) - V_t and g = gamma * lambda.
A trajectory is cut into chunks of consecutive steps. Inside a chunk, A is a suffix sum of
g^k * delta_k divided by g^k, which a window computes. What flows into a chunk from the later ones
is one number, obtained from one row per later chunk; long tables of chunks are cut up the same way.
Steps have to count 0, 1, 2, ..., and what is worked out from steps that do not is an error, not a number.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHUNK = 4096
# Chunks that one window spans.
FAN = 4096
# How often tables of chunks are cut up where nothing fades: the last window spans a chunk in 16 million.
LEVELS = 2
# Smallest g^k that a chunk may reach, far above what a double can still hold.
_SMALLEST = 1e-150


def _chunk_length(g: float, chunk: int) -> int:
    if 0.0 < g < 1.0:
        return max(1, min(chunk, int(math.log(_SMALLEST) / math.log(g))))
    return chunk


def _refused() -> Column:
    return F.raise_error(F.lit("steps of a trajectory do not count 0, 1, 2, ...")).cast("double")


def _local_advantage(rows: DataFrame, keys: list[str], step: str, reward: Column, value: Column, gamma, g):
    """A within each chunk as if nothing followed the chunk. Each step has to come right after the one
    before it, and the first of a chunk at its start."""
    backward = W.partitionBy(*keys, "_chunk").orderBy(F.col(step).desc())
    following = F.coalesce(F.lag(value).over(backward), F.lit(0.0))
    before = F.lead(step).over(backward)
    follows = F.when(F.col("_k") == 0, before.isNull()).otherwise(before == F.col(step) - 1)
    whole = (F.col(step) == F.floor(step)) & (F.col(step) >= 0)
    rows = rows.withColumns({"_delta": reward + F.lit(gamma) * following - value, "_follows": F.coalesce(follows & whole, F.lit(False))})
    local = F.col("_delta")
    if g != 0.0:
        weight = F.pow(F.lit(g), F.col("_k"))
        local = F.sum(F.col("_delta") * weight).over(backward.rowsBetween(W.unboundedPreceding, W.currentRow)) / weight
    return rows.withColumn("_local", F.when(F.col("_follows"), local).otherwise(_refused())).drop("_follows")


def gae(
    df: DataFrame,
    keys: list[str],
    step: str = "step",
    reward: str = "reward",
    value: str = "value",
    gamma: float = 1.0,
    lam: float = 1.0,
    chunk: int = CHUNK,
    fan: int = FAN,
) -> DataFrame:
    """Add `advantage` and `value_target` (advantage + value).

    `step` counts 0, 1, 2, ... within a trajectory; where it does not, reading the advantages fails. The value
    after the last step is 0. Rows are shuffled once, on trajectory and chunk, so a trajectory with a
    third of all rows is shared by many tasks; only steps from `chunk` on are read a second time. One row
    per chunk is worked up in turn by `fan` rows at a time, so no window spans a whole trajectory.
    """
    if not (0.0 <= gamma <= 1.0 and 0.0 <= lam <= 1.0):
        raise ValueError("gamma and lam must be between 0 and 1")
    gamma, g = float(gamma), float(gamma) * float(lam)
    size = _chunk_length(g, chunk)
    r, v = F.col(reward).cast("double"), F.col(value).cast("double")
    number = F.floor(F.col(step) / size).cast("long")
    rows = df.withColumns({"_chunk": number, "_k": (F.col(step) - number * size).cast("int")})
    done = _local_advantage(rows, keys, step, r, v, gamma, g)
    # Chunks without gaps are the whole trajectory if it has as many steps as its last one says.
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_steps"), F.max(step).alias("_top")).where(F.col("_top") >= size)
    inflow = _inflow(rows.where(F.col(step) >= size), counted, keys, step, r, v, gamma, g, size, fan)
    carried = F.pow(F.lit(g), F.lit(size - 1) - F.col("_k")) * F.coalesce(F.col("_inflow"), F.lit(0.0))
    done = done.join(inflow, [*keys, "_chunk"], "left").withColumn("advantage", F.col("_local") + carried)
    done = done.withColumn("value_target", F.col("advantage") + v)
    return done.select(*df.columns, "advantage", "value_target")


def _inflow(
    later: DataFrame, counted: DataFrame, keys: list[str], step: str, r: Column, v: Column, gamma, g, size: int, fan: int
) -> DataFrame:
    """`(keys, _chunk, _inflow)`: what the chunks after `_chunk` add to its last step.

    The advantage at the first step of chunk c is a_c + g^size * (that of chunk c+1).
    """
    local = _local_advantage(later, keys, step, r, v, gamma, g)
    first = F.col("_k") == 0
    chunks = local.groupBy(*keys, "_chunk").agg(
        F.max(F.when(first, F.col("_local"))).alias("_a"), F.max(F.when(first, v)).alias("_v"), F.count(F.lit(1)).alias("_n")
    )
    following = chunks.select(*keys, (F.col("_chunk") - 1).alias("_chunk"), F.col("_v").alias("_next_v"))
    next_v = F.coalesce(F.col("_next_v"), F.lit(0.0))
    heads = chunks.join(following, [*keys, "_chunk"], "left").select(
        *keys, "_chunk", "_v", (F.col("_a") + F.pow(F.lit(g), F.col("_n") - 1) * F.lit(gamma) * next_v).alias("_a")
    )
    solved = _solved(heads, keys, g**size, fan, LEVELS).join(counted, keys)
    amount = F.lit(gamma) * F.col("_v") + F.lit(g) * F.col("_a")
    return solved.select(
        *keys, (F.col("_chunk") - 1).alias("_chunk"), F.when(F.col("_steps") == F.col("_top") + 1, amount).otherwise(_refused()).alias("_inflow")
    )


def _solved(heads: DataFrame, keys: list[str], w: float, fan: int, levels: int) -> DataFrame:
    """`heads` (keys, _chunk, _a and others) with `_a` replaced by x_c = a_c + w * x_(c+1).

    A window sums up w^k * a_c within pieces of chunks and divides by w^k, as within a chunk. The value at the
    start of the next piece is added. It is solved the same way, unless the w^k of a piece have faded so far that
    nothing beyond the next piece counts, or, where w is 1, `levels` are done and one window takes the rest.
    """
    if w == 0.0:
        return heads
    suffix = lambda by: by.orderBy(F.col("_chunk").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    if w == 1.0 and levels == 0:
        return heads.withColumn("_a", F.sum("_a").over(suffix(W.partitionBy(*keys))))
    length = _chunk_length(w, fan)
    k = F.col("_chunk") - F.col("_piece") * length
    pieces = heads.withColumn("_piece", F.floor(F.col("_chunk") / length).cast("long"))
    inside = F.sum(F.col("_a") * F.pow(F.lit(w), k)).over(suffix(W.partitionBy(*keys, "_piece"))) / F.pow(F.lit(w), k)
    pieces = pieces.withColumn("_a", inside)
    # Chunk 0 needs no inflow and is not here, and nobody asks for the start of piece 0.
    starts = pieces.where((k == 0) & (F.col("_piece") > 0)).select(*keys, F.col("_piece").alias("_chunk"), "_a")
    if length == fan:
        starts = _solved(starts, keys, w**length, fan, levels - 1)
    beyond = starts.select(*keys, (F.col("_chunk") - 1).alias("_piece"), F.col("_a").alias("_beyond"))
    joined = pieces.join(beyond, [*keys, "_piece"], "left")
    added = F.pow(F.lit(w), F.lit(length) - k) * F.coalesce("_beyond", F.lit(0.0))
    return joined.withColumn("_a", F.col("_a") + added).drop("_piece", "_beyond")
