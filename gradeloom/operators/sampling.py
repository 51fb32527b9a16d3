"""Exact samples, reproducible epoch orders and batch plans.

A row's place is the rank of a hash of seed and key. Ranks come without sorting everything in one
task: rows fall into buckets by the first hex digits of the hash, bucket sizes are counted, and a
row's rank is the number of rows in earlier buckets plus its rank inside its own bucket. Buckets
depend on the hash alone, so a recomputed task finds its rows in the same bucket.
"""

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gradeloom.functions.order import in_validation, order_hash

# Hex digits of the bucket prefix. 65,536 buckets cut 100 TB into pieces of 1.5 GB, a million
# buckets into pieces of 100 MB; one task sorts one bucket at a time.
PREFIX = 4
MAX_PREFIX = 5

# Up to this size a sample is taken by keeping the best n rows of each partition.
TOP_ROWS = 10_000

# Copies of one key that one task may number at a time.
COPY_CHUNK = 100_000

_INTERNAL = ("_hash", "_bucket", "_before", "_size")


def _bucketed(df: DataFrame, keys: list[str], seed: int, epoch: int | None, prefix: int) -> DataFrame:
    if not 1 <= prefix <= MAX_PREFIX:
        raise ValueError(f"prefix must be between 1 and {MAX_PREFIX}")
    hashed = df.withColumn("_hash", order_hash(seed, keys, epoch))
    return hashed.withColumn("_bucket", F.substring("_hash", 1, prefix))


def _bucket_offsets(rows: DataFrame, size: Column) -> DataFrame:
    """Rows before each bucket. At most 16 ** MAX_PREFIX rows whatever the input, hence broadcast."""
    sizes = rows.groupBy("_bucket").agg(size.alias("_size"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    return sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)).cast("long"))


def epoch_order(df: DataFrame, keys: list[str], seed: int, epoch: int = 0, prefix: int = PREFIX) -> DataFrame:
    """Add `pos`, 0 to n-1, the row's place in a seeded order that differs by epoch.

    `keys` must tell rows apart, as a row number does; use `epoch_order_with_copies` where one key
    can stand for many rows. One shuffle of the rows; counting reads the key columns alone.
    """
    rows = _bucketed(df, keys, seed, epoch, prefix)
    offsets = _bucket_offsets(rows, F.count(F.lit(1)))
    inside = W.partitionBy("_bucket").orderBy("_hash", *keys)
    placed = rows.join(F.broadcast(offsets), "_bucket").withColumn(
        "pos", F.col("_before") + F.row_number().over(inside) - 1
    )
    return placed.drop(*_INTERNAL)


def epoch_order_with_copies(
    df: DataFrame, keys: list[str], seed: int, epoch: int = 0, prefix: int = PREFIX, chunk: int = COPY_CHUNK
) -> DataFrame:
    """`(keys, pos)` where any number of rows may share a key.

    Copies are counted before the shuffle, a key takes as many consecutive places as it has
    copies, and these are written out again in chunks spread over the cluster.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    rows = _bucketed(counted, keys, seed, epoch, prefix)
    offsets = _bucket_offsets(rows, F.sum("_copies"))
    inside = W.partitionBy("_bucket").orderBy("_hash", *keys).rowsBetween(W.unboundedPreceding, -1)
    first = F.col("_before") + F.coalesce(F.sum("_copies").over(inside), F.lit(0))
    placed = rows.join(F.broadcast(offsets), "_bucket").select(*keys, "_copies", first.alias("_first"))
    last_chunk = F.floor((F.col("_copies") - 1) / chunk).cast("long")
    chunks = placed.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
    start = F.col("_chunk") * chunk
    end = F.least(start + chunk, F.col("_copies")) - 1
    spread = chunks.repartition(*keys, "_chunk")
    first, last = F.col("_first") + start, F.col("_first") + end
    return spread.select(*keys, F.explode(F.sequence(first, last)).alias("pos"))


def subsample_exact(
    df: DataFrame, n: int | None, keys: list[str], seed: int = 42, prefix: int = PREFIX, top_rows: int = TOP_ROWS
) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones for everyone who uses the seed; no n means all rows.

    The order is that of a hash of the key, then of a hash of the whole row, so it does not hang on files
    or partitions even where many rows share a key; which of several equal rows is taken makes no
    difference. A small n is a top-n. For a large n, copies of each key are counted and the last key that
    belongs to the sample is found; the sample is then a filter over the table, and only the rows of that
    one key are looked at again, by their hash.
    """
    if not n:
        return df
    everything = [*keys, *[c for c in df.columns if c not in keys]]
    if n <= top_rows:
        return df.orderBy(order_hash(seed, keys), *keys, order_hash(seed, everything), *everything).limit(n)
    return _first_rows(df, n, keys, everything, seed, prefix)


def _first_rows(df: DataFrame, n: int, keys: list[str], everything: list[str], seed: int, prefix: int) -> DataFrame:
    last = _last_of_sample(df, n, keys, seed, prefix)
    if last is None:
        return df
    place = F.struct(order_hash(seed, keys).alias("_hash"), *keys)
    bound = [F.lit(last[k]).cast(df.schema[k].dataType).alias(k) for k in keys]
    limit = F.struct(F.lit(last["_hash"]).alias("_hash"), *bound)
    if last["_wanted"] == last["_copies"]:
        return df.where(place <= limit)
    # Several rows share the last key and not all of them are in.
    below, at = df.where(place < limit), df.where(place == limit)
    if keys != everything:
        return below.unionByName(_first_rows(at, last["_wanted"], everything, everything, seed, prefix))
    # They are equal in all columns: one of them is written out as often as it is wanted.
    chunks = F.explode(F.sequence(F.lit(0), F.lit((last["_wanted"] - 1) // COPY_CHUNK)))
    spread = at.limit(1).withColumn("_chunk", chunks).repartition("_chunk")
    rest = F.least(F.lit(COPY_CHUNK), F.lit(last["_wanted"]) - F.col("_chunk") * COPY_CHUNK)
    return below.unionByName(spread.withColumn("_copy", F.explode(F.sequence(F.lit(1), rest.cast("int")))).select(*df.columns))


def _last_of_sample(df: DataFrame, n: int, keys: list[str], seed: int, prefix: int) -> Row | None:
    """Hash and key of the n-th row, how many rows have that key, and how many of those are wanted.

    Copies of a key are counted before the shuffle; only the bucket in which the count runs out is
    ranked, by keys alone. None when all rows are in.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    rows = _bucketed(counted, keys, seed, None, prefix)
    offsets = _bucket_offsets(rows, F.sum("_copies"))
    crossing = offsets.where((F.col("_before") < n) & (F.col("_before") + F.col("_size") >= n))
    inside = W.partitionBy("_bucket").orderBy("_hash", *keys).rowsBetween(W.unboundedPreceding, -1)
    first = F.col("_before") + F.coalesce(F.sum("_copies").over(inside), F.lit(0))
    ranked = rows.join(F.broadcast(crossing), "_bucket").withColumn("_wanted", n - first)
    found = ranked.where((F.col("_wanted") > 0) & (F.col("_wanted") <= F.col("_copies")))
    return found.select("_hash", *keys, "_wanted", "_copies").first()


def resume_from(ordered: DataFrame, pos: int) -> DataFrame:
    """What is left of an epoch: the order is a function of (seed, epoch), so a place is all the state."""
    return ordered.where(F.col("pos") >= pos)


def global_batch(micro: int, grad_accum: int = 1, gpus: int = 1, nodes: int = 1) -> int:
    """Rows per optimizer step. Leave `nodes` at 1 for trainers that count one node's GPUs only."""
    return micro * grad_accum * gpus * nodes


def rollout_batch(prompts: int, group: int) -> int:
    """Completions per rollout round."""
    return prompts * group


def mini_batch(wanted: int | None, train_batch: int) -> int:
    """Update size, never above the train batch."""
    return min(wanted or train_batch, train_batch)


def train_steps(samples: int, batch: int) -> int:
    return max(1, samples // batch)


def batch_plan(ordered: DataFrame, batch: int, total: int | None = None, drop_last: bool = False) -> DataFrame:
    """Add `step` and `slot` to rows that have `pos`; no shuffle.

    `drop_last` leaves out the rows after the last full batch of `total` rows.
    """
    step = F.floor(F.col("pos") / batch).cast("long")
    planned = ordered.withColumns({"step": step, "slot": F.col("pos") % batch})
    if not drop_last:
        return planned
    if total is None:
        raise ValueError("drop_last needs the number of rows")
    return planned.where(F.col("step") < total // batch)


def prompt_group_expand(prompts: DataFrame, group: int) -> DataFrame:
    """`group` rows per prompt, numbered by `sample_no`: one per completion to generate."""
    numbers = F.explode(F.sequence(F.lit(0), F.lit(group - 1)))
    return prompts.withColumn("sample_no", numbers)


def length_budget(df: DataFrame, length: Column, limit: int, flag_only: bool = False) -> DataFrame:
    """Keep rows within a length limit, or add `length` and `within_budget`.

    Pass the length that the trainer measures; without a tokenizer that is a word count.
    """
    if not flag_only:
        return df.where(length <= limit)
    return df.withColumn("length", length).withColumn("within_budget", F.col("length") <= limit)


def mark_split(
    df: DataFrame, keys: list[str], fraction: float, seed: int = 42, names: tuple[str, str] = ("train", "validation")
) -> DataFrame:
    """Add `split` by key in one pass, for files that are written with `partitionBy("split")`."""
    return df.withColumn("split", F.when(in_validation(seed, keys, fraction), F.lit(names[1])).otherwise(F.lit(names[0])))


def split_train_validation(
    df: DataFrame, keys: list[str], fraction: float, seed: int = 42, val_equals_train: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and validation rows by key; or, for parity with trainers that validate on
    their training data, all rows twice."""
    if val_equals_train:
        return df, df
    held_out = in_validation(seed, keys, fraction)
    return df.where(~held_out), df.where(held_out)
