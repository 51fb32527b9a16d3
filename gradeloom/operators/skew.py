"""Ways to keep one hot key from landing whole in one task."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Groups are counted by hash in this many places. A place with more than `hot_rows` rows, and with more than
# CROWDED times the mean, is salted: all of its groups are spread over a number of salts that follows from its rows.
PLACES = 1 << 20
CROWDED = 8
MAX_SALTS = 4096

# A group above this many rows is treated as hot, as long as it is among the HOT_KEYS largest. What is
# broadcast about hot groups is bounded by HOT_KEYS, whatever the input; a group that is not among them
# has less than one row in HOT_KEYS of the whole table, which a task can sort.
HOT_ROWS = 100_000
HOT_KEYS = 10_000

# A lookup table up to this many rows and bytes is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def same_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def _hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Keys with more than `hot_rows` rows under names of their own, and the pairs of names.

    Counting reads only the key columns and combines before the shuffle.
    """
    pairs = [(k, f"_hot_{i}") for i, k in enumerate(keys)]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    largest = counted.orderBy(F.desc("_rows"), *keys).limit(HOT_KEYS)
    return F.broadcast(largest.select(*[F.col(k).alias(h) for k, h in pairs])), pairs


def split_hot(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Split rows into those of ordinary groups and those of groups with more than `hot_rows` rows.

    When no group is hot, the second frame's plan collapses at run time before its scan starts.
    """
    hot_keys, pairs = _hot_keys(df, keys, hot_rows)
    on = same_keys(df, hot_keys, pairs)
    return df.join(hot_keys, on, "left_anti"), df.join(hot_keys, on, "left_semi")


def _place(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(PLACES)).cast("int")


def crowded_places(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """`(_place, _salts)` of the hash places of `keys` that hold too many rows for one task.

    A group with more than one row in PLACES / CROWDED (131,072) and more than `hot_rows` rows is always in
    such a place; which other groups share it does no harm. Counting reads the keys alone and combines before
    the shuffle. At most PLACES / CROWDED rows come out, however many groups there are, hence broadcast.
    """
    counted = df.groupBy(_place(keys).alias("_place")).agg(F.count(F.lit(1)).alias("_rows"))
    total = F.sum("_rows").over(W.partitionBy(F.lit(0)))  # over PLACES rows at most
    least = F.greatest(F.lit(hot_rows), total * CROWDED / PLACES)
    salts = F.least(F.ceil(F.col("_rows") / F.greatest(F.lit(1), F.col("_least") / 2)), F.lit(MAX_SALTS)).cast("int")
    return counted.withColumn("_least", least).where(F.col("_rows") > F.col("_least")).select("_place", salts.alias("_salts"))


def with_salt(df: DataFrame, keys: list[str], crowded: DataFrame) -> DataFrame:
    """Add `_group` (the keys as one value that is never null), `_salts` (null where there is no crowd) and
    `_salt`, below it. A salt follows from the row and the input partition it is read from, so a task
    that runs again gives its rows the same salts, and equal rows are spread as well."""
    of_row = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salt = F.pmod(F.xxhash64(*of_row) + F.spark_partition_id(), F.col("_salts"))
    placed = df.withColumns({"_group": F.struct(*keys), "_place": _place(keys)}).join(F.broadcast(crowded), "_place", "left")
    return placed.withColumn("_salt", F.when(F.col("_salts").isNotNull(), salt).otherwise(0).cast("int")).drop("_place")


def replicated(stats: DataFrame, keys: list[str], crowded: DataFrame, everywhere: bool) -> DataFrame:
    """A row of `stats` for every salt that rows of its group can have, with `_group` and `_salt` to join on and
    without the keys; groups outside crowded places once, or not at all unless `everywhere`."""
    placed = stats.withColumns({"_group": F.struct(*keys), "_place": _place(keys)})
    placed = placed.join(F.broadcast(crowded), "_place", "left" if everywhere else "inner")
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return placed.withColumn("_salt", F.explode(salts)).drop("_place", "_salts", *keys)


def join_stats(df: DataFrame, stats: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows with the columns of `stats`, which has one row for each group of `keys`, null keys included.

    Groups in crowded places are joined on (group, salt), so that no group has to be in one task."""
    crowded = crowded_places(df, keys, hot_rows)
    joined = with_salt(df, keys, crowded).join(replicated(stats, keys, crowded, True), ["_group", "_salt"], "left")
    return joined.drop("_group", "_salt", "_salts")


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: str,
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join rows to a table that has one row per key.

    The table's rows are counted and measured first, summed up where they are. Up to the limits it is broadcast. Beyond them ordinary keys are joined by shuffle, and hot keys, HOT_KEYS at most, are
    joined to a broadcast of just their entries.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"lookup cannot do a {how!r} join")
    width = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    found = table.agg(F.count(F.lit(1)).alias("n"), F.coalesce(width, F.lit(0)).alias("bytes")).first()
    if found["n"] <= broadcast_rows and found["bytes"] <= broadcast_bytes:
        return df.join(F.broadcast(table), on, how)
    ordinary, hot = split_hot(df, [on], hot_rows)
    hot_keys, pairs = _hot_keys(df, [on], hot_rows)
    entries = table.join(hot_keys, same_keys(table, hot_keys, pairs), "left_semi")
    return ordinary.join(table, on, how).unionByName(hot.join(F.broadcast(entries), on, how))
