"""An endless order: epoch after epoch, each shuffled anew, addressed by one running place.

Place p is place p mod n of epoch p div n, n being the number of rows. An order that is written lies in
folders of consecutive places, so whoever resumes or wants one batch reads the folders of its places.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.operators.sampling import PREFIX, epoch_order

# Consecutive places that lie in one folder.
RANGE_ROWS = 1_000_000

_EPOCH, _RANGE = "epoch", "place_range"


def epoch_of(place: Column, rows: int) -> Column:
    return F.floor(place / rows).cast("long")


def pos_of(place: Column, rows: int) -> Column:
    return F.pmod(place, F.lit(rows)).cast("long")


def place_of(epoch: Column, pos: Column, rows: int) -> Column:
    return (epoch * rows + pos).cast("long")


def spans(first: int, count: int, rows: int) -> list[tuple[int, int, int]]:
    """(epoch, pos of its first place, number of places) for each epoch that `count` places from `first` on touch."""
    if first < 0 or count < 0 or rows < 1:
        raise ValueError("places count from 0, and there is no order of no rows")
    out = []
    while count:
        epoch, pos = divmod(first, rows)
        here = min(count, rows - pos)
        out.append((epoch, pos, here))
        first, count = first + here, count - here
    return out


def write_epoch(
    df: DataFrame, keys: list[str], seed: int, epoch: int, path: str, range_rows: int = RANGE_ROWS, prefix: int = PREFIX
) -> None:
    """Write one epoch's order below `path`, in a folder for each `range_rows` places. Writing it again replaces
    it; all epochs of a path take the same rows, seed and `range_rows`."""
    ordered = epoch_order(df, keys, seed, epoch, prefix)
    placed = ordered.withColumns({_EPOCH: F.lit(epoch).cast("long"), _RANGE: F.floor(F.col("pos") / range_rows).cast("long")})
    out = placed.repartition(_RANGE).sortWithinPartitions("pos").write.mode("overwrite")
    out.option("partitionOverwriteMode", "dynamic").partitionBy(_EPOCH, _RANGE).parquet(path)


def read_places(
    spark: SparkSession, path: str, first: int, count: int, rows: int, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """The rows at `count` places from `first` on, with `place`, `epoch` and `pos`.

    Only the folders of these places are read: the epochs are paths, the ranges partition filters. An epoch that
    is not written is an error.
    """
    wanted, touched = F.lit(False), spans(first, count, rows)
    for epoch, pos, here in touched:
        ranges = F.col(_RANGE).between(pos // range_rows, (pos + here - 1) // range_rows)
        wanted = wanted | ((F.col(_EPOCH) == epoch) & ranges & F.col("pos").between(pos, pos + here - 1))
    folders = [f"{path}/{_EPOCH}={epoch}" for epoch, _, _ in touched or spans(first, 1, rows)]
    found = spark.read.option("basePath", path).parquet(*folders).where(wanted)
    return found.withColumn("place", place_of(F.col(_EPOCH), F.col("pos"), rows)).drop(_RANGE)
