"""Helpers of the operators: written intermediate tables and positions of rows in a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.session import shared_dir

_ROW, _SPLIT = "__row", "__split"


def keep(df: DataFrame) -> DataFrame:
    """`df` written below `spark.checkpoint.dir` and read again: what follows no longer depends on
    how it was made, so a lost executor costs a file read and not the whole lineage."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_order(df: DataFrame, order: list[Column | str], parts: int | None = None) -> DataFrame:
    """`df` range-partitioned and sorted by `order`.

    A key that owns a third of all rows is dealt over many partitions, as long as the later columns
    of `order` tell its rows apart; rows that agree in all of `order` are told apart by their place
    in the input.
    """
    tied = df.withColumn(_ROW, F.monotonically_increasing_id())
    ends = [*order, _ROW]
    return tied.repartitionByRange(parts or partitions(df), *ends).sortWithinPartitions(*ends).drop(_ROW)


def numbered(df: DataFrame, order: list[Column | str], name: str) -> tuple[DataFrame, int]:
    """`df` with the gapless place of each row in the order of `order`, from 0, and the row count.

    One shuffle. Rows are counted per partition, and only these counts (one row per partition) are
    summed up in one task; no window spans a whole key.
    """
    placed = keep(in_order(df, order).withColumn(name, F.monotonically_increasing_id()))
    split = F.shiftright(F.col(name), 33)
    counts = placed.groupBy(split.alias(_SPLIT)).agg(F.count("*").alias("n"))
    before = Window.orderBy(_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(_SPLIT, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_ROW))  # one row per partition
    within = F.col(name).bitwiseAND(F.lit((1 << 33) - 1))
    out = placed.withColumn(_SPLIT, split).join(F.broadcast(starts), _SPLIT)
    return out.withColumn(name, within + F.col(_ROW)).drop(_SPLIT, _ROW), placed.count()
