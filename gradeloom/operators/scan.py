"""Running sums over keys of any size: sums of pieces, running sums of these, added down again."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Places that one window spans below the top.
FAN = 4096
# With two levels the top window spans one row for 16 million places of a key.
LEVELS = 2


def sum_before(
    df: DataFrame, keys: list[str], place: str, value: str | Column, name: str, fan: int = FAN, levels: int = LEVELS
) -> DataFrame:
    """Add `name`: the sum of `value` over the rows of the same `keys` at earlier places, 0 at the first.

    `place` is a whole number from 0, at most one row each; places may be missing. A window spans `fan`
    places. The sums of these pieces are worked up the same way, `levels` times, and what a piece has before it is
    joined back; pieces at the start of a key have nothing before them and are not joined.
    """
    if fan < 2 or levels < 0:
        raise ValueError("fan must be 2 or more and levels 0 or more")
    value = F.col(value) if isinstance(value, str) else value
    if levels == 0:
        before = W.partitionBy(*keys).orderBy(place).rowsBetween(W.unboundedPreceding, -1)
        return df.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))
    piece = f"_piece_{levels}"
    cut = df.withColumn(piece, F.floor(F.col(place) / fan).cast("long"))
    sums = cut.groupBy(*keys, piece).agg(F.sum(value).alias("_sum"))
    above = sum_before(sums, keys, piece, "_sum", "_above", fan, levels - 1).where(F.col(piece) > 0)
    before = W.partitionBy(*keys, piece).orderBy(place).rowsBetween(W.unboundedPreceding, -1)
    inside = cut.withColumn("_inside", F.coalesce(F.sum(value).over(before), F.lit(0)))
    placed = inside.join(above.select(*keys, piece, "_above"), [*keys, piece], "left")
    return placed.withColumn(name, F.col("_inside") + F.coalesce("_above", F.lit(0))).select(*df.columns, name)
