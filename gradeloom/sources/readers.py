"""Reading one split of a stored dataset."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_dataset(
    spark: SparkSession,
    path: str,
    name: str | None = None,
    split: str | None = None,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    mode: str = "FAILFAST",
) -> DataFrame:
    """A dataset stored under `path`, laid out as `config=<name>/split=<split>` folders.

    `name` and `split` become partition filters, so other folders are not listed into the scan.
    Either may be left out, also where the layout has no such folder level. A line of JSON that cannot be
    read fails the job. With `mode="PERMISSIVE"` and a string column `_corrupt_record` in the schema such
    lines come aside: they have their text there and nulls elsewhere.
    """
    if fmt not in ("parquet", "json"):
        raise ValueError(f"unknown dataset format: {fmt!r}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "json":
        reader = reader.option("mode", mode)
    df = reader.format(fmt).load(path)
    for column, wanted in (("config", name), ("split", split)):
        if wanted is not None:
            df = df.where(F.col(column) == wanted)
            df = df.drop(column) if schema is None else df
    return df if schema is None else df.select(*schema.fieldNames())


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")
