"""Tables that grow by micro-batches: partition folders that a batch reads and replaces by name.

A batch reads only the folders of its own keys or windows, so what it costs does not grow with the batches
before it. Folders are listed by the driver, a few for each key bucket or window that the batch touches;
rows stay with the executors.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How a folder spells a null.
NULL = "__HIVE_DEFAULT_PARTITION__"


def name_of(column: str, value: int | None) -> str:
    return f"{column}={NULL if value is None else value}"


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, path: str, column: str) -> list[int]:
    """The numbers of the folders `column=number` in `path`, in order; none if there is no such path."""
    files, where = _at(spark, path)
    if not files.exists(where):
        return []
    names = [status.getPath().getName() for status in files.listStatus(where)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{column}="))


def remove(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)


def write_folders(df: DataFrame, path: str, by: list[str]) -> None:
    """Write `df` into the folders that its columns `by` name, replacing these folders and no others, so that
    a batch that is repeated replaces what it wrote the first time. Rows of a folder are brought together, but
    for folders that are large, which Spark splits again."""
    out = df.hint("rebalance", *[F.col(c) for c in by[:1]]).write.mode("overwrite")
    out.option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_folders(spark: SparkSession, path: str, folders: list[str], schema: T.StructType) -> DataFrame:
    """The rows of the given folders below `path`; no other folder is listed."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])


def existing(spark: SparkSession, path: str, folders: list[str]) -> list[str]:
    files, where = _at(spark, path)
    if not folders or not files.exists(where):
        return []
    there = {status.getPath().getName() for status in files.listStatus(where)}
    return [f for f in folders if f in there]


def different(df: DataFrame, column: str) -> list[int | None]:
    """The different values of a column, for columns that have few by construction."""
    return [r[0] for r in df.select(F.col(column)).distinct().collect()]
