"""Writers of training files. Each path is a folder of part files, written in parallel."""

from pyspark.sql import DataFrame


def _fewer_files(df: DataFrame, files: int | None) -> DataFrame:
    return df if files is None else df.coalesce(files)


def write_parquet(
    df: DataFrame, path: str, partition_by: list[str] | None = None, files: int | None = None, mode: str = "error"
) -> None:
    """Training rows as parquet. Ask for `files` only where the reader needs that few."""
    _fewer_files(df, files).write.mode(mode).partitionBy(*(partition_by or [])).parquet(path)


def write_jsonl(df: DataFrame, path: str, files: int | None = None, mode: str = "error") -> None:
    """One JSON object per line in UTF-8, null fields written out."""
    _fewer_files(df, files).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_corpus_jsonl(df: DataFrame, path: str, files: int | None = None, mode: str = "error") -> None:
    """Corpus rows as `{"text": ...}` lines."""
    write_jsonl(df.select("text"), path, files, mode)
