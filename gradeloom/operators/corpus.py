"""Raw text for continued pretraining."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.text import strip


def corpus_text(df: DataFrame, drop_blank: bool = True, text: str = "text") -> DataFrame:
    """The `text` column alone: stripped and without blanks, or with `drop_blank=False` as it is."""
    if not drop_blank:
        return df.select(F.col(text).alias("text"))
    clean = df.select(strip(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    return clean.where(F.col("text") != "")
