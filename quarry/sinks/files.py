"""File sinks: text lines, pair text, Parquet (plain and partitioned), tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_text(df: DataFrame, path: str, col: str | None = None, mode: str = "overwrite") -> str:
    """Write one string column as text lines (one file per task)."""
    c = col or df.columns[0]
    df.select(F.col(c).cast("string").alias("value")).write.mode(mode).text(path)
    return path


def pair_lines(df: DataFrame, key: str, value: str, out: str = "value") -> DataFrame:
    """``(k,v)`` text form of a pair, as a pair RDD prints."""
    return df.select(F.format_string("(%s,%s)", F.col(key), F.col(value).cast("string")).alias(out))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
