"""Readers for the shared star-schema tables (one Parquet file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; projections and filters applied later are pushed into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, prefix: str = "") -> list[str]:
    """Register every table as a temp view ``<prefix><name>``; returns the view names."""
    names = []
    for t in TABLES:
        read_table(spark, sf_dir, t).createOrReplaceTempView(prefix + t)
        names.append(prefix + t)
    return names
