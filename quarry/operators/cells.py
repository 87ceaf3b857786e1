"""Cell tables: ``(row_key, family, qualifier, value, version, put)``, a sparse wide-row store kept
as a bucketed, sorted Parquet table. A put appends cells under its own number; reads resolve the newest
version of each cell, and of equal versions the one put later. All cells of a row are in one bucket, so
neither that nor the pivot to rows shuffles. Files are sorted by key, so a row-range scan skips row
groups by min/max in every bucket."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELL_COLS = ["row_key", "family", "qualifier", "value", "version", "put"]
BUCKETS = 32


def to_cells(df: DataFrame, row_key: Column, family: str, columns: dict[str, Column], version: int = 0) -> DataFrame:
    """Unpivot each row into one cell per (family, qualifier); values are stored as strings."""
    pairs = [F.struct(F.lit(q).alias("qualifier"), c.cast("string").alias("value")) for q, c in columns.items()]
    return (df.select(row_key.cast("string").alias("row_key"), F.explode(F.array(*pairs)).alias("c"))
              .select("row_key", F.lit(family).alias("family"), "c.qualifier", "c.value",
                      F.lit(version).cast("long").alias("version")))


def _table(spark: SparkSession, path: str, buckets: int) -> str:
    """The store at ``path`` as a table of this session's catalog."""
    name = "cells_" + hashlib.md5(path.encode()).hexdigest()[:16]
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} (row_key STRING, family STRING, qualifier STRING, value STRING, version BIGINT,
        put BIGINT) USING parquet CLUSTERED BY (row_key) SORTED BY (row_key, family, qualifier) INTO {buckets} BUCKETS
        LOCATION '{path}/cells'""")
    return name


def _puts(spark: SparkSession, path: str):
    """File system and folder of the put numbers taken so far, and the next one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/puts")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    return fs, folder, 1 + max((int(f.getPath().getName()) for f in fs.listStatus(folder)), default=0)


def put(cells: DataFrame, path: str, buckets: int = BUCKETS) -> str:
    """Append cells to the store at ``path`` as one put, later than all before it. Every bucket gets one
    sorted file. ``buckets`` holds for the store's first put (and for every session that opens it)."""
    spark = cells.sparkSession
    name = _table(spark, path, buckets)
    fs, folder, number = _puts(spark, path)
    fs.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder, str(number)))
    rows = cells.withColumn("put", F.lit(number).cast("long")).select(*CELL_COLS)
    rows.repartition(buckets, "row_key").sortWithinPartitions("row_key", "family", "qualifier").write.insertInto(name)
    return path


def stored(spark: SparkSession, path: str, buckets: int = BUCKETS) -> DataFrame:
    """All cells of the store as they were put."""
    name = _table(spark, path, buckets)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def current(cells: DataFrame) -> DataFrame:
    """Newest value of each cell: highest version, then latest put. Over a store no row moves; ``max_by`` is
    also a partial aggregate, so elsewhere a cell rewritten many times is reduced before a shuffle."""
    return (cells.groupBy("row_key", "family", "qualifier")
                 .agg(F.max_by(F.struct("value", "version"), F.struct("version", "put")).alias("c"))
                 .select("row_key", "family", "qualifier", "c.value", "c.version"))


def scan(spark: SparkSession, path: str, buckets: int = BUCKETS) -> DataFrame:
    return current(stored(spark, path, buckets))


def range_scan(cells: DataFrame, start: str, stop: str, family: str | None = None,
               qualifiers: list[str] | None = None) -> DataFrame:
    """Rows with ``start <= row_key < stop``; equal bounds select exactly that row. Optional
    family and qualifier projections. Key predicates are pushed into the Parquet scan."""
    cond = (F.col("row_key") == start) if start == stop else ((F.col("row_key") >= start) & (F.col("row_key") < stop))
    if family is not None:
        cond = cond & (F.col("family") == family)
    if qualifiers:
        cond = cond & F.col("qualifier").isin(qualifiers)
    return cells.where(cond)


def filter_scan(cells: DataFrame, family: str, key_contains: str, qualifier_contains: str) -> DataFrame:
    """Cells of ``family`` whose row key and qualifier contain the given substrings (AND)."""
    return cells.where((F.col("family") == family) & F.col("row_key").contains(key_contains)
                       & F.col("qualifier").contains(qualifier_contains))


def to_rows(cells: DataFrame, family: str, columns: dict[str, str]) -> DataFrame:
    """One row per key with the newest value of each named qualifier of ``family``, typed. ``cells`` are
    stored cells (or current ones): newest and pivot are one aggregate, over a store without a shuffle."""
    order = F.struct("version", "put") if "put" in cells.columns else F.col("version")
    newest = [F.max_by(F.when(F.col("qualifier") == q, F.col("value")), F.when(F.col("qualifier") == q, order)).cast(t).alias(q)
              for q, t in columns.items()]
    return cells.where((F.col("family") == family) & F.col("qualifier").isin(list(columns))).groupBy("row_key").agg(*newest)
