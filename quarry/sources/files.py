"""File and catalog sources: generic load, merged-schema Parquet, JDBC, catalog listing, DDL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def load(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Generic load; the default data source is Parquet."""
    return spark.read.load(path, format=fmt) if fmt else spark.read.load(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet folder whose parts have different columns: union of all columns, partition
    columns (``key=1`` folders) discovered and appended; missing values are null."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def jdbc_scan(spark: SparkSession, url: str, table: str, column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int | None = None,
              properties: dict | None = None) -> DataFrame:
    """Parallel JDBC table scan.

    ``column, lower, upper, num_partitions`` are all given or all omitted. The bounds only set
    the stride of the partition predicates; rows outside them are still read (first and last
    partitions are open ended).
    """
    given = [v is not None for v in (column, lower, upper, num_partitions)]
    if any(given) and not all(given):
        raise ValueError("column, lower, upper and num_partitions go together")
    if all(given):
        return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=properties or {})
    return spark.read.jdbc(url, table, properties=properties or {})


def catalog_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``(table_name, col_name, data_type)`` for every table and view in the catalog.

    Built from catalog metadata (bounded by the number of tables and columns), not from data.
    """
    rows = []
    for t in spark.catalog.listTables(database):
        name = t.name if t.isTemporary or not t.database else f"{t.database}.{t.name}"
        for c, typ in spark.table(name).dtypes:
            rows.append((t.name, c, typ))
    schema = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("col_name", T.StringType()),
                           T.StructField("data_type", T.StringType())])
    return spark.createDataFrame(rows, schema)


def table_names(spark: SparkSession, database: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database)]


def create_table(spark: SparkSession, name: str, ddl_columns: str, location: str, provider: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS name (cols) USING provider LOCATION path`` (an external
    table in the shared folder, so the data outlives the session and any executor)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns}) USING {provider} LOCATION '{location}'")


def load_delimited_into(spark: SparkSession, table: str, path: str, sep: str = "\x01") -> DataFrame:
    """Load a delimited text file into an existing table (the ``LOAD DATA INPATH`` step):
    fields parsed with the table's own schema, then appended with ``insertInto``."""
    schema = spark.table(table).schema
    df = spark.read.schema(schema).option("sep", sep).option("mode", "FAILFAST").csv(path)
    df.write.insertInto(table)
    return spark.table(table)


def save_as_table(df: DataFrame, name: str, path: str, mode: str = "overwrite") -> DataFrame:
    """Persist as a catalog table stored at ``path``; returns the table."""
    df.write.mode(mode).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
