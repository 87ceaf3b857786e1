"""Relational operators: projection/filter, joins, set operations, keyed aggregates, top-k.

Plans are left to Catalyst: filters and projections reach the Parquet scan, aggregates run as
partial + final hash aggregates (map-side combine), and join strategies are left to adaptive
execution, which decides by bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quarry.functions.text import exact_sum


def select_where(df: DataFrame, cols: list, cond: Column | str | None = None) -> DataFrame:
    """``SELECT cols FROM df WHERE cond``."""
    out = df.where(cond) if cond is not None else df
    return out.select(*cols)


def row_format(df: DataFrame, label: str, col: str | int = 0, out: str = "line") -> DataFrame:
    """``label + field`` for every row; the field is chosen by position or by name."""
    name = df.columns[col] if isinstance(col, int) else col
    return df.select(F.concat(F.lit(label), F.col(name).cast("string")).alias(out))


def inner_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner equi-join on same-named keys."""
    return left.join(right, on=keys, how="inner")


def sum_count_avg(df: DataFrame, keys: list[str], value: str, prefix: str = "") -> DataFrame:
    """Sum, count and average per key in one aggregate (no self-join of two aggregates).

    The sum is exact for two-decimal values; the average divides last.
    """
    s = exact_sum(value)
    n = F.count(F.lit(1))
    return df.groupBy(*keys).agg(s.alias(f"{prefix}sum"), n.alias(f"{prefix}cnt"),
                                 (s / n).alias(f"{prefix}avg"))


def cartesian(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every (left, right) pair, |left| x |right| rows by definition. Spark picks the strategy: a
    nested loop over a broadcast side if one is small in bytes, else a product of partitions."""
    return left.crossJoin(right)


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by position, duplicates kept (no shuffle)."""
    return a.union(b)


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows present in both inputs (null-safe).

    Both sides are de-duplicated first (partial aggregation in the map tasks), then semi
    joined, so a value repeated on a third of the rows reaches the join once per task instead
    of once per row (``intersect`` alone joins the raw rows and de-duplicates after).
    """
    cols = a.columns
    left = a.distinct()
    right = b.toDF(*[f"_q_r{i}" for i in range(len(cols))]).distinct()
    cond = None
    for i, c in enumerate(cols):
        e = left[c].eqNullSafe(right[f"_q_r{i}"])
        cond = e if cond is None else cond & e
    return left.join(right, cond, "left_semi")


def subtract(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` whose value is absent from ``right``; left duplicates are kept and null
    matches null. Anti join on the distinct right keys; adaptive execution broadcasts them if they
    prove small in bytes and splits skewed left keys otherwise."""
    cols = left.columns
    rk = right.toDF(*[f"_q_r{i}" for i in range(len(cols))]).distinct()
    cond = None
    for i, c in enumerate(cols):
        e = left[c].eqNullSafe(rk[f"_q_r{i}"])
        cond = e if cond is None else cond & e
    return left.join(rk, cond, "left_anti")


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """First ``k`` rows by ``order`` (TakeOrderedAndProject: per-task top-k, then merge)."""
    return df.orderBy(*order).limit(k)


def take_n(df: DataFrame, n: int, order: list | None = None) -> DataFrame:
    """First ``n`` rows (ordered by ``order`` when given, which makes the result repeatable)."""
    return (df.orderBy(*order) if order else df).limit(n)


def observed_sum(df: DataFrame, col: str, factor: int = 2) -> tuple[DataFrame, Observation]:
    """Sum of ``col * factor`` plus a side counter of processed rows.

    The counter is an ``Observation`` (exact under task retries, unlike an accumulator updated in
    a map); the aggregate also carries the count so the result is one self-contained row.
    """
    obs = Observation("processed")
    watched = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    out = watched.agg(F.sum(F.col(col) * F.lit(factor)).cast("long").alias("total"),
                      F.count(F.lit(1)).alias("n"))
    return out, obs
