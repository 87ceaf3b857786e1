"""Graphs as two DataFrames: ``edges(src, dst)`` and ``vertices(id, attr)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edges_from_text(lines: DataFrame, col: str = "value") -> DataFrame:
    """Edge-list text -> ``(src, dst)``: whitespace separated ids, ``#`` lines are comments,
    blank lines skipped, duplicate edges kept."""
    body = F.trim(F.col(col))
    parts = F.split(body, "\\s+")
    return (lines.where((F.length(body) > 0) & ~body.startswith("#"))
                 .select(F.get(parts, 0).cast("long").alias("src"), F.get(parts, 1).cast("long").alias("dst")))


def vertices_of(edges: DataFrame, attr=0) -> DataFrame:
    """All end points as vertices, each with the same attribute (default 0)."""
    ids = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return ids.withColumn("attr", F.lit(attr) if not isinstance(attr, Column) else attr)


def out_degrees(edges: DataFrame) -> DataFrame:
    """``(id, degree)`` for vertices with at least one out-edge (partial aggregation per task)."""
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))


def join_vertices(vertices: DataFrame, updates: DataFrame, value: str) -> DataFrame:
    """Left join ``updates(id, value)`` into ``vertices(id, attr)``; unmatched keep their attr."""
    j = vertices.join(updates, on="id", how="left")
    return j.select("id", F.coalesce(F.col(value), F.col("attr")).alias("attr"))


def out_degree_vertices(edges: DataFrame) -> DataFrame:
    """Every vertex with its out-degree (0 when it has none), in one scan and one shuffle: each edge
    gives (src, 1) and (dst, 0), summed per vertex with map-side combine. Same result as resetting
    the attributes to 0 and joining the out-degrees in, without the second shuffle."""
    ends = F.array(F.struct(F.col("src").alias("id"), F.lit(1).alias("o")),
                   F.struct(F.col("dst").alias("id"), F.lit(0).alias("o")))
    marks = edges.select(F.explode(ends).alias("m")).select("m.id", "m.o")
    return marks.groupBy("id").agg(F.sum("o").cast("long").alias("degree"))
