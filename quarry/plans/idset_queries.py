"""Id-set queries: order keys of lineitem against order keys of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import idset as ids
from quarry.operators.common import materialize
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources.tables import read_table


def _items(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))


def _orders(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))


@register("bitmap_cardinality")
def bitmap_cardinality(spark, sf_dir):
    return ids.cardinality(ids.to_bitmaps(_items(spark, sf_dir), "id"))


@register("bitmap_or")
def bitmap_or(spark, sf_dir):
    a = ids.to_bitmaps(_items(spark, sf_dir), "id")
    b = ids.to_bitmaps(_orders(spark, sf_dir), "id")
    return ids.bucket_cardinality(ids.bitmap_or(a, b))


@register("bitmap_and")
def bitmap_and(spark, sf_dir):
    a = ids.to_bitmaps(_items(spark, sf_dir), "id")
    b = ids.to_bitmaps(_orders(spark, sf_dir), "id")
    return ids.bucket_cardinality(ids.bitmap_and(a, b))


@register("id_contains")
def id_contains(spark, sf_dir):
    return ids.contains(_items(spark, sf_dir), "id", _orders(spark, sf_dir), "id")


@register("id_rank")
def id_rank(spark, sf_dir):
    return ids.ranks(_items(spark, sf_dir), "id", _orders(spark, sf_dir), "id")


@register("id_select")
def id_select(spark, sf_dir):
    return ids.positions(_items(spark, sf_dir), "id")


@register("id_set_equal")
def id_set_equal(spark, sf_dir):
    items = materialize(ids.to_bitmaps(_items(spark, sf_dir), "id"))
    orders = _orders(spark, sf_dir)
    all_orders = ids.to_bitmaps(orders, "id")
    with_items = ids.to_bitmaps(orders.join(_items(spark, sf_dir).distinct(), "id", "left_semi"), "id")
    a = ids.sets_equal(items, all_orders).select(F.lit("items_vs_orders").alias("pair"), "equal")
    b = ids.sets_equal(items, with_items).select(F.lit("items_vs_orders_with_items").alias("pair"), "equal")
    return a.union(b)


@register("bitmap_roundtrip")
def bitmap_roundtrip(spark, sf_dir):
    a = ids.pack(ids.to_bitmaps(_items(spark, sf_dir), "id")).withColumn("set_name", F.lit("items"))
    b = ids.pack(ids.to_bitmaps(_orders(spark, sf_dir), "id")).withColumn("set_name", F.lit("orders"))
    path = scratch_path(spark, "bitmaps")
    a.union(b).write.mode("overwrite").parquet(path)
    words = ids.unpack(spark.read.parquet(path))
    return words.groupBy("set_name").agg(F.sum(F.bit_count("bits")).cast("long").alias("cardinality"))
