"""File, catalog, cell-table and document queries (each writes to the shared scratch folder
and reads its own output back, so the written data is what gets checked)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators import cells as cl
from quarry.operators import docs as dc
from quarry.operators import text as tx
from quarry.plans.registry import register
from quarry.plans.text_queries import _doc_lines
from quarry.session import scratch_path
from quarry.sinks.fanout import fanout_by_word, read_fanout
from quarry.sinks.files import pair_lines, write_parquet, write_text
from quarry.sources import files as fs
from quarry.sources.tables import read_table

BULK_BATCHES = 10



@register("parquet_scan")
def parquet_scan(spark, sf_dir):
    return fs.load(spark, f"{sf_dir}/region.parquet")


@register("parquet_roundtrip")
def parquet_roundtrip(spark, sf_dir):
    path = write_parquet(read_table(spark, sf_dir, "lineitem"), scratch_path(spark, "lineitem"))
    return spark.read.parquet(path)


@register("schema_merge")
def schema_merge(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    root = scratch_path(spark, "merged")
    small, large = F.col("p_size") <= 25, F.col("p_size") > 25
    write_parquet(p.where(small).select(F.col("p_partkey").alias("single"), (F.col("p_partkey") * 2).alias("double")),
                  f"{root}/key=1")
    write_parquet(p.where(large).select(F.col("p_partkey").alias("single"), (F.col("p_partkey") * 3).alias("triple")),
                  f"{root}/key=2")
    return fs.read_merged(spark, root).withColumn("key", F.col("key").cast("int"))


@register("save_as_table")
def save_as_table(spark, sf_dir):
    c = fs.load(spark, f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("info"))
    s = fs.load(spark, f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name")
    name = f"tb_logs_{uuid.uuid4().hex[:8]}"
    t = fs.save_as_table(c.union(s), name, scratch_path(spark, name))
    if name not in fs.table_names(spark):
        raise RuntimeError(f"{name} not listed in the catalog")
    return t


@register("load_table")
def load_table(spark, sf_dir):
    n = read_table(spark, sf_dir, "nation")
    src = write_text(n.select(F.concat_ws("\x01", F.col("n_nationkey").cast("string"), "n_name")),
                     scratch_path(spark, "kv"))
    name = f"src_{uuid.uuid4().hex[:8]}"
    fs.create_table(spark, name, "key INT, value STRING", scratch_path(spark, name))
    fs.load_delimited_into(spark, name, src)
    return spark.sql(f"FROM {name} SELECT key, value")


@register("text_pairs_roundtrip")
def text_pairs_roundtrip(spark, sf_dir):
    counts = tx.word_count(_doc_lines(spark, sf_dir))
    path = write_text(pair_lines(counts, "word", "count"), scratch_path(spark, "pairs"))
    return tx.text_file(spark, path)


@register("fanout_by_word")
def fanout_by_word_q(spark, sf_dir):
    words = tx.explode_tokens(_doc_lines(spark, sf_dir))
    path = fanout_by_word(words, scratch_path(spark, "fanout"))
    back = read_fanout(spark, path)
    return back.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("value"))


# --- cells ---------------------------------------------------------------------------------
def _customer_cells(spark, sf_dir, version=1):
    c = read_table(spark, sf_dir, "customer")
    return cl.to_cells(c, F.lpad(F.col("c_custkey").cast("string"), 10, "0"), "cf",
                       {"name": F.col("c_name"), "acctbal": F.col("c_acctbal").cast("decimal(18,2)"),
                        "segment": F.col("c_mktsegment")}, version)


def _cell_store(spark, sf_dir):
    return cl.put(_customer_cells(spark, sf_dir), scratch_path(spark, "cells"))


@register("cells_full_scan")
def cells_full_scan(spark, sf_dir):
    cells = cl.stored(spark, _cell_store(spark, sf_dir))
    return cl.to_rows(cells, "cf", {"name": "string", "acctbal": "double", "segment": "string"})


@register("cells_range_scan")
def cells_range_scan(spark, sf_dir):
    cells = cl.scan(spark, _cell_store(spark, sf_dir))
    rng = cl.range_scan(cells, "0000000100", "0000000200", "cf", ["name", "acctbal"])
    one = cl.range_scan(cells, "0000000500", "0000000500", "cf")
    return rng.union(one).select("row_key", "family", "qualifier", "value")


@register("cells_filter_scan")
def cells_filter_scan(spark, sf_dir):
    cells = cl.scan(spark, _cell_store(spark, sf_dir))
    return cl.filter_scan(cells, "cf", "7", "a").select("row_key", "family", "qualifier", "value")


@register("cells_put")
def cells_put(spark, sf_dir):
    path = _cell_store(spark, sf_dir)
    s = read_table(spark, sf_dir, "supplier")
    # the same version as the first put: the later put wins
    second = cl.to_cells(s, F.lpad(F.col("s_suppkey").cast("string"), 10, "0"), "cf",
                         {"name": F.col("s_name"), "acctbal": F.col("s_acctbal").cast("decimal(18,2)")}, 1)
    cl.put(second, path)
    return cl.scan(spark, path).select("row_key", "family", "qualifier", "value")


# --- documents -----------------------------------------------------------------------------
def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


@register("docs_from_maps")
def docs_from_maps(spark, sf_dir):
    e = _events(spark, sf_dir)
    docs = dc.map_docs(e, {"id": F.col("event_id"), "type": F.col("event_type"), "user": F.col("user_id"),
                           "value": F.col("value").cast("decimal(18,2)")})
    path = write_text(docs, scratch_path(spark, "mapdocs"))
    return spark.read.schema("id string, type string, user string, value string").json(path)


@register("docs_from_json")
def docs_from_json(spark, sf_dir):
    """JSON strings written as typed documents; every seventh event's string is torn and goes apart."""
    e = _events(spark, sf_dir).select("event_id", F.when(F.col("event_id") % 7 == 0, F.expr("substring(props, 1, length(props) - 1)"))
                                      .otherwise(F.col("props")).alias("props"))
    path = dc.write_parsed(dc.parse_docs(e, "props", "k INT", keep=["event_id"]), scratch_path(spark, "jsondocs"))
    good = spark.read.schema("event_id long, k int").json(f"{path}/docs").withColumn("bad_doc", F.lit(None).cast("string"))
    bad = spark.read.schema("event_id long, bad_doc string").json(f"{path}/bad")
    return good.unionByName(bad, allowMissingColumns=True)


@register("docs_routed")
def docs_routed(spark, sf_dir):
    e = _events(spark, sf_dir).select("event_id", "user_id", "value", "event_type")
    path = dc.write_docs(e, scratch_path(spark, "routed"), route="event_type", mode="overwrite")
    return spark.read.schema("event_id long, user_id long, value double, event_type string").json(path)


@register("docs_upsert")
def docs_upsert(spark, sf_dir):
    e = _events(spark, sf_dir)
    path = scratch_path(spark, "docstore")
    first = e.select(F.col("event_id").alias("id"), "user_id", "value", F.lit(1).cast("long").alias("version"))
    dc.write_docs(first, path)
    again = e.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("id"), "user_id", (F.col("value") * 2).alias("value"), F.lit(2).cast("long").alias("version"))
    dc.write_docs(again, path)
    stored = spark.read.schema("id long, user_id long, value double, version long").json(path)
    return dc.newest(stored, "id").select("id", "user_id", "value", "version")


def bulk_docs(spark, sf_dir):
    """``(batch, id, content)``: the documents' texts, cut into ``BULK_BATCHES`` batches."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(F.pmod("doc_id", F.lit(BULK_BATCHES)).cast("int").alias("batch"),
                    F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"))


@register("docs_bulk")
def docs_bulk(spark, sf_dir):
    path = dc.write_docs(bulk_docs(spark, sf_dir), scratch_path(spark, "bulk"), route="batch", mode="overwrite")
    back = spark.read.schema("id string, content string, batch int").json(path)
    return back.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"),
                                     F.sum(F.length("content")).alias("chars"))
