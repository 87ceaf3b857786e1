"""Window statistics over purchases and the lineitem supplier -> part graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import graph as gr
from quarry.operators import text as tx
from quarry.operators import windows as win
from quarry.plans.registry import register
from quarry.plans.relational_queries import purchases
from quarry.session import scratch_path
from quarry.sinks.files import write_text
from quarry.sources.tables import read_table

# The reference's batch and window lengths (5 s batches; 30 s and 60 s windows
# sliding every 5 s; the as-coded "60 s" is a 10 s / 5 s window over the 30 s results).
TUMBLE = "5 seconds"
SLIDE = "5 seconds"
WIN_30 = "30 seconds"
WIN_60 = "60 seconds"
WIN_OUTER = "10 seconds"


@register("win_tumbling")
def win_tumbling(spark, sf_dir):
    return win.tumbling(purchases(spark, sf_dir), "ts", TUMBLE, ["user_id"], "value")


@register("win_sliding_30")
def win_sliding_30(spark, sf_dir):
    return win.sliding(purchases(spark, sf_dir), "ts", WIN_30, SLIDE, ["user_id"], "value")


@register("win_sliding_60")
def win_sliding_60(spark, sf_dir):
    return win.sliding(purchases(spark, sf_dir), "ts", WIN_60, SLIDE, ["user_id"], "value")


@register("win_composed")
def win_composed(spark, sf_dir):
    s30 = win.sliding(purchases(spark, sf_dir), "ts", WIN_30, SLIDE, ["user_id"], "value")
    return win.composed(s30, WIN_OUTER, SLIDE, ["user_id"])


def lineitem_edges(spark, sf_dir):
    """Supplier -> part edges with disjoint id spaces (suppliers even, parts odd)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_suppkey") * 2).alias("src"), (F.col("l_partkey") * 2 + 1).alias("dst"))


@register("graph_load")
def graph_load(spark, sf_dir):
    e = lineitem_edges(spark, sf_dir)
    header = e.limit(1).select(F.lit("# supplier -> part edges: src dst").alias("value"))
    body = e.select(F.concat_ws("\t", F.col("src").cast("string"), F.col("dst").cast("string")).alias("value"))
    path = write_text(header.union(body), scratch_path(spark, "edges"))
    return gr.edges_from_text(tx.text_file(spark, path))


@register("graph_out_degree")
def graph_out_degree(spark, sf_dir):
    return gr.out_degree_vertices(lineitem_edges(spark, sf_dir))


@register("graph_vertex_join")
def graph_vertex_join(spark, sf_dir):
    """Attributes reset to 0 on all vertices, then the out-degrees joined in where there are any."""
    e = lineitem_edges(spark, sf_dir)
    reset = gr.vertices_of(e, F.lit(0).cast("long"))
    return gr.join_vertices(reset, gr.out_degrees(e), "degree")
