"""Relational queries: projections, filters, joins, set operations, aggregates, top-k."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import functions as F

from quarry.functions.text import exact_sum, weighted_score, weighted_total
from quarry.operators import relational as rel
from quarry.operators import text as tx
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sinks.files import write_text
from quarry.sources.tables import TABLES, read_table

# The page-popularity weights of the reference (a*0.8 + b*0.8 + c*1).
POPULARITY_WEIGHTS = (0.8, 0.8, 1.0)


def _people_lines(spark, sf_dir):
    """``name, age`` text lines derived from customer, written as a text file and scanned back."""
    c = read_table(spark, sf_dir, "customer")
    path = write_text(c.select(F.concat_ws(", ", "c_name", F.col("c_nationkey").cast("string"))),
                      scratch_path(spark, "people"))
    return tx.text_file(spark, path)


@register("select_where")
def select_where(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    return rel.select_where(c, [F.col("c_name").alias("name"), F.col("c_nationkey").alias("age")],
                            F.col("c_nationkey") >= 13)


@register("typed_records")
def typed_records(spark, sf_dir):
    return tx.typed_records(_people_lines(spark, sf_dir), [("name", "string"), ("age", "int")])


@register("dynamic_schema_records")
def dynamic_schema_records(spark, sf_dir):
    return tx.dynamic_schema_records(_people_lines(spark, sf_dir), "name age")


@register("string_numeric_filter")
def string_numeric_filter(spark, sf_dir):
    people = tx.dynamic_schema_records(_people_lines(spark, sf_dir), "name age")
    return people.where(tx.numeric_at_least("age", 13)).select("name", "age")


@register("row_format")
def row_format(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    adults = rel.select_where(c, [F.col("c_name").alias("name"), F.col("c_nationkey").alias("age")],
                              F.col("c_nationkey") >= 13)
    by_index = F.concat(F.lit("Name[get by index]="), F.col(adults.columns[0]))
    by_name = F.concat(F.lit("Name[get by fieldName]="), F.col("name"))
    return adults.select(by_index.alias("by_index"), by_name.alias("by_name"))


@register("from_first")
def from_first(spark, sf_dir):
    view = f"src_{uuid.uuid4().hex[:8]}"
    read_table(spark, sf_dir, "nation").createOrReplaceTempView(view)
    return spark.sql(f"FROM {view} SELECT n_nationkey AS key, n_name AS value")


@register("view_query")
def view_query(spark, sf_dir):
    view = f"lineitem_{uuid.uuid4().hex[:8]}"
    read_table(spark, sf_dir, "lineitem").createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT l_returnflag, l_linestatus, count(*) AS n,
               CAST(sum(CAST(l_quantity AS DECIMAL(38,10))) AS DOUBLE) AS qty
        FROM {view} GROUP BY l_returnflag, l_linestatus""")


@register("join_sum_count")
def join_sum_count(spark, sf_dir):
    """Two keyed aggregates of one table, joined on the key."""
    o = read_table(spark, sf_dir, "orders")
    sums = o.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("order_sum"))
    counts = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("order_cnt"))
    both = rel.inner_join(sums, counts, ["o_custkey"])
    return both.withColumn("order_avg", F.col("order_sum") / F.col("order_cnt"))


@register("sum_count_one_pass")
def sum_count_one_pass(spark, sf_dir):
    """The same result from one aggregate, without a join."""
    o = read_table(spark, sf_dir, "orders")
    return rel.sum_count_avg(o, ["o_custkey"], "o_totalprice", prefix="order_")


@register("cartesian")
def cartesian(spark, sf_dir):
    return rel.cartesian(read_table(spark, sf_dir, "region"), read_table(spark, sf_dir, "nation"))


def _customer_keys(spark, sf_dir):
    """Left: the customer key of every order (duplicates); right: customers in credit."""
    left = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"))
    c = read_table(spark, sf_dir, "customer")
    right = c.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("custkey"))
    return left, right


@register("subtract")
def subtract(spark, sf_dir):
    return rel.subtract(*_customer_keys(spark, sf_dir))


@register("intersection")
def intersection(spark, sf_dir):
    return rel.intersection(*_customer_keys(spark, sf_dir))


@register("union_all")
def union_all(spark, sf_dir):
    c = spark.read.load(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("info"))
    s = spark.read.load(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name")
    return rel.union_all(c, s)


def popularity(spark, sf_dir):
    """``(page, pop)``: summed weighted score per part over lineitem, rounded once."""
    li = read_table(spark, sf_dir, "lineitem")
    pop = weighted_total(["l_quantity", "l_discount", "l_tax"], POPULARITY_WEIGHTS)
    return li.groupBy(F.col("l_partkey").alias("page")).agg(pop.alias("pop"))


@register("top_pages")
def top_pages(spark, sf_dir):
    return rel.top_k(popularity(spark, sf_dir), 10, [F.desc("pop"), F.asc("page")])


@register("weighted_score")
def weighted_score_q(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    score = weighted_score(["l_quantity", "l_discount", "l_tax"], POPULARITY_WEIGHTS)
    return li.select("l_orderkey", "l_linenumber", score.alias("score"))


@register("take_n")
def take_n(spark, sf_dir):
    return rel.take_n(read_table(spark, sf_dir, "orders"), 10, [F.asc("o_orderkey")])


def purchases(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return e.where(F.col("event_type") == "purchase").select("user_id", "value", "ts")


@register("payment_sum")
def payment_sum(spark, sf_dir):
    return purchases(spark, sf_dir).groupBy("user_id").agg(exact_sum("value").alias("total"))


@register("payment_count")
def payment_count(spark, sf_dir):
    return purchases(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))


@register("payment_avg")
def payment_avg(spark, sf_dir):
    return rel.sum_count_avg(purchases(spark, sf_dir), ["user_id"], "value").select("user_id", "avg")


@register("observed_sum")
def observed_sum(spark, sf_dir):
    out, _obs = rel.observed_sum(read_table(spark, sf_dir, "lineitem"), "l_linenumber", 2)
    return out


@register("row_count")
def row_count(spark, sf_dir):
    parts = [read_table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
             for t in TABLES]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)
