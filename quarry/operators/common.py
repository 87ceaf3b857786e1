"""Building blocks shared by several operators.

* ``materialize``: compute an intermediate once into the shared checkpoint folder when several
  branches of a plan read it.
* ``dense_positions`` / ``bucket_bases``: 0-based position of each row inside its group,
  ordered by a unique long key, without a window over a whole group. Rows are cut into
  key-range buckets of bounded size; bucket counts are prefix-summed through as many levels as
  the key range needs and each row's position is the bucket base plus its rank inside the
  bucket. No task ever holds more than one bucket of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage: a reliable checkpoint in the shared folder named
    by ``spark.checkpoint.dir`` (survives executor loss). For intermediate results that feed
    several branches of a plan, which would otherwise be recomputed, scans included, per branch."""
    from quarry.session import shared_root
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


FANOUT_BITS = 10     # children per prefix-sum node: 1,024
TOP_BITS = 20        # the top window may hold up to about a million buckets


def levels_for(df: DataFrame, col: str, bucket_width: int) -> int:
    """Prefix-sum levels needed so the top window holds at most 2^TOP_BITS buckets, from the
    key range of ``col`` (one small aggregate; dense ids need 0, sparse 64-bit keys 3)."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    if r["lo"] is None:
        return 0
    buckets = (int(r["hi"]) - int(r["lo"])) // bucket_width + 1
    bits = max(0, buckets.bit_length() - TOP_BITS)
    return -(-bits // FANOUT_BITS)


def bucket_bases(counts: DataFrame, by: list[str], bkt: str, n: str, levels: int = 0) -> DataFrame:
    """Exclusive prefix sum of ``n`` over ``bkt`` within each ``by`` group: ``(by.., bkt, base)``.

    With ``levels > 0`` buckets are grouped into parents of 2^FANOUT_BITS (by key range), the
    parents' totals are prefix-summed recursively, and each bucket adds its offset inside the
    parent. Every window then holds at most 1,024 children, and the top one at most
    2^TOP_BITS buckets (``levels_for`` picks the depth).
    """
    if levels <= 0:
        w = Window.partitionBy(*by).orderBy(bkt).rowsBetween(Window.unboundedPreceding, -1)
        return counts.select(*by, bkt, F.coalesce(F.sum(n).over(w), F.lit(0)).cast("long").alias("base"))
    sup, tot = f"_q_sup{levels}", f"_q_tot{levels}"
    c = counts.withColumn(sup, F.shiftright(F.col(bkt), FANOUT_BITS))
    parents = bucket_bases(c.groupBy(*by, sup).agg(F.sum(n).alias(tot)), by, sup, tot, levels - 1) \
        .withColumnRenamed("base", "_q_pbase")
    w = Window.partitionBy(*by, sup).orderBy(bkt).rowsBetween(Window.unboundedPreceding, -1)
    inner = c.select(*by, sup, bkt, F.coalesce(F.sum(n).over(w), F.lit(0)).alias("_q_ibase"))
    return inner.join(parents, on=[*by, sup]).select(
        *by, bkt, (F.col("_q_pbase") + F.col("_q_ibase")).cast("long").alias("base"))


def dense_positions(df: DataFrame, by: list[str], order: str, out: str = "pos",
                    bucket_width: int = 1 << 16) -> DataFrame:
    """Add ``out`` = 0-based rank of ``order`` within each ``by`` group (``order`` unique per group).

    Equivalent to ``row_number() over (partition by by order by order) - 1`` but no window
    partition holds more than one key-range bucket of ``bucket_width`` keys, so a group holding
    a third of the data is spread across many tasks; bucket bases come from a prefix sum whose
    depth follows the key range (dense or sparse keys alike). The bucket-base table is joined back on
    (group, bucket); AQE turns that join into a broadcast when the table proves small at run
    time and otherwise keeps a skew-free shuffle join (every bucket is bounded).
    """
    bkt = F.floor(F.col(order) / F.lit(bucket_width)).cast("long")
    tagged = df.withColumn("_q_bkt", bkt)
    counts = tagged.groupBy(*by, "_q_bkt").agg(F.count(F.lit(1)).alias("_q_n"))
    bases = bucket_bases(counts, by, "_q_bkt", "_q_n", levels_for(df, order, bucket_width))
    # null-safe on every column: null groups and null order keys (one bucket, first) are numbered too
    at = bases.toDF(*[f"_q_b{i}" for i in range(len(by) + 1)], "base")
    cond = None
    for i, c in enumerate([*by, "_q_bkt"]):
        e = tagged[c].eqNullSafe(at[f"_q_b{i}"])
        cond = e if cond is None else cond & e
    joined = tagged.join(at, cond).drop(*at.columns[:-1])
    inside = Window.partitionBy(*by, "_q_bkt").orderBy(order)
    return (joined.withColumn(out, (F.col("base") + F.row_number().over(inside) - 1).cast("long"))
                  .drop("_q_bkt", "base"))
