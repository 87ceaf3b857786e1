"""Id sets as 64-bit words, packed containers and distinct id columns.

A set of integer ids is worked on as ``(word, bits)`` rows: 64 consecutive ids a row, made by a partial
and final hash aggregate, so duplicates (even a third of all rows on one id) collapse in the map tasks
and a lone id takes one small row. Set algebra works word by word. ``pack`` turns a set into containers of
32,768 ids for storage: a sorted array of two-byte positions where a bucket holds few ids, a bitmap of
4 KiB where it holds many. Order statistics (rank, select) use bounded key-range buckets and prefix sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.common import bucket_bases, dense_positions, levels_for, materialize


WORD_BITS, BUCKET_WORDS = 6, 512         # 64 ids a word, 512 words a bucket
MOST_POSITIONS = 2048                    # from here on a bitmap is no larger than the positions


def to_bitmaps(df: DataFrame, col: str) -> DataFrame:
    """``(word, bits)`` for the distinct values of ``col`` (nulls ignored). Id 1 is bit 0 of word 0, so that
    512 words are a bucket of Spark's bitmap functions."""
    at = F.col(col).cast("long") - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))
    return (df.where(F.col(col).isNotNull())
              .groupBy(F.shiftright(at, WORD_BITS).alias("word"))
              .agg(F.bit_or(bit).alias("bits")))


def add_range(bitmaps: DataFrame, spark, start: int, end_inclusive: int) -> DataFrame:
    """Set plus every id in ``[start, end_inclusive]``."""
    extra = to_bitmaps(spark.range(start, end_inclusive + 1).withColumnRenamed("id", "v"), "v")
    return bitmap_or(bitmaps, extra)


def cardinality(bitmaps: DataFrame) -> DataFrame:
    """One row: number of members."""
    return bitmaps.agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("long").alias("cardinality"))


def bucket_cardinality(bitmaps: DataFrame) -> DataFrame:
    """Members per bucket of 32,768 ids (bucket 1 holds 1 to 32,768)."""
    return bitmaps.groupBy((F.shiftright("word", 9) + 1).alias("bucket")).agg(
        F.sum(F.bit_count("bits")).cast("long").alias("cardinality"))


def bitmap_or(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union: OR of the words."""
    return a.select("word", "bits").union(b.select("word", "bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def bitmap_and(a: DataFrame, b: DataFrame) -> DataFrame:
    """Intersection: AND per word; a word present on one side only drops out."""
    tagged = a.select("word", "bits", F.lit(1).alias("side")).union(b.select("word", "bits", F.lit(2).alias("side")))
    g = tagged.groupBy("word").agg(F.bit_and("bits").alias("bits"), F.min("side").alias("lo"), F.max("side").alias("hi"))
    return g.where((F.col("lo") != F.col("hi")) & (F.col("bits") != 0)).select("word", "bits")


def sets_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row ``equal``: true when no word differs (the two sides cancel out)."""
    both = a.select("word", "bits").union(b.select("word", "bits"))
    left = both.groupBy("word").agg(F.bit_xor("bits").alias("bits")).where(F.col("bits") != 0)
    return left.limit(1).agg((F.count(F.lit(1)) == 0).alias("equal"))


def pack(bitmaps: DataFrame) -> DataFrame:
    """``(bucket, positions, words)``: one container per bucket, sorted two-byte ``positions`` for up to
    ``MOST_POSITIONS`` ids, else all 512 ``words``; the other column is null."""
    inner = F.struct(F.pmod("word", F.lit(BUCKET_WORDS)).cast("int").alias("w"), "bits")
    g = bitmaps.groupBy((F.shiftright("word", 9) + 1).alias("bucket")).agg(
        F.sum(F.bit_count("bits")).alias("n"), F.sort_array(F.collect_list(inner)).alias("ws"))     # at most 512 words
    positions = F.expr("flatten(transform(ws, x -> transform(filter(sequence(0, 63), i -> (shiftright(x.bits, i) & 1) = 1), "
                       "i -> cast(x.w * 64 + i as smallint))))")
    words = F.expr("transform(sequence(0, 511), w -> coalesce(get(filter(ws, x -> x.w = w), 0).bits, 0L))")
    few = F.col("n") <= MOST_POSITIONS
    return g.select("bucket", F.when(few, positions).alias("positions"), F.when(~few, words).alias("words"))


def unpack(containers: DataFrame) -> DataFrame:
    """``(word, bits)`` again; containers of one bucket (of several packed sets) are merged by OR. Other
    columns, such as the name of a set, keep sets apart."""
    others = [c for c in containers.columns if c not in ("bucket", "positions", "words")]
    base = ((F.col("bucket") - 1) * BUCKET_WORDS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(63).cast("int"))
    few = containers.where("positions IS NOT NULL").select(*others, "bucket", F.explode("positions").alias("p")) \
        .select(*others, (base + F.shiftright("p", WORD_BITS)).alias("word"), bit.alias("bits"))
    many = containers.where("words IS NOT NULL").select(*others, "bucket", F.posexplode("words").alias("w", "bits")) \
        .where("bits != 0").select(*others, (base + F.col("w")).alias("word"), "bits")
    return few.union(many).groupBy(*others, "word").agg(F.bit_or("bits").alias("bits"))


def contains(members: DataFrame, col: str, probes: DataFrame, probe_col: str) -> DataFrame:
    """``(probe, contained)`` for each probe row: an existence join on the distinct members."""
    keys = members.select(F.col(col).alias("_q_m")).distinct()
    j = probes.join(keys, probes[probe_col] == keys["_q_m"], "left")
    return j.select(F.col(probe_col).alias("id"), F.col("_q_m").isNotNull().alias("contained"))


def positions(members: DataFrame, col: str) -> DataFrame:
    """``(j, id)``: every distinct member with its 0-based position in ascending order.

    ``select(j)`` is a filter on ``j``; iterating in order is ``orderBy(j)``. No window spans
    the whole set; see ``dense_positions``.
    """
    ids = materialize(members.select(F.col(col).alias("id")).where(F.col("id").isNotNull()).distinct())
    return dense_positions(ids, [], "id", out="j").select("j", "id")


def select_at(members: DataFrame, col: str, j: int) -> DataFrame:
    """The j-th smallest member (0-based), as one row, or no row when j is out of range."""
    return positions(members, col).where(F.col("j") == j).select("id")


def ranks(members: DataFrame, col: str, probes: DataFrame, probe_col: str,
          bucket_width: int = 1 << 16) -> DataFrame:
    """``(x, rank)`` for each distinct probe x: number of members <= x.

    Members and probes are merged per key-range bucket; a running count of members inside the
    bucket (members sort before an equal probe) plus the members of all earlier buckets gives
    the rank. Each window partition holds one bucket (at most ``bucket_width`` members and as
    many distinct probes).
    """
    m = materialize(members.select(F.col(col).alias("v")).where(F.col("v").isNotNull()).distinct()
                    .withColumn("is_m", F.lit(1)))
    p = materialize(probes.select(F.col(probe_col).alias("v")).where(F.col("v").isNotNull()).distinct()
                    .withColumn("is_m", F.lit(0)))
    bkt = F.floor(F.col("v") / F.lit(bucket_width)).cast("long")
    both = m.union(p).withColumn("_q_bkt", bkt)
    counts = m.groupBy(bkt.alias("_q_bkt")).agg(F.count(F.lit(1)).alias("_q_n"))
    # buckets holding only probes still need a base: give them a zero count
    all_bkts = both.select("_q_bkt").distinct().join(counts, "_q_bkt", "left") \
                   .select("_q_bkt", F.coalesce("_q_n", F.lit(0)).alias("_q_n"))
    bases = bucket_bases(all_bkts, [], "_q_bkt", "_q_n", levels_for(both, "v", bucket_width))
    w = Window.partitionBy("_q_bkt").orderBy(F.col("v"), F.col("is_m").desc()) \
              .rowsBetween(Window.unboundedPreceding, 0)
    ranked = both.join(bases, "_q_bkt").withColumn("_q_run", F.sum("is_m").over(w))
    return ranked.where(F.col("is_m") == 0).select(F.col("v").alias("x"),
                                                   (F.col("base") + F.col("_q_run")).cast("long").alias("rank"))
