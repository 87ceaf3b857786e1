"""Mixing sources to target weights by weighted fair queueing (operator 6), DataFrame functions only.

Each source's documents are shuffled by a hash of the id and queued up to ``MAX_REPEATS`` times.
A queued copy's virtual finish time is the source's cumulative size up to its end divided by the
source's target. Copies are taken in order of finish time until the total budget is reached.

Cumulative sums never run over a whole source or the whole table in one window. Rows fall into
buckets of the shuffle hash (within a source) or of the finish time (globally); per-bucket sums are
aggregated before any shuffle and prefix-summed, and only the rows of one bucket meet in a window.
The number of buckets follows the row count, so a bucket keeps its size however large a source is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import free_name, saved
from quarry.operators.common import FANOUT_BITS, TOP_BITS, bucket_bases

# Weights repeating over the sources in code-point order, budget and repeat limits.
WEIGHTS = (5, 2, 1)
BUDGET_PCT = 150
MAX_REPEATS = 2
WORD = r"[^\x20\x09-\x0D]+"

BUCKET_ROWS = 512           # rows one window meets on average
HASH_HEX = 13               # 52 bits of the shuffle hash


def word_count(text: Column) -> Column:
    """Number of blank-separated words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_hash(key: Column, seed: int) -> Column:
    """52-bit position of a document in its source's shuffled order."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, HASH_HEX), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget_pct: int = BUDGET_PCT,
            repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, source_size, target)`` from one row per source ``(source, source_size)``.

    Sources by code point, null last, take the weights in turn. The budget is shared by weight; a
    target stops at ``repeats`` times its source and the excess is shared again. With the sources
    sorted by the level ``cap / weight`` at which they fill up, the shares follow from running sums
    instead of repeated rounds. The windows run over one row per source, never over documents.
    """
    n = len(weights)
    name = F.col("source").asc_nulls_last()
    rank = F.row_number().over(Window.orderBy(name)) - 1
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (rank % n + 1).cast("int"))
    level = Window.orderBy(F.col("cap") / F.col("w"), name)
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    none = F.lit(0.0)
    s = (sizes.select("source", "source_size", w.alias("w"),
                      (F.col("source_size") * repeats).cast("double").alias("cap"))
              .withColumn("left", F.sum("source_size").over(whole) * budget_pct / F.lit(100.0)
                          - F.coalesce(F.sum("cap").over(before), none))
              .withColumn("w_left", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), none))
              .withColumn("at", F.row_number().over(level)))
    # the first source that its share does not fill fixes the level for all after it
    open_share = F.when(F.col("left") * F.col("w") / F.col("w_left") < F.col("cap"), F.struct("at", "left", "w_left"))
    s = s.withColumn("stop", F.min(open_share).over(whole))
    fair = F.col("stop.left") * F.col("w") / F.col("stop.w_left")
    capped = F.col("stop").isNull() | (F.col("at") < F.col("stop.at"))
    return s.select("source", "source_size", F.when(capped, F.col("cap")).otherwise(fair).alias("target"))


KEY = ("src", "name", "size", "pos")


def queue_key(doc_id: str, source: str, text: str, seed: int) -> list[Column]:
    """The columns ``KEY``: null-free names of source and document, size, place in the shuffled order."""
    c = lambda x: F.col(f"`{x}`")
    ident = F.coalesce(c(doc_id).cast("string"), c(text), F.lit(""))
    return [F.coalesce(F.concat(F.lit("="), c(source).cast("string")), F.lit("")).alias("src"),
            F.coalesce(c(doc_id).cast("string"), F.lit("")).alias("name"),
            word_count(c(text)).alias("size"), shuffle_hash(ident, seed).alias("pos")]


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0,
        weights: tuple[int, ...] = WEIGHTS, budget_pct: int = BUDGET_PCT, repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``,
    ``taken`` and the struct ``key`` that identifies its place in the queue.

    ``copies`` (0 to ``repeats``) is how often the mix takes the document, ``taken`` the words that
    makes. The order depends on ids and seed alone, so reruns agree. Null texts have size 0; null
    sources form one source, the last; null ids are shuffled by their text; rows that agree in id,
    source and size are taken alike. An empty table gives an empty result.
    """
    base = saved(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
                             *queue_key(doc_id, source, text, seed)), "mix-sizes")
    all_rows = base.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("words")).first()
    buckets = max(1, -(-all_rows["n"] // BUCKET_ROWS))
    width = -(-(1 << (4 * HASH_HEX)) // buckets)
    levels = max(0, -(-((buckets * 8).bit_length() - TOP_BITS) // FANOUT_BITS))
    base = base.withColumn("bucket", F.expr(f"pos div {width}"))

    sums = base.groupBy("src", "bucket").agg(F.sum("size").alias("words"), F.max("source").alias("source"))
    shares = targets(sums.groupBy("src").agg(F.sum("words").alias("source_size"), F.max("source").alias("source"))
                     .select("source", "source_size"), weights, budget_pct, repeats)
    shares = shares.select(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("src"),
                           "source_size", "target")
    starts = bucket_bases(sums, ["src"], "bucket", "words", levels).join(shares, "src")
    inside = Window.partitionBy("src", "bucket").orderBy("pos", "name", "size")      # peers end together
    queued = (base.join(starts, ["src", "bucket"])
                  .withColumn("cum", F.col("base") + F.sum("size").over(inside)))
    # a virtual finish time for each copy; a document without words has none
    finish = F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), lambda k:
                         (F.col("cum") + k * F.col("source_size")).cast("double") / F.col("target"))
    queued = saved(queued.withColumn("finish", F.when(F.col("size") > 0, finish))
                   .drop("bucket", "base", "cum"), "mix-queue")

    copies = queued.select("src", "name", "size", "pos", F.explode("finish").alias("finish")).withColumn(
        "slot", F.floor(F.col("finish") * buckets))
    per_slot = copies.groupBy("slot").agg(F.sum("size").alias("words"))
    ends = bucket_bases(per_slot, [], "slot", "words", levels).join(per_slot, "slot")
    within = lambda words: words * 100 <= F.lit(all_rows["words"] * budget_pct)
    edge = ends.where(within(F.col("base")) & ~within(F.col("base") + F.col("words"))).first()
    place = F.struct("finish", "pos", "src", "name", "size")
    if edge is None:                                     # the budget covers every copy
        copies_taken = F.size("finish")
    else:
        # only the slice of time in which the budget ends is ordered row by row
        upto = Window.orderBy("finish", "pos", "src", "name", "size")
        last = (copies.where(F.col("slot") == edge["slot"])
                      .withColumn("total", F.lit(edge["base"]) + F.sum("size").over(upto))
                      .where(within(F.col("total"))).agg(F.max(place).alias("last")).first()["last"])
        in_time = lambda f: F.floor(f * buckets) < edge["slot"]
        if last is not None:
            stop = F.struct(*(F.lit(last[k]).alias(k) for k in ("finish", "pos", "src", "name", "size")))
            here = lambda f: F.struct(f.alias("finish"), "pos", "src", "name", "size") <= stop
            taken_if = lambda f: in_time(f) | ((F.floor(f * buckets) == edge["slot"]) & here(f))
        else:
            taken_if = in_time
        copies_taken = F.size(F.filter("finish", taken_if))
    n = F.when(F.col("size") > 0, copies_taken).otherwise(0)
    return queued.select("doc_id", "source", "size", "source_size", "target", n.alias("copies"),
                         (n * F.col("size")).cast("long").alias("taken"), F.struct(*KEY).alias("key"))


def take(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0,
         **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that the mix takes, each once, with ``copies``, ``size`` and
    ``target`` (underscores in front of a name that ``docs`` has)."""
    plan = mix(docs, doc_id, source, text, seed, **options).where("copies > 0").select("key.*", "copies", "target")
    plan = plan.groupBy(*KEY).agg(F.max("copies").alias("copies"), F.max("target").alias("target"))
    names = [free_name(docs, n) for n in ("copies", "size", "target")]
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                      *queue_key(doc_id, source, text, seed))
    return row.join(plan, list(KEY)).select("row.*", *(F.col(c).alias(n) for c, n in zip(("copies", "size", "target"),
                                                                                        names)))
