"""Per-word fan-out into a fixed number of bucket folders.

For every distinct non-empty word there is one line ``(word, value = "1")`` for each token equal
to it ignoring case (so ``The`` and ``the`` both get the lines of both). Words are spread over
``buckets`` folders by hash and sorted inside a file, so files and folders do not grow with the
vocabulary and a lookup reads one folder's matching row groups.

1. tokens are counted per word in one pass (partial aggregation folds hot words per task) and
   that vocabulary-sized table is materialized once;
2. counts are summed per case-folded word and joined back to every case variant;
3. each word's count is cut into chunks of at most ``chunk_rows`` lines, so a word with a third of
   all tokens is written by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.common import materialize

BUCKETS = 64


def fold_case(word: Column) -> Column:
    """Case folding character by character: upper, then lower, where upper is one character. Sigma and
    final sigma agree, while sharp s stays apart from ss."""
    def one(c: Column) -> Column:
        up = F.upper(c)
        return F.lower(F.when(F.length(up) == 1, up).otherwise(c))
    slow = F.array_join(F.transform(F.split(word, ""), one), "")
    return F.when(word.rlike(r"\A\p{ASCII}*\z"), F.lower(word)).otherwise(slow)


def bucket_of(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def fanout_by_word(tokens: DataFrame, path: str, word: str = "word", chunk_rows: int = 1_000_000,
                   buckets: int = BUCKETS) -> str:
    """Write the fan-out of the token column ``word`` under ``path``; returns ``path``."""
    words = tokens.select(F.col(word).alias("word")).where(F.length("word") > 0)
    # the only pass over the tokens; both uses below read this small table
    exact = materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("c"))
                        .withColumn("folded", fold_case(F.col("word"))))
    totals = exact.groupBy("folded").agg(F.sum("c").alias("n"))
    per_word = exact.select("word", "folded").join(totals, "folded").select("word", "n")
    chunks = per_word.select("word", "n", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(n - 1) div {chunk_rows}"))).alias("chunk"))
    sized = chunks.select("word", bucket_of(F.col("word"), buckets).alias("bucket"), "chunk",
                          F.least(F.lit(chunk_rows), F.col("n") - F.col("chunk") * chunk_rows).alias("len"))
    # the first chunks of a bucket's words go together; further chunks of a hot word to other tasks
    spread = sized.repartition(buckets, "bucket", "chunk").sortWithinPartitions("bucket", "word")
    lines = spread.select("word", F.explode(F.array_repeat(F.lit("1"), F.col("len").cast("int"))).alias("value"), "bucket")
    lines.write.mode("overwrite").partitionBy("bucket").parquet(path)
    return path


def read_fanout(spark, path: str, word: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Read a fan-out back: ``(word, value)``, all of it or one word's lines."""
    rows = spark.read.schema("word string, value string, bucket int").parquet(path)
    if word is not None:
        rows = rows.where((F.col("bucket") == bucket_of(F.lit(word), buckets)) & (F.col("word") == word))
    return rows.select("word", "value")
