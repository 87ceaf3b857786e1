"""One key holding a third (or more) of all rows: results stay whole and exact."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import relational as rel
from quarry.operators import text as tx
from quarry.operators.common import dense_positions
from quarry.session import scratch_path
from quarry.sinks.fanout import fanout_by_word, read_fanout


def _hot_words(spark, n=3000):
    # "hot" is a third of all tokens; the rest are spread over many words
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                 .otherwise(F.concat(F.lit("w"), (F.col("id") % 97).cast("string"))).alias("word"))


def test_fanout_splits_a_hot_word_into_chunks(spark):
    words = _hot_words(spark)
    path = fanout_by_word(words, scratch_path(spark, "t-hotfan"), chunk_rows=64)
    back = read_fanout(spark, path)
    got = {r.word: r.n for r in back.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    want = {r.word: r["count"] for r in words.groupBy("word").count().collect()}
    assert got == want and got["hot"] == 1000
    # the hot word (16 chunks) was written by many tasks; folders do not grow with the vocabulary
    raw = spark.read.parquet(path).where(F.col("word") == "hot")
    assert raw.select(F.input_file_name().alias("f")).distinct().count() > 4
    assert read_fanout(spark, path, "hot").count() == 1000


def test_word_count_with_hot_word(spark):
    lines = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("the the"))
                                     .otherwise(F.lit("a b")).alias("line"))
    got = {r.word: r["count"] for r in tx.word_count(lines).collect()}
    assert got == {"the": 2000, "a": 2000, "b": 2000}


def test_dense_positions_with_dominant_group(spark):
    df = spark.range(0, 20000).select(F.when(F.col("id") % 10 < 8, F.lit("big")).otherwise(F.lit("small")).alias("g"),
                                      (F.col("id") * 7 + 3).alias("k"))
    got = dense_positions(df, ["g"], "k", bucket_width=500)
    ref = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    assert got.exceptAll(ref.select(*got.columns)).count() == 0


def test_subtract_hot_left_key_not_shuffled(spark):
    left = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    right = spark.range(0, 9000, 2).select(F.col("id").alias("k"))
    out = rel.subtract(left, right)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    want = left.join(right, "k", "left_anti")
    # 3000 rows forced to 7, plus the row whose id is 7
    assert out.count() == want.count() and out.where("k = 7").count() == 3001
