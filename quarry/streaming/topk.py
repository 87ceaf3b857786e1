"""The first k keys after every micro-batch, kept from the changed keys alone.

Keys are dealt to buckets. Each bucket keeps its best ``2 k`` keys and a ceiling: no key outside the list
is above it. A batch merges its changed keys into the lists, so its work follows the batch and
``2 k`` rows a bucket. Values may fall: when the k-th best of all lists is no longer above some bucket's
ceiling, that bucket's list is made again from the state store, which has all keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.relational import top_k

BUCKETS = 64


def top_k_sink(path: str, key: str, value: str, k: int, state_after: Callable[[int], DataFrame],
               buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink for an update-mode stream of changed ``key, value`` rows: writes the first ``k`` by
    value, then key, to ``path/top/batch=<id>``. ``state_after(batch)`` is the whole table of keys after
    a batch. Every batch reads its predecessor's lists and replaces its own, so a replay is harmless."""
    order = [F.desc(value), F.asc(key)]
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    lists = f"bucket int, `{key}` string, `{value}` double, cut boolean"

    def cut_lists(rows: DataFrame, ceilings: DataFrame | None) -> DataFrame:
        """Best rows per bucket and, as a row that is ``cut``, its ceiling."""
        ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("bucket").orderBy(*order)))
        ranked = ranked.where(F.col("rank") <= 2 * k + 1)
        held = ranked.select("bucket", key, value, (F.col("rank") > 2 * k).alias("cut"))
        return held if ceilings is None else held.unionByName(ceilings)

    def sink(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession

        def kept(frame: DataFrame, name: str) -> DataFrame:
            frame.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch}")
            return spark.read.schema(frame.schema).parquet(f"{path}/{name}/batch={batch}")

        changed = kept(df.select(bucket, F.col(key).cast("string").alias(key), F.col(value).cast("double").alias(value)), "changed")
        rows, ceilings = changed, None
        if batch:
            before = spark.read.schema(lists).parquet(f"{path}/lists/batch={batch - 1}")
            ceilings = before.where("cut")
            rows = before.where(~F.col("cut")).drop("cut").join(changed.select(key), key, "left_anti").select(
                "bucket", key, value).unionByName(changed)
        merged = kept(cut_lists(rows, ceilings), "merged")
        best = top_k(merged.where(~F.col("cut")), k, order).collect()          # k rows
        worst = best[-1][value] if len(best) == k else float("-inf")
        low = [r.bucket for r in merged.where(F.col("cut")).groupBy("bucket").agg(F.max(value).alias("top"))
               .where(F.col("top") >= worst).select("bucket").collect()] if batch else []      # at most ``buckets`` rows
        if low:
            whole = state_after(batch - 1).select(bucket, F.col(key).cast("string").alias(key), F.col(value).cast("double").alias(value))
            again = whole.where(F.col("bucket").isin(low)).join(changed.select(key), key, "left_anti").select(
                "bucket", key, value).unionByName(changed.where(F.col("bucket").isin(low)))
            merged = merged.where(~F.col("bucket").isin(low)).unionByName(cut_lists(again, None))
        held = merged.groupBy("bucket", "cut", F.when(~F.col("cut"), F.col(key)).alias(key)).agg(F.max(value).alias(value))
        held = kept(held.select("bucket", key, value, "cut"), "lists")
        kept(top_k(held.where(~F.col("cut")).select(key, value), k, order), "top")

    return sink
