"""Replayable log tables: ``(topic, partition, offset, key, value, timestamp)`` in Parquet,
partitioned by topic, partition, ``writer`` and the writer's ``batch``, read as a batch, as a file stream or
as a direct stream that starts at given offsets (``sources.logstream``).

A writer that is replayed (a ``foreachBatch`` retried after a failure) overwrites only its
own batch's folders (dynamic partition overwrite) and numbers its records after the offsets
of earlier batches, so a replay yields the same rows and offsets, never duplicates.

Offsets are dense per (topic, partition) and assigned with ``dense_positions`` (bounded
buckets plus prefix sums), so a partition holding a third of all records is still numbered by
many tasks. Every append leaves a small table of the offsets in its files and of each partition's next
offset (``_offsets/<number>.<writer>.<batch>``), so the next append reads one such table and no records.
Resuming clamps committed offsets into the log's current bounds; commits record the next offset to read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.operators.common import dense_positions, materialize

LOG_SCHEMA = ("offset long, key string, value binary, timestamp timestamp_ntz, "
              "topic string, partition int, writer string, batch long")


def to_log(records: DataFrame, topic: Column, partition: Column, key: Column, value: Column,
           order: str, timestamp: Column | None = None, writer: str = "", batch: int = 0) -> DataFrame:
    """Records -> log rows with dense offsets per (topic, partition) in ``order``."""
    base = records.select(topic.alias("topic"), partition.cast("int").alias("partition"),
                          key.cast("string").alias("key"), value.cast("binary").alias("value"),
                          (timestamp if timestamp is not None else F.lit(None).cast("timestamp_ntz")).alias("timestamp"),
                          F.col(order).alias("_q_order"))
    numbered = dense_positions(base, ["topic", "partition"], "_q_order", out="offset")
    return numbered.select("topic", "partition", "offset", "key", "value", "timestamp",
                           F.lit(writer or "0").alias("writer"),
                           F.lit(batch).cast("long").alias("batch"))


def write_log(log: DataFrame, path: str) -> str:
    """Write the rows of ``to_log`` as a new log."""
    (log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("topic", "partition", "writer", "batch").parquet(path))
    _write_offsets(log.sparkSession, path, read_log(log.sparkSession, path), None, 0, "0", 0)
    return path


OFFSETS = "topic string, partition int, file string, earliest long, first long, next long"


def _appends(spark: SparkSession, path: str) -> list[tuple[int, str, int]]:
    """``(number, writer, batch)`` of every append, in order: folder names only, nothing is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_offsets")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName().split(".") for f in fs.listStatus(folder)]
    return sorted((int(n[0]), ".".join(n[1:-1]), int(n[-1])) for n in names)


def _write_offsets(spark: SparkSession, path: str, rows: DataFrame, before: DataFrame | None, number: int, writer: str,
                   batch: int) -> None:
    """One row per file that ``rows`` were read from, and one per partition that had records before."""
    own = rows.groupBy("topic", "partition", F.col("_metadata.file_path").alias("file")).agg(
        F.min("offset").alias("first"), (F.max("offset") + 1).alias("next"))
    out = own.withColumn("earliest", F.col("first"))
    if before is not None:
        kept = before.select("topic", "partition", F.lit(None).cast("string").alias("file"), "earliest",
                             F.col("latest").alias("first"), F.col("latest").alias("next"))
        out = out.unionByName(kept)
    out.select("topic", "partition", "file", "earliest", "first", "next").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/_offsets/{number:010d}.{writer}.{batch}")


def log_bounds(spark: SparkSession, path: str, appends: list[tuple[int, str, int]] | None = None) -> DataFrame:
    """``(topic, partition, earliest, latest)`` of a log from the table that its last append left."""
    n, writer, batch = (appends or _appends(spark, path))[-1]
    t = spark.read.schema(OFFSETS).parquet(f"{path}/_offsets/{n:010d}.{writer}.{batch}")
    return t.groupBy("topic", "partition").agg(F.min("earliest").alias("earliest"), F.max("next").alias("latest"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def stream_log(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The log as a file stream (each new file is read once; progress lives in the checkpoint).

    Without ``max_files`` every micro-batch takes all files present, so each partition's
    records are consumed as a whole prefix and commits never skip an unread offset. A cap
    trades that for smaller batches (files of one write have no order among themselves).
    """
    r = spark.readStream.schema(LOG_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def bounds(log: DataFrame) -> DataFrame:
    """``(topic, partition, earliest, latest)``; latest is the next offset to be written."""
    return log.groupBy("topic", "partition").agg(F.min("offset").alias("earliest"),
                                                 (F.max("offset") + 1).alias("latest"))


def clamp(committed: DataFrame, log_bounds: DataFrame, start: str = "earliest") -> DataFrame:
    """Start offset per partition of the log.

    A committed offset inside ``[earliest, latest]`` is kept; one outside (records deleted or a
    reset log) falls back to ``earliest``; a partition without a commit (new partitions too)
    starts at ``earliest`` or, with ``start='latest'``, at ``latest``.
    """
    j = log_bounds.join(committed.select("topic", "partition", "committed"), ["topic", "partition"], "left")
    fresh = F.col("earliest") if start == "earliest" else F.col("latest")
    inside = (F.col("committed") >= F.col("earliest")) & (F.col("committed") <= F.col("latest"))
    s = F.when(F.col("committed").isNull(), fresh).when(inside, F.col("committed")).otherwise(F.col("earliest"))
    return j.select("topic", "partition", "committed", "earliest", "latest", s.alias("start"))


def resume(log: DataFrame, starts: DataFrame) -> DataFrame:
    """Records at or after each partition's start offset (start table is one row per partition)."""
    return log.join(starts.select("topic", "partition", "start"), ["topic", "partition"]) \
              .where(F.col("offset") >= F.col("start")).drop("start")


def commits(batch: DataFrame) -> DataFrame:
    """Offsets to commit after a batch: next offset per (topic, partition)."""
    return batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def current_commits(committed: DataFrame) -> DataFrame:
    """Current commit per (topic, partition) from per-batch commit rows: the highest one, so a
    replayed or reordered batch can never move a commit backwards."""
    return committed.groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))


def append_records(spark: SparkSession, path: str, records: DataFrame, order: str, writer: str | None = None,
                   batch: int = 0) -> None:
    """Append records (topic, partition, key, value, timestamp, order column) to the log at ``path``.

    Offsets continue after those already there. A streaming writer names itself and its batch, and
    writing that batch again replaces it (idempotent replay) and nothing else. Without a writer each
    call is a writer of its own, so it can only add. The records are evaluated once; one writer appends
    at a time.
    """
    writer = writer or uuid.uuid4().hex
    records = materialize(records)
    numbered = to_log(records, F.col("topic"), F.col("partition"), F.col("key"), F.col("value"), order,
                      F.col("timestamp"), writer, batch)
    appends = _appends(spark, path)
    again = next((i for i, (_, w, b) in enumerate(appends) if (w, b) == (writer, batch)), len(appends))
    before = None
    if again:
        before = log_bounds(spark, path, appends[:again])
        last = before.select("topic", "partition", F.col("latest").alias("_q_next"))
        numbered = numbered.join(last, ["topic", "partition"], "left") \
                           .withColumn("offset", F.col("offset") + F.coalesce("_q_next", F.lit(0))).drop("_q_next")
    (numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("topic", "partition", "writer", "batch").parquet(path))
    own = read_log(spark, path).where((F.col("writer") == writer) & (F.col("batch") == batch))
    number = appends[again][0] if again < len(appends) else (appends[-1][0] + 1 if appends else 0)
    _write_offsets(spark, path, own, before, number, writer, batch)


def decode_sink(path: str, schema: str, key: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink for log rows: decoded records go to ``path/records/batch=<id>``, and how many the
    batch had and how many did not decode (``key`` is null) to ``path/counts/batch=<id>``, an empty
    batch with zeros. The counts are observed while the records are written."""
    def sink(df: DataFrame, batch: int) -> None:
        seen = Observation(f"decoded-{batch}")
        r = df.select(decode(F.col("value"), schema).alias("r"))
        watched = r.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col(f"r.{key}").isNull()).alias("bad"))
        watched.where(F.col(f"r.{key}").isNotNull()).select("r.*").write.mode("overwrite").parquet(f"{path}/records/batch={batch}")
        got = seen.get
        df.sparkSession.createDataFrame([(got["n"], got["bad"])], "n long, bad long").write.mode("overwrite").parquet(
            f"{path}/counts/batch={batch}")
    return sink


def encode(df: DataFrame, cols: list[str]) -> Column:
    """Typed record -> bytes (JSON of the fields)."""
    return F.to_json(F.struct(*cols)).cast("binary")


def decode(value: Column, schema: str) -> Column:
    """Bytes -> typed record struct; undecodable bytes give a struct of nulls."""
    return F.from_json(value.cast("string"), schema, {"mode": "PERMISSIVE"})
