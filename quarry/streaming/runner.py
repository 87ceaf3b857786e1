"""Running streams: staged file sources, run-to-end triggers and replay-safe sinks.

Every query has its own checkpoint folder under the shared root. Sinks write through
``foreachBatch`` into ``<path>/batch=<id>`` with overwrite, so a batch replayed after a failure
replaces its own output instead of duplicating it.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path


def key_slices(df: DataFrame, n: int, key: str) -> list[DataFrame]:
    """``df`` cut into ``n`` ranges of equal width of a numeric key, in key order (rows of
    null key come first); one slice if no row has a key. A range is a plain comparison of the key with bounds
    of its type, which a scan uses to pass over the parts of a table that have none of its keys."""
    lo, hi = df.agg(F.min(key), F.max(key)).first()
    if lo is None or n == 1:
        return [df]
    ends = [lo + (hi - lo) / n * (i + 1) for i in range(n - 1)]
    if isinstance(lo, int):
        ends = [min(math.floor(e), hi) for e in ends]        # the same whole numbers lie above
    k, typ = F.col(key), df.schema[key].dataType
    upto = [k <= F.lit(e).cast(typ) for e in ends]
    above = [k > F.lit(e).cast(typ) for e in ends]
    return [df.where(upto[0] | k.isNull()), *(df.where(a & u) for a, u in zip(above, upto[1:])), df.where(above[-1])]


def stage_files(df: DataFrame, path: str, n_files: int, order: list[str], fmt: str = "parquet",
                rows: Callable[[DataFrame], DataFrame] | None = None, compression: str | None = None,
                file_rows: int = 0) -> str:
    """Write ``df`` as ``n_files`` key-range slices, one append per slice in key order, so a
    file stream reads them back as ordered micro-batches (oldest file first). ``rows`` makes the written rows of
    a slice; the key's range is taken before it, so finding it does not run it. A file holds at most ``file_rows``
    rows (0: any number): a compressed text file is read by one task, however large."""
    for part in key_slices(df, n_files, order[0]):
        w = (rows(part) if rows else part).write.mode("append").option("maxRecordsPerFile", file_rows)
        getattr(w.option("compression", compression) if compression else w, fmt)(path)
    return path


def stream_in_batches(spark: SparkSession, path: str, schema: str, n: int, fmt: str = "parquet") -> DataFrame:
    """File stream that reads what lies in ``path`` now in at most ``n`` micro-batches, oldest files first. A large
    table is staged as many files; a micro-batch for each would update nearly every key of the state that often,
    so that work would grow with files times keys."""
    files = len(getattr(spark.read.schema(schema), fmt)(path).inputFiles())
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max(1, -(-files // n)))
    return getattr(reader, fmt)(path)


@contextmanager
def batches_without_data(spark: SparkSession, on: bool):
    """Whether streams started inside run micro-batches just to move their watermark: each opens and commits every
    state store. The watermark is in the checkpoint, so the next micro-batch with rows does the same."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, str(on and before == "true").lower())
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_slices(df: DataFrame, path: str, n: int, key: str, transform: Callable[[DataFrame], DataFrame],
               sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str, marker: DataFrame | None = None) -> None:
    """Feed a stream one key slice at a time, each a micro-batch of its own whatever its number of
    files: the query is run to the end of what is there, stopped, and resumed for the next slice.
    ``marker`` (rows far in the future, keys not null) comes last and closes the windows before it. What a slice
    closes leaves the state with the next slice, so only the last one is followed by a micro-batch without data."""
    spark = df.sparkSession
    parts = [*key_slices(df, n, key), *([] if marker is None else [marker])]
    for i, part in enumerate(parts, 1):
        part.write.mode("append").parquet(path)
        with batches_without_data(spark, i == len(parts)):
            run_available(transform(spark.readStream.schema(df.schema).parquet(path)), sink, checkpoint, mode)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_disk_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB (local disk, changelog checkpoints) rather than in
    executor memory, unless the session already names a provider other than the default.
    Running totals keep one entry per key ever seen, which outgrows memory at scale."""
    cur = spark.conf.get(_STATE_PROVIDER, None) or ""
    if cur in ("", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"):
        spark.conf.set(_STATE_PROVIDER, ROCKSDB)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        # no count of held keys in the progress: it costs a lookup before every write
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
        # a join keeps its four tables in one store a partition, rather than in one store each
        spark.conf.set("spark.sql.streaming.join.stateFormatVersion", "3")


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append", name: str | None = None):
    """Process everything available now in micro-batches, then stop (``availableNow``)."""
    use_disk_state(stream.sparkSession)
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    if name:
        w = w.queryName(name)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def start_stream(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                 mode: str = "append", every: str = "5 seconds", name: str | None = None):
    """Start a long-running query with a fixed batch interval (``every``, e.g. "0.5 seconds",
    "60 seconds"); returns the running query. State and progress live in ``checkpoint``."""
    use_disk_state(stream.sparkSession)
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    if name:
        w = w.queryName(name)
    return w.trigger(processingTime=every).start()


def console_sink(rows: int = 20) -> Callable[[DataFrame, int], None]:
    """Print the first ``rows`` rows of each batch (bounded; never collects a whole batch)."""
    def sink(df: DataFrame, batch_id: int) -> None:
        print(f"-- batch {batch_id}")
        df.show(rows, truncate=False)
    return sink


def set_state_snapshot_every(spark: SparkSession, batches: int) -> None:
    """Write a full state-store snapshot every ``batches`` deltas (the reference checkpoints its
    state every 8 batches); set before the query first starts."""
    spark.conf.set("spark.sql.streaming.stateStore.minDeltasForSnapshot", str(batches))


def batch_dirs_sink(path: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                    fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: ``transform(batch)`` written to ``path/batch=<id>`` (idempotent)."""
    def sink(df: DataFrame, batch_id: int) -> None:
        out = transform(df) if transform else df
        getattr(out.write.mode("overwrite"), fmt)(f"{path}/batch={batch_id}")
    return sink


def read_batches(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """All batch outputs with their ``batch`` number (the partition column)."""
    return getattr(spark.read.schema(f"{schema}, batch long"), fmt)(path)


def newest_per_key(df: DataFrame, keys: list[str], version: str = "batch") -> DataFrame:
    """Current value per key from versioned rows (highest version wins), for outputs of queries whose
    state has no table form; ``state_table`` needs no history."""
    vals = [c for c in df.columns if c not in keys and c != version]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*vals), version).alias("_q_v"))
              .select(*keys, "_q_v.*"))


def noop_sink(df: DataFrame, batch_id: int) -> None:
    """Run the batch and write nothing: what counts is the state."""
    df.write.format("noop").mode("overwrite").save()


def state_table(spark: SparkSession, checkpoint: str, value: str, batch: int | None = None) -> DataFrame:
    """The current state of a streaming aggregate as a table: its keys, and its buffers named and typed by
    ``value`` (a field list, by position). One row per key, whatever the number of batches before;
    ``batch`` asks for the state after that batch."""
    r = spark.read.format("statestore")
    if batch is not None:
        r = r.option("batchId", batch)
    return r.load(checkpoint).select("key.*", F.col("value").cast(f"struct<{value}>").alias("_q_v")).select("*", "_q_v.*").drop("_q_v")


#: buffers of a sum over decimals and of one over doubles (``sum_parts``); the flag says that no value came
def sum_buffers(scale: int = 10) -> str:
    return f"exact decimal(38,{scale}), none boolean, rest double"


def summed() -> Column:
    """The sum behind ``sum_buffers``, as double (null if no value came)."""
    return F.when(~F.col("none"), F.col("exact").cast("double") + F.col("rest"))


def checkpoint_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"ckpt-{name}")


def to_instant(col: str):
    """Event time for watermarks: a ``timestamp_ntz`` wall-clock value read as UTC."""
    return F.to_utc_timestamp(F.col(col).cast("timestamp"), F.current_timezone())


def from_instant(col):
    """Back to ``timestamp_ntz`` (UTC wall clock)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_utc_timestamp(c, F.current_timezone()).cast("timestamp_ntz")
