"""Direct stream over a log table: a Python data source that starts at the earliest, the latest or given
offsets of every partition and carries on from its checkpoint.

``log_stream`` is the entry. A position is the next offset per ``topic/partition``. Where the log ends
is read from the small table of its last append, and each Spark task reads one file's share of the
records in a batch.
"""

from __future__ import annotations

import json
import sys
import urllib.parse
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "quarry_log"
SCHEMA = "topic string, partition int, offset long, key string, value binary, timestamp timestamp_ntz"


@dataclass
class Share(InputPartition):
    """Records ``lo`` to ``hi`` (exclusive) of a partition, all in one file."""
    topic: str
    partition: int
    file: str
    lo: int
    hi: int


def file_system(uri: str):
    """File system and path of a URI (or a plain local path)."""
    from pyarrow import fs
    parts = urllib.parse.urlparse(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), urllib.parse.unquote(parts.path)
    return fs.FileSystem.from_uri(uri)


class LogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.starting = options.get("startingoffsets", "earliest")

    def _names(self) -> list[str]:
        from pyarrow import fs
        store, path = file_system(f"{self.path}/_offsets")
        return sorted(f.base_name for f in store.get_file_info(fs.FileSelector(path)) if f.type == fs.FileType.Directory)

    def _offsets(self, name: str) -> list[dict]:
        import pyarrow.dataset as ds
        store, path = file_system(f"{self.path}/_offsets/{name}")
        return ds.dataset(path, filesystem=store, format="parquet").to_table().to_pylist()

    def _bounds(self, column: str, best) -> dict[str, int]:
        out: dict[str, int] = {}
        for r in self._offsets(self._names()[-1]):
            at = f"{r['topic']}/{r['partition']}"
            out[at] = best(out.get(at, r[column]), r[column])
        return out

    def initialOffset(self) -> dict:
        if self.starting == "latest":
            return self.latestOffset()
        first = self._bounds("earliest", min)
        return first if self.starting == "earliest" else first | json.loads(self.starting)

    def latestOffset(self, *_) -> dict:
        return self._bounds("next", max)

    def partitions(self, start: dict, end: dict) -> list[Share]:
        """Shares of the files with records between two positions. Appends are looked at from the newest
        until every partition's start is reached, so old ones are not opened."""
        new = [at for at in end if at not in start]
        first = self._bounds("earliest", min) if new else {}
        want = {at: (start.get(at, first.get(at, 0)), hi) for at, hi in end.items()}
        open_ = {at for at, (lo, hi) in want.items() if lo < hi}
        shares = []
        for name in reversed(self._names()):
            if not open_:
                break
            reached = set()
            for r in self._offsets(name):
                at = f"{r['topic']}/{r['partition']}"
                if r["file"] is None or at not in open_:
                    continue
                lo, hi = max(r["first"], want[at][0]), min(r["next"], want[at][1])
                if lo < hi:
                    shares.append(Share(r["topic"], r["partition"], r["file"], lo, hi))
                if r["first"] <= want[at][0]:
                    reached.add(at)
            open_ -= reached
        return shares

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds
        store, path = file_system(share.file)
        offset = ds.field("offset")
        rows = ds.dataset(path, filesystem=store, format="parquet", partitioning=None).scanner(
            columns=["offset", "key", "value", "timestamp"], filter=(offset >= share.lo) & (offset < share.hi), batch_size=8192)
        for b in rows.to_batches():
            n = b.num_rows
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([share.topic] * n), pa.array([share.partition] * n, pa.int32()), b["offset"], b["key"], b["value"],
                     b["timestamp"]], ["topic", "partition", "offset", "key", "value", "timestamp"])

    def commit(self, end: dict) -> None:
        """Positions live in the checkpoint; a user's own commit table is written by the sink."""


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options)


def log_stream(spark: SparkSession, path: str, starting: str | dict = "earliest") -> DataFrame:
    """The log at ``path`` as a stream from ``starting``: ``earliest``, ``latest`` or the next offset per
    ``topic/partition`` (others, and partitions that come later, from their earliest). It holds for the
    first start only; a query with a checkpoint carries on where it was."""
    spark.dataSource.register(LogSource)
    at = starting if isinstance(starting, str) else json.dumps(starting)
    return spark.readStream.format(FORMAT).option("startingOffsets", at).load(path)


def starting_offsets(starts: DataFrame) -> dict[str, int]:
    """``clamp``'s start table (one row per partition of the log) as positions for ``log_stream``."""
    return {f"{r.topic}/{r.partition}": r.start for r in starts.select("topic", "partition", "start").collect()}
