"""Substring dedup by Rabin-Karp window hashes (operator 10).

Every window of ``WINDOW`` consecutive words gets a 64-bit rolling hash. Documents are dealt into
cells of a few megabytes of text by a hash of their id. A cell reports each distinct window once,
with the smallest id that holds it, to the bucket of the window's hash; a bucket finds the smallest
id over all cells and answers only the cells that hold a later one. So a window that a third of all
documents share costs one entry per cell, and no window ever meets its occurrences in one place.
Back in its cell, a document's repeated windows merge into maximal removal intervals.

Reports travel as sorted hashes, delta-coded into byte columns: about 8 bytes a window.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (NON_BLANK, cover, find_words, hash_words, inside, per_text, rolling,
                               slices, text_buffer)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
CELL_CHARS = 8_000_000        # characters of text in a cell, on average
BUCKET_CHARS = 16_000_000     # characters whose windows report to one bucket, on average
SIGN = np.uint64(1 << 63)        # signed order as unsigned order
NO_ID = np.iinfo(np.int64).max   # a null id comes after every id


def pack(x: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit numbers as byte columns of their differences, high zero columns left out."""
    d = np.diff(x, prepend=np.uint64(0))
    width = max(1, -(-int(d.max()).bit_length() // 8)) if len(d) else 1
    planes = d.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(planes.T).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    """Inverse of ``pack``."""
    width, n = blob[0], (len(blob) - 1) // blob[0]
    d = np.zeros((n, 8), dtype=np.uint8)
    d[:, :width] = np.frombuffer(blob, dtype=np.uint8, offset=1).reshape(width, n).T
    return np.cumsum(d.view("<u8").ravel(), dtype=np.uint64)


def windows_of(texts: pa.Array, size: int):
    """Window hashes of a batch of texts and the first window of each text (``len + 1`` offsets)."""
    parts, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo, hi in slices(texts):
        buf, off = text_buffer(texts[lo:hi])
        start, end, first = find_words(buf, off, NON_BLANK)
        h = rolling(hash_words(buf, start, end), size)
        parts.append(h[inside(first, size, len(start))])
        counts.append(np.maximum(np.diff(first) - size + 1, 0))
    return np.concatenate(parts), np.concatenate(([0], np.cumsum(np.concatenate(counts))))


def _smallest(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, and the smallest id of each."""
    order = np.lexsort((ids, hashes))
    h, i = hashes[order], ids[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    return h[new], i[new]


def _cell_windows(cell: pa.Table, size: int):
    ids = cell["doc_id"].combine_chunks().fill_null(NO_ID).to_numpy()
    h, first = windows_of(cell["text"].combine_chunks(), size)
    return h, np.repeat(ids, np.diff(first)), first


REPORT = "cell long, bucket int, hashes binary, owners binary"


def _report(cell: pa.Table, size: int, buckets: int) -> pa.Table:
    """A cell's distinct windows by bucket: hashes and, as numbers into a list, the smallest ids."""
    h, ids, _ = _cell_windows(cell, size)
    h, ids = _smallest(h, ids)
    bucket = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)   # rises with h
    edge = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = []
    for b in range(buckets):
        lo, hi = edge[b], edge[b + 1]
        if hi > lo:
            known, at = np.unique(ids[lo:hi], return_inverse=True)
            kind = np.uint16 if len(known) <= 1 << 16 else np.uint32
            names = pack(known.view(np.uint64) ^ SIGN)
            rows.append((b, pack(h[lo:hi]), len(names).to_bytes(4, "little") + names + at.astype(kind).tobytes()))
    n = len(rows)
    return pa.table({"cell": pa.array([cell["cell"][0].as_py()] * n, pa.int64()),
                     "bucket": pa.array([r[0] for r in rows], pa.int32()),
                     "hashes": pa.array([r[1] for r in rows], pa.binary()),
                     "owners": pa.array([r[2] for r in rows], pa.binary())})


def _answer(bucket: pa.Table) -> pa.Table:
    """For each cell the bucket's windows that a smaller id in another cell holds."""
    cells = bucket["cell"].to_pylist()
    hashes, owners = [], []
    for blob, own in zip(bucket["hashes"].to_pylist(), bucket["owners"].to_pylist()):
        h = unpack(blob)
        stop = 4 + int.from_bytes(own[:4], "little")
        known = (unpack(own[4:stop]) ^ SIGN).view(np.int64)
        at = np.frombuffer(own, np.uint16 if len(known) <= 1 << 16 else np.uint32, offset=stop)
        hashes.append(h)
        owners.append(known[at])
    # windows of one cell only are done with
    every = np.sort(np.concatenate(hashes))
    twice = every[1:][every[1:] == every[:-1]]
    twice = twice[np.concatenate(([True], twice[1:] != twice[:-1]))] if len(twice) else twice
    first = np.full(len(twice), NO_ID)
    at_of, hit_of = [], []
    for h, own in zip(hashes, owners):
        at = np.searchsorted(twice, h)
        at[at == len(twice)] = 0
        hit = np.flatnonzero(twice[at] == h) if len(twice) else np.zeros(0, np.int64)
        np.minimum.at(first, at[hit], own[hit])
        at_of.append(at)
        hit_of.append(hit)
    rows = []
    for c, h, own, at, hit in zip(cells, hashes, owners, at_of, hit_of):
        later = hit[own[hit] > first[at[hit]]]
        if len(later):
            rows.append((c, pack(h[later])))
    return pa.table({"cell": pa.array([r[0] for r in rows], pa.int64()),
                     "repeated": pa.array([r[1] for r in rows], pa.binary())})


RESULT = "doc_id long, n_words long, n_removed long, removed array<int>, kept string"


def _remove(cell: pa.Table, answers: pa.Table, size: int) -> pa.Table:
    """Result rows of one cell: removal intervals and the words kept."""
    if not len(cell):
        return pa.table({n: pa.array([], t) for n, t in (
            ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
            ("removed", pa.list_(pa.int32())), ("kept", pa.string()))})
    h, ids, first = _cell_windows(cell, size)
    own, smallest = _smallest(h, ids)
    later = ids > smallest[np.searchsorted(own, h)]
    if len(answers):
        known = np.sort(np.concatenate([unpack(b) for b in answers["repeated"].to_pylist()]))
        at = np.searchsorted(known, h)
        at[at == len(known)] = 0
        later |= known[at] == h
    texts = cell["text"].combine_chunks()
    n_words, n_removed, removed, kept = [], [], [], []
    for lo, hi in slices(texts):
        buf, off = text_buffer(texts[lo:hi])
        start, end, wfirst = find_words(buf, off, NON_BLANK)
        total = len(start)
        ok = np.flatnonzero(inside(wfirst, size, total))
        mark = np.zeros(max(0, total - size + 1), dtype=bool)
        mark[ok] = later[first[lo]:first[hi]]
        gone = cover(mark, size, total) if total >= size else np.zeros(total, dtype=bool)
        n_words += np.diff(wfirst).tolist()
        n_removed += per_text(gone, wfirst).tolist()
        raw = buf.tobytes()
        for d in range(hi - lo):
            a, b = int(wfirst[d]), int(wfirst[d + 1])
            edge = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0, append=0))
            removed.append(edge.tolist())
            words = raw[off[d]:off[d + 1]].split()
            cuts = [0, *edge.tolist(), b - a]
            kept.append(b" ".join(w for s, e in zip(cuts[::2], cuts[1::2]) for w in words[s:e]).decode())
    return pa.table({"doc_id": cell["doc_id"].combine_chunks(), "n_words": pa.array(n_words, pa.int64()),
                     "n_removed": pa.array(n_removed, pa.int64()), "removed": pa.array(removed, pa.list_(pa.int32())),
                     "kept": pa.array(kept, pa.string())})


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                   cell_chars: int = CELL_CHARS, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """``(doc_id, n_words, n_removed, removed, kept)`` for every row of ``docs``.

    A word goes when a window of ``window`` words around it also starts in a document with a smaller
    id; ``removed`` lists the word intervals ``[start, end, ...]`` and ``kept`` joins the other words
    by one blank. Rows with one id never remove from each other, nor do rows with a null id, which
    come after every id. Null, empty and blank texts have no words and keep the empty text.
    """
    base = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    chars = base.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    cells, buckets = (max(1, -(-int(chars) // most)) for most in (cell_chars, bucket_chars))
    dealt = base.withColumn("cell", F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))),
                                           F.lit(cells)))

    def report(cell: pa.Table) -> pa.Table:
        return _report(cell, window, buckets)

    def answer(bucket: pa.Table) -> pa.Table:
        return _answer(bucket)

    def remove(cell: pa.Table, answers: pa.Table) -> pa.Table:
        return _remove(cell, answers, window)

    reports = dealt.groupBy("cell").applyInArrow(report, REPORT)
    answers = reports.groupBy("bucket").applyInArrow(answer, "cell long, repeated binary")
    return dealt.groupBy("cell").cogroup(answers.groupBy("cell")).applyInArrow(remove, RESULT)
