"""Helpers shared by the operators: word scans over Arrow text buffers, hashes, written tables.

Texts are handled as the UTF-8 bytes of an Arrow batch. All the word classes in use are
ASCII-defined (every byte of a non-ASCII character falls on one side), so byte classes decide
them exactly. Batches are cut into slices of a few megabytes, which bounds the numpy
temporaries; one longer text makes a slice of its own.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from quarry.session import scratch_path

# functions of this module travel to the workers by value: executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 1 << 20
PIECE_BYTES = 1 << 19


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table over the 256 byte values, true inside the inclusive ranges."""
    t = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        t[lo:hi + 1] = True
    return t


BLANK = byte_class((0x20, 0x20), (0x09, 0x0D))
#: words of ``[^\x20\x09-\x0D]+``
NON_BLANK = ~BLANK
#: words of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
LOWER_ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: byte map that lower-cases A-Z only
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        base = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)
        return mix64(base) | np.uint64(1)


BYTE_VALUES = seeds(256, 7)
RADIX = 0x2545F4914F6CDD1D          # odd, so it has an inverse modulo 2^64
_POWERS: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``RADIX`` and of its inverse modulo 2^64, at least ``n`` of each."""
    have = _POWERS.get("p")
    if have is None or len(have[0]) < n:
        size = max(n, PIECE_BYTES)
        inv = pow(RADIX, -1, 1 << 64)
        out = []
        for r in (RADIX, inv):
            p = np.empty(size, dtype=np.uint64)
            p[0] = 1
            filled, step = 1, r
            while filled < size:                       # doubling: p[k + filled] = p[k] * r^filled
                take = min(filled, size - filled)
                p[filled:filled + take] = p[:take] * np.uint64(step)
                filled += take
                step = step * step % (1 << 64)
            out.append(p)
        have = _POWERS["p"] = (out[0], out[1])
    return have


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end and the ``len(arr) + 1`` byte offsets (null: empty)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    arr = arr.cast(pa.large_string())
    _, ofs, data = arr.buffers()
    off = np.frombuffer(ofs, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def slices(arr: pa.Array, max_bytes: int = SLICE_BYTES):
    """Cut a batch of texts into consecutive ``(lo, hi)`` row ranges of at most ``max_bytes``
    (or one longer text)."""
    if len(arr) == 0:
        return
    _, off = text_buffer(arr)
    lo = 0
    while lo < len(arr):
        hi = int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), len(arr))
        yield lo, hi
        lo = hi


def find_words(buf: np.ndarray, off: np.ndarray, word: np.ndarray):
    """Maximal runs of word bytes that stay inside one text: byte ``start``, byte ``end`` and
    ``first``, the index of each text's first word (``len(off)`` entries)."""
    w = word[buf]
    edge = off[1:-1]
    s, e = w.copy(), w.copy()
    if len(w):
        s[1:] &= ~w[:-1]
        e[:-1] &= ~w[1:]
        at = edge[(edge > 0) & (edge < len(w))]
        s[at] = w[at]
        e[at - 1] = w[at - 1]
    start = np.flatnonzero(s)
    end = np.flatnonzero(e) + 1
    return start, end, np.searchsorted(start, off)


def hash_words(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each byte run, from prefix sums over pieces of bounded size."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = max(int(np.searchsorted(end, start[i] + PIECE_BYTES, side="right")), i + 1)
        lo, hi = int(start[i]), int(end[j - 1])
        pw, inv = _powers(hi - lo)
        c = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[buf[lo:hi]] * pw[:hi - lo], out=c[1:])
        s = start[i:j] - lo
        out[i:j] = (c[end[i:j] - lo] - c[s]) * inv[s]
        i = j
    return mix64(out)


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hash of every ``n`` consecutive entries of ``h`` (``len(h) - n + 1`` values)."""
    m = max(0, len(h) - n + 1)
    out = np.zeros(m, dtype=np.uint64)
    for j in range(n if m else 0):
        out *= np.uint64(RADIX)
        out += h[j:j + m]
    return mix64(out)


def inside(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of the ``total - n + 1`` windows of ``n`` words lie in one text."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    m = max(0, total - n + 1)
    return doc[:m] == doc[n - 1:n - 1 + m]


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(any, later)``: keys that occur at least twice, and those equal to an earlier one.

    A table of counts per hash slot discards most single keys; only the rest are sorted.
    """
    n = len(keys)
    again, later = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    if n < 2:
        return again, later
    bits = max(6, int(n).bit_length() + 1)
    slot = (mix64(keys) >> np.uint64(64 - bits)).astype(np.int64)
    cand = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)
    order = cand[np.argsort(keys[cand], kind="stable")]
    k = keys[order]
    eq = k[1:] == k[:-1]
    later[order[1:][eq]] = True
    again[order[1:][eq]] = True
    again[order[:-1][eq]] = True
    return again, later


def cover(mark: np.ndarray, n: int, total: int) -> np.ndarray:
    """Words covered by the marked windows of ``n`` words."""
    d = np.zeros(total + 1, dtype=np.int32)
    at = np.flatnonzero(mark)
    d[at] += 1                       # window starts are distinct; ends are too
    d[at + n] -= 1
    return np.cumsum(d[:-1]) > 0


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive entries of ``first`` (0 for empty ranges)."""
    c = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=c[1:])
    return c[first[1:]] - c[first[:-1]]


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared scratch folder and read it back: cuts the
    lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
