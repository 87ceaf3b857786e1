"""Benchmark decontamination by Wu-Manber multi-pattern search over words (operator 4).

Patterns are the windows of ``WINDOW`` consecutive item words (a shorter item is one window). For
each pattern length there is a SHIFT table over blocks of two words, which says how far a search
position can jump ahead, suffix buckets that select the patterns ending at a zero-shift position,
and a direct comparison of all words that confirms an occurrence. The texts of a slice are cut
into overlapping stretches and one numpy cursor walks each stretch, all cursors in step.

Patterns come in blocks of bounded size, each collected and broadcast on its own; ``BLOCKS_AT_ONCE``
blocks make a narrow pass over the texts, whose result is written before the next pass. No stage
shuffles documents.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (LOWER, LOWER_ALNUM, find_words, free_name, hash_words, mix64, per_text, rolling,
                               saved, slices, text_buffer)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10
BLOCK_PATTERNS = 100_000      # patterns per broadcast block: at most some tens of megabytes
STRETCH = 256                 # words one cursor walks
SUFFIX = 4                    # words that pick a suffix bucket
BLOCKS_AT_ONCE = 2            # blocks that one Python worker holds
ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER_AZ, LOWER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def patterns(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct windows ``(words array, items array of id strings)``. Items with null id or no
    words give none."""
    words = F.expr(f"regexp_extract_all(translate(`{text}`, '{UPPER_AZ}', '{LOWER_AZ}'), r'{ITEM_WORDS}', 0)")
    w = items.where(F.col(f"`{item_id}`").isNotNull()).select(
        F.col(f"`{item_id}`").cast("string").alias("item"), words.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(window - 1), F.lit(1)))
    return (w.select("item", "w", F.explode(starts).alias("s"))
             .select("item", F.slice("w", F.col("s"), F.lit(window)).alias("words"))
             .groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items")))


def window_hash(ids: np.ndarray, start: np.ndarray, m: int) -> np.ndarray:
    """64-bit hash of the ``m`` word numbers from each start."""
    out = np.zeros(len(start), dtype=np.uint64)
    for q in range(m):
        out = mix64(out * np.uint64(0x2545F4914F6CDD1D) + ids[start + q].astype(np.uint64) + np.uint64(1))
    return out


def bisect_in(values: np.ndarray, x: np.ndarray, lo: np.ndarray, hi: np.ndarray, right: bool) -> np.ndarray:
    """Place of each ``x`` in its own sorted range ``values[lo:hi]``, before or after equal values."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        up = values[mid] <= x[open_] if right else values[mid] < x[open_]
        lo[open_[up]] = mid[up] + 1
        hi[open_[~up]] = mid[~up]


class Tables:
    """Search tables of all patterns of one length ``m`` in a block."""

    def __init__(self, pats: list[list[bytes]], owners: list[list[int]], ids: np.ndarray):
        self.m = ids.shape[1]
        self.b = min(2, self.m)
        self.s = min(SUFFIX, self.m)
        self.bits = max(8, int(ids.size).bit_length() + 2)
        self.shift = np.full(1 << self.bits, self.m - self.b + 1, dtype=np.int64)
        for q in range(self.b, self.m + 1):        # block ending at word q: shift m - q
            np.minimum.at(self.shift, self.slot(ids[:, q - self.b], ids[:, q - 1]), self.m - q)
        suffix = rolling(ids.reshape(-1).astype(np.uint64), self.s)[self.m - self.s::self.m]
        whole = window_hash(ids.reshape(-1), np.arange(len(ids)) * self.m, self.m)
        order = np.lexsort((whole, suffix))
        self.suffix, self.whole, self.ids = suffix[order], whole[order], ids[order]
        self.pats = [pats[i] for i in order]
        self.owners = [owners[i] for i in order]

    def slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Shift-table slot of the block ``(a, b)``; for one-word patterns the block is ``b``."""
        key = b.astype(np.uint64) if self.b == 1 else a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        return (mix64(key) >> np.uint64(64 - self.bits)).astype(np.int64)


class Block:
    """One bounded block of patterns: vocabulary, tables by length, owning items."""

    def __init__(self, rows: list[tuple[list[str], list[str]]]):
        self.items = sorted({i for _, own in rows for i in own})
        at = {x: k for k, x in enumerate(self.items)}
        pats = [[w.encode() for w in words] for words, _ in rows]
        vocab = sorted({w for p in pats for w in p})
        joined = np.frombuffer(b"".join(vocab), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in vocab])
        h = hash_words(joined, ends - [len(w) for w in vocab], ends) if vocab else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.vocab = h[order]
        number = {vocab[k]: i for i, k in enumerate(order)}
        self.tables = []
        for m in sorted({len(p) for p in pats}):
            of = [k for k, p in enumerate(pats) if len(p) == m]
            ids = np.array([[number[w] for w in pats[k]] for k in of], dtype=np.int64)
            self.tables.append(Tables([pats[k] for k in of], [[at[i] for i in rows[k][1]] for k in of], ids))

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Vocabulary number of each word hash; words outside get one number past the end."""
        n = len(self.vocab)
        if n == 0:
            return np.zeros(len(h), dtype=np.int64)
        at = np.searchsorted(self.vocab, h)
        at[at == n] = n - 1
        return np.where(self.vocab[at] == h, at, n)


def _walk(t: Tables, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Zero-shift positions: index of the last word of each place where a pattern may end."""
    doc_lo, doc_hi = first[:-1], first[1:]
    n_words = doc_hi - doc_lo
    some = np.flatnonzero(n_words >= t.m)
    parts = -(-(n_words[some] - t.m + 1) // STRETCH)
    doc = np.repeat(some, parts)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    cur = doc_lo[doc] + t.m - 1 + k * STRETCH
    stop = np.minimum(cur + STRETCH, doc_hi[doc])
    slot = t.slot(np.concatenate((ids[:1], ids[:-1])), ids)
    jump = t.shift[slot]
    out = []
    while len(cur):
        j = jump[cur]
        zero = j == 0
        out.append(cur[zero])
        cur = cur + np.where(zero, 1, j)
        live = cur < stop
        cur, stop = cur[live], stop[live]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def _occurrences(t: Tables, ids, first, buf, start, end) -> tuple[np.ndarray, np.ndarray]:
    """Confirmed ``(first word index, pattern index)`` pairs of one pattern length."""
    last = _walk(t, ids, first)
    if not len(last):
        return last, last
    suffix = rolling(ids.astype(np.uint64), t.s)[last - t.s + 1]
    lo = np.searchsorted(t.suffix, suffix, side="left")
    hi = np.searchsorted(t.suffix, suffix, side="right")
    some = np.flatnonzero(hi > lo)
    last, lo, hi = last[some], lo[some], hi[some]
    # of a bucket only the patterns with the hash of all the window's words are compared
    whole = window_hash(ids, last - t.m + 1, t.m)
    lo, hi = bisect_in(t.whole, whole, lo, hi, False), bisect_in(t.whole, whole, lo, hi, True)
    n = hi - lo
    where = np.repeat(last, n) - t.m + 1
    pat = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    for q in range(t.m):                              # direct comparison, word numbers first
        same = ids[where + q] == t.ids[pat, q]
        where, pat = where[same], pat[same]
    exact = np.fromiter((all(buf[start[w + q]:end[w + q]].tobytes() == word for q, word in enumerate(t.pats[p]))
                         for w, p in zip(where, pat)), dtype=bool, count=len(where))
    return where[exact], pat[exact]


def _search(arr: pa.Array, block: Block) -> list[tuple]:
    raw, off = text_buffer(arr)
    buf = LOWER[raw]
    start, end, first = find_words(buf, off, LOWER_ALNUM)
    ids = block.numbers(hash_words(buf, start, end))
    mark = np.zeros(len(start) + 1, dtype=np.int64)
    owned: list[set] = [set() for _ in range(len(off) - 1)]
    for t in block.tables:
        where, pat = _occurrences(t, ids, first, buf, start, end)
        np.add.at(mark, where, 1)
        np.add.at(mark, where + t.m, -1)
        for d, p in zip(np.searchsorted(first, where, side="right") - 1, pat):
            owned[d].update(t.owners[p])
    hit = np.cumsum(mark[:-1]) > 0
    n_hit = per_text(hit, first)
    edge = np.zeros(len(hit) + 1, dtype=bool)
    edge[first] = True                                # a run of hit words ends with its text
    s = np.flatnonzero(hit & (edge[:-1] | ~np.concatenate(([False], hit[:-1]))))
    e = np.flatnonzero(hit & (edge[1:] | ~np.concatenate((hit[1:], [False])))) + 1
    lo, hi = np.searchsorted(s, first[:-1]), np.searchsorted(s, first[1:])
    return [(int(first[d + 1] - first[d]), int(n_hit[d]),
             np.stack((s[lo[d]:hi[d]], e[lo[d]:hi[d]]), axis=1).ravel() - first[d] if n_hit[d] else [],
             sorted(block.items[i] for i in owned[d])) for d in range(len(off) - 1)]


FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("runs", pa.list_(pa.int32())),
                   ("items", pa.list_(pa.string()))])


def _find(block, text: Column) -> Column:
    """Per text: words, words hit by this block, their runs ``[start, end, ...]``, items hit."""

    @F.arrow_udf("struct<n_words:long,n_hit:long,runs:array<int>,items:array<string>>")
    def find(arr: pa.Array) -> pa.Array:
        rows = [r for lo, hi in slices(arr) for r in _search(arr[lo:hi], block.value)]
        return pa.array([dict(zip(FOUND.names, r)) for r in rows], FOUND)

    return find.asNondeterministic()(text)


def _union_length(runs: Column) -> Column:
    """Number of words in the union of the run lists of several blocks."""

    @F.arrow_udf("long")
    def length(runs: pa.Array) -> pa.Array:
        out = []
        for lists in runs.to_pylist():
            n = at = 0
            for s, e in sorted((x[i], x[i + 1]) for x in lists for i in range(0, len(x), 2)):
                n += max(0, e - max(s, at))
                at = max(at, e)
            out.append(n)
        return pa.array(out, pa.int64())

    return length.asNondeterministic()(runs)


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", out: str = "hits",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_patterns: int = BLOCK_PATTERNS) -> DataFrame:
    """Every row of ``docs`` (all columns kept) with a struct ``out``: ``n_words``, ``n_hit`` (words
    inside any occurrence), ``items`` (sorted ids of the items with occurring windows) and
    ``contaminated``. Null texts have no words; no items, null items and blank items hit nothing;
    repeated item ids count once. A column of ``docs`` named ``out`` is replaced.

    ``block_patterns`` bounds what is collected and broadcast at a time, never what is searched.
    """
    spark = docs.sparkSession
    pats = patterns(items, item_id, item_text, window)
    blocks = max(1, -(-pats.count() // block_patterns))
    if blocks > 1:
        pats = saved(pats.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks))), "patterns")
    cols: list[str] = []
    df = docs
    for k in range(blocks):
        part = pats if blocks == 1 else pats.where(F.col("block") == k)
        block = Block([(list(r["words"]), list(r["items"])) for r in part.select("words", "items").collect()])
        cols.append(free_name(df, f"hits{k}"))
        df = df.withColumn(cols[-1], _find(spark.sparkContext.broadcast(block), F.col(f"`{text}`")))
        if (k + 1) % BLOCKS_AT_ONCE == 0 and k + 1 < blocks:
            df = saved(df, "searched")                # a worker holds the blocks of one pass only
    if blocks == 1:
        n_hit, items_hit = F.col(f"{cols[0]}.n_hit"), F.col(f"{cols[0]}.items")
    else:
        n_hit = _union_length(F.array(*(F.col(f"{c}.runs") for c in cols)))
        items_hit = F.flatten(F.array(*(F.col(f"{c}.items") for c in cols)))
    res = F.struct(F.col(f"{cols[0]}.n_words").alias("n_words"), n_hit.alias("n_hit"),
                   F.array_sort(F.array_distinct(items_hit)).alias("items"))
    df = df.withColumn(out, res)
    h = F.col(f"`{out}`")
    return df.withColumn(out, h.withField("contaminated", h.n_hit > 0)).drop(*cols)
