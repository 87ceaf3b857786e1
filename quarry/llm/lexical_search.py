"""Ranked lexical search with hashed max-sketches (operator 12).

The index holds one row per document, whatever the queries: its term counts by 64-bit term hash and a
sketch, whose coordinates are hash ranges and hold the largest count of any term that falls there. A
term's weighted count grows with its count, so sketch lookups of a query's terms add up to an upper
bound of the document's score. A document's sketch has 8 to 16 coordinates per distinct term, so the
bounds of long documents are as tight as those of short ones.

A search takes a block of queries at a time: every index partition looks all the block's terms up in
all its sketches, then rescores documents exactly in descending order of bound until no bound reaches
the k-th best score so far. The k best of every partition are merged.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.llm.common import LOWER, LOWER_ALNUM, find_words, hash_words, saved, slices, text_buffer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOAD_BITS = 3                # at least 2^3 sketch coordinates per distinct term
TOP_COUNT = 255              # larger counts share this code, which stands for any count
GROUP = 256                  # documents whose bounds are held at once, fewer for blocks of
CELLS = 1 << 21              # more query words than this over GROUP
CHUNK = 16                   # documents rescored before the threshold is looked at again
BLOCK_ITEMS, BLOCK_TERMS = 1024, 1 << 17     # queries and query words of a block
SPREAD = 64                  # merge tasks per query before the last one

INDEX = [("n", pa.int64()), ("bits", pa.int32()), ("sketch", pa.binary()), ("terms", pa.binary()), ("counts", pa.binary())]


def term_hashes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of the texts end to end, and each text's first (one entry more than texts)."""
    buf, off = text_buffer(arr)
    low = LOWER[buf]
    start, end, first = find_words(low, off, LOWER_ALNUM)
    with np.errstate(over="ignore"):
        return hash_words(low, start, end), first


def binary(data: np.ndarray, offset: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offset) - 1, [None, pa.py_buffer(offset.astype(np.int32)),
                                                               pa.py_buffer(np.ascontiguousarray(data))])


def index_rows(arr: pa.Array) -> list[pa.Array]:
    """Columns of ``INDEX`` for a slice of texts."""
    h, first = term_hashes(arr)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    head = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))) if len(h) else np.zeros(0, int)
    term, owner = h[head], doc[head]
    count = np.diff(np.append(head, len(h)))
    distinct = np.bincount(owner, minlength=len(n))
    bits = np.where(distinct, np.ceil(np.log2(np.maximum(distinct, 1))).astype(np.int64) + LOAD_BITS, 0)
    width = np.where(distinct, 1 << bits, 0)
    base = np.concatenate(([0], np.cumsum(width)))
    sketch = np.zeros(base[-1], np.uint8)
    if len(term):
        at = base[owner] + (term >> (64 - bits[owner]).astype(np.uint64)).astype(np.int64)
        cell = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))      # terms of a cell are neighbours
        sketch[at[cell]] = np.maximum.reduceat(np.minimum(count, TOP_COUNT), cell)
    ends = np.concatenate(([0], np.cumsum(distinct)))
    return [pa.array(n, pa.int64()), pa.array(bits, pa.int32()), binary(sketch, base), binary(term, ends * 8),
            binary(count.astype("<u4"), ends * 4)]


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, number of terms, sketch and term counts. A null, empty or
    term-less text has no terms and is never found; repeated rows are documents of their own. Other
    columns are not read. Write the result (``saved``) when it is searched more than once."""
    picked = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kinds = {"n": T.LongType(), "bits": T.IntegerType()}
    schema = T.StructType([picked.schema["doc_id"], *(T.StructField(c, kinds.get(c, T.BinaryType())) for c, _ in INDEX)])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], *index_rows(batch.column(1)[lo:hi])],
                                                 [f.name for f in schema])

    return picked.mapInArrow(rows, schema)


class Block:
    """A block of queries: their distinct terms, and each query's terms as positions among these."""

    def __init__(self, items: list[tuple]):
        texts = pa.array([t for _, t in items], pa.string())
        h, first = term_hashes(texts)
        self.terms = np.unique(h)
        self.ids, self.queries = [], []
        for i, (name, _) in enumerate(items):
            own = np.searchsorted(self.terms, np.unique(h[first[i]:first[i + 1]]))
            if len(own):
                self.ids.append(name)
                self.queries.append(own)

    def weigh(self, found: dict[int, int], n_docs: int, n_terms: int) -> None:
        """Weights from how many documents hold each term; terms of weight 0 add nothing."""
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = np.zeros(len(self.terms), np.int64)
        for t, df in found.items():
            self.weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        self.queries = [q[self.weight[q] > 0] for q in self.queries]
        self.asked = [i for i, q in enumerate(self.queries) if len(q)]
        flat = np.concatenate([self.queries[i] for i in self.asked]) if self.asked else np.zeros(0, np.int64)
        self.flat_terms, self.flat = np.unique(flat, return_inverse=True)
        self.first = np.cumsum([0, *(len(self.queries[i]) for i in self.asked)])[:-1]


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def views(col: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Values of a binary column end to end and the position of each row's first."""
    if col.offset:
        col = pa.concat_arrays([col])
    _, ofs, data = col.buffers()
    size = np.dtype(dtype).itemsize
    off = np.frombuffer(ofs, np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and len(off) else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), dtype), (off - off[0]) // size


class Searcher:
    """The ``k`` best documents of one index partition for every query of a block."""

    def __init__(self, block: Block, k: int):
        self.b, self.k = block, k
        self.best: list[list[tuple]] = [[] for _ in block.asked]      # (-score, id is null, id), ascending
        self.least = np.ones(len(block.asked), np.int64)              # scores below cannot enter
        self.rescored = 0

    def add(self, ids: list, n: np.ndarray, bits: np.ndarray, sketch: pa.Array, terms: pa.Array, counts: pa.Array) -> None:
        b = self.b
        m = np.array([10 + 90 * int(x) * b.n_docs // b.n_terms for x in n], np.int64)
        cells, base = views(sketch, np.uint8)
        h = b.terms[b.flat_terms]
        at = base[:-1, None] + (h[None, :] >> (64 - bits).astype(np.uint64)[:, None]).astype(np.int64)
        code = cells[at]
        impact = np.zeros(code.shape, np.int64)
        d, t = np.nonzero(code)
        tf = code[d, t].astype(np.int64)
        impact[d, t] = np.where(tf == TOP_COUNT, 1_000_000, part(tf, m[d])) * b.weight[b.flat_terms][t]
        bound = np.add.reduceat(impact[:, b.flat], b.first, axis=1)
        own, start = views(terms, np.uint64)
        tfs, _ = views(counts, np.uint32)
        for q in np.flatnonzero((bound >= self.least).any(axis=0)).tolist():
            col = bound[:, q]
            cand = np.flatnonzero(col >= self.least[q])
            self.rescore(q, cand[np.argsort(-col[cand], kind="stable")], col, ids, m, own, tfs, start)

    def rescore(self, q: int, cand: np.ndarray, bound: np.ndarray, ids: list, m: np.ndarray, own: np.ndarray,
                tfs: np.ndarray, start: np.ndarray) -> None:
        b, best = self.b, self.best[q]
        mine = b.queries[b.asked[q]]
        h, w = b.terms[mine], b.weight[mine]
        for lo in range(0, len(cand), CHUNK):
            if bound[cand[lo]] < self.least[q]:
                return
            last = best[-1] if len(best) == self.k else None
            for d in cand[lo:lo + CHUNK].tolist():
                if last and (-int(bound[d]), ids[d] is None, ids[d] if ids[d] is not None else 0) >= last:
                    continue                               # even its bound would not enter
                self.rescored += 1
                terms = own[start[d]:start[d + 1]]
                at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
                tf = np.where(terms[at] == h, tfs[start[d]:start[d + 1]][at], 0).astype(np.int64)
                score = int((w * part(tf, m[d])).sum())
                if score:
                    best.append((-score, ids[d] is None, ids[d] if ids[d] is not None else 0))
            best.sort()
            del best[self.k:]
            if len(best) == self.k:
                self.least[q] = -best[-1][0]


def blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Block]:
    """The queries in blocks of bounded size (a longer text makes a block of its own)."""
    held, words = [], 0
    for name, t in items.select(F.col(f"`{item_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))).toLocalIterator():
        size = len(t) // 2 + 1                             # no text has more terms
        if held and (len(held) == BLOCK_ITEMS or words + size > BLOCK_TERMS):
            yield Block(held)
            held, words = [], 0
        held.append((name, t))
        words += size
    if held:
        yield Block(held)


def document_frequency(index: DataFrame, block: Block) -> dict[int, int]:
    """How many documents hold each of the block's terms, by position; none for terms of no document."""
    terms = index.sparkSession.sparkContext.broadcast(block.terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            own, _ = views(batch.column(0), np.uint64)
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            total += np.bincount(at[known[at] == own], minlength=len(known))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["t", "df"])

    found = index.select("terms").mapInArrow(count, "t long, df long").groupBy("t").agg(F.sum("df").alias("df"))
    return {r.t: r.df for r in found.collect()}            # at most one row per query word of the block


def search_block(index: DataFrame, block: Block, item_type: T.DataType, k: int) -> DataFrame:
    """``item_no, item_id, doc_id, score`` of the ``k`` best documents of every index partition."""
    shared = index.sparkSession.sparkContext.broadcast(block)
    id_type, item_kind = index.schema["doc_id"].dataType, to_arrow_type(item_type)
    schema = T.StructType([T.StructField("item_no", T.IntegerType()), T.StructField("item_id", item_type),
                           T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = shared.value
        s, kinds = Searcher(b, k), None
        for batch in batches:
            kinds = batch.schema.field(0).type
            group = max(1, min(GROUP, CELLS // len(b.flat)))
            for lo in range(0, batch.num_rows, group):
                some = batch.slice(lo, group)
                ids, n, bits, sketch, terms, counts = some.columns
                s.add(ids.to_pylist(), np.asarray(n), np.asarray(bits), sketch, terms, counts)
        rows = [(b.asked[q], b.ids[b.asked[q]], None if null else d, -score)
                for q, best in enumerate(s.best) for score, null, d in best]
        if rows:
            no, item, doc, score = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(no, pa.int32()), pa.array(item, item_kind), pa.array(doc, kinds),
                                              pa.array(score, pa.int64())], [f.name for f in schema])

    return index.where("n > 0").select("doc_id", "n", "bits", "sketch", "terms", "counts").mapInArrow(run, schema)


def search(index: DataFrame, items: DataFrame, k: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above 0 for every row of
    ``items``, equal scores by ascending ``doc_id`` (nulls last).

    Items with a null or term-less text find nothing; rows that share an ``item_id`` are ranked each for
    itself, and so are documents that share an id. ``index`` is a written result of ``build_index``.
    """
    n_docs, n_terms = index.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    kind = items.schema[item_id].dataType
    found = None
    for block in blocks(items, item_id, text):
        block.weigh(document_frequency(index, block) if n_docs and len(block.terms) else {}, n_docs, n_terms)
        if not block.asked:
            continue
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        part_of = F.pmod(F.hash(F.spark_partition_id()), F.lit(SPREAD)).alias("part")
        rows = search_block(index, block, kind, k).select("*", part_of)
        near = Window.partitionBy("item_no", "part").orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item_no").orderBy(*order)))
        rows = saved(rows.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"), "found")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        schema = T.StructType([items.schema[item_id], T.StructField("rank", T.IntegerType()),
                               T.StructField("doc_id", index.schema["doc_id"].dataType), T.StructField("score", T.LongType())])
        found = index.sparkSession.createDataFrame([], schema).toDF("item_id", "rank", "doc_id", "score")
    return found
