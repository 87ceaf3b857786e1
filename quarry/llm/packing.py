"""Best-fit packing of token sequences by bin completion (operator 11).

Documents become token pieces of at most ``capacity`` ids; a packing depends on the pieces' lengths
only, so the plan is made on how many pieces there are of each length: at most ``capacity`` numbers,
whatever the input. The search is a branch and bound over bins: it takes the longest length left,
enumerates the undominated fillings of the room beside it, puts one filling into as many bins as the
counts allow, and backtracks. Branches that waste more room than the best plan so far can spare are
cut. Best-fit decreasing gives the first incumbent, and the search ends at the lower bound or after
``nodes`` fillings.

The plan is a table of runs, ``copies`` bins alike at a time. Spark numbers the pieces of each length
and every piece finds its run, so the pieces themselves meet in no task.
"""

from __future__ import annotations

import bisect
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import free_name, saved, slices
from quarry.llm.word_tokens import encoder, spread, vocabulary

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 2048
END = 0                     # id that closes every document
NODES = 6000                # fillings that a search may try
STEPS = 400                 # steps of one enumeration of fillings
WIDTH = 12                  # fillings kept of one enumeration
BLOCK_BITS = 18             # rows of one file that are numbered together

Runs = tuple[tuple[int, int], ...]        # (length, how many) of one bin, longest first
Plan = list[tuple[Runs, int]]             # bins alike and their number


def lower_bound(count: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: for every size k, pieces over ``capacity - k`` stand alone, those
    over half share no bin, and what they leave is all the room for the pieces of at least k."""
    size = np.arange(capacity + 1)
    n = np.concatenate((np.cumsum(count[::-1])[::-1], [0]))            # pieces of at least i
    s = np.concatenate((np.cumsum((count * size)[::-1])[::-1], [0]))   # their tokens
    half = capacity // 2 + 1
    k = np.arange(half)
    alone, over = n[capacity - k + 1], n[half]
    mid_n, mid_s = over - alone, s[half] - s[capacity - k + 1]
    small = s[k] - s[half]
    more = -(-(small - (mid_n * capacity - mid_s)) // capacity)
    return int((alone + mid_n + np.maximum(more, 0)).max())


def best_fit(count: np.ndarray, capacity: int) -> Plan:
    """Best-fit decreasing, on bins alike at a time: every piece goes to the fullest bin it fits."""
    room: dict[int, list[tuple[Runs, int]]] = {}
    for length in np.flatnonzero(count)[::-1].tolist():
        left = int(count[length])
        while left:
            fits = [r for r in room if r >= length]
            if fits:
                r = min(fits)
                runs, bins = room[r].pop()
                if not room[r]:
                    del room[r]
            else:
                r, runs, bins = capacity, (), left
            each = r // length
            full = min(bins, left // each)
            left -= full * each
            if full:
                room.setdefault(r - each * length, []).append(((*runs, (length, each)), full))
            if full < bins and left:                   # one more bin takes what is left
                room.setdefault(r - left * length, []).append(((*runs, (length, left)), 1))
                full, left = full + 1, 0
            if full < bins and runs:
                room.setdefault(r, []).append((runs, bins - full))
    return [x for bins in room.values() for x in bins]


def fillings(count: list[int], lengths: list[int], room: int, waste: int) -> list[Runs]:
    """Undominated sets of the lengths left (longest first in ``lengths``) that fill ``room`` but for at
    most ``waste``, fullest first: the ``WIDTH`` first of all, or of those that ``STEPS`` steps find.

    A set is dominated if a length outside it fits where one or two of its own stand (or in the gap)
    and fills more; a single length that fits the room exactly dominates every other set.
    """
    if room < len(count) and count[room]:
        return [((room, 1),)]
    usable = lengths[bisect.bisect_left(lengths, -room, key=lambda x: -x):]
    out: list[tuple[int, Runs]] = []
    for x in usable:                                   # pairs without a gap, which long searches would miss
        y = room - x
        if y > x or len(out) >= WIDTH:
            break
        if y and count[y] > (x == y):
            out.append((0, ((x, 2),) if x == y else ((x, 1), (y, 1))))
    steps = 0
    stack = [(0, room, (), -1)] if len(out) < WIDTH else []
    while stack and steps < STEPS:
        at, gap, runs, k = stack.pop()
        steps += 1
        if k < 0:                                      # on to the next length that fits
            at = bisect.bisect_left(usable, -gap, lo=at, key=lambda x: -x) if gap else len(usable)
            if at == len(usable):
                if gap <= waste and not dominated(dict(runs), gap, count):
                    out.append((gap, runs))
                continue
            k = min(count[usable[at]], gap // usable[at])
        x = usable[at]
        if k:
            stack.append((at, gap, runs, k - 1))       # fewer of x, after all sets with k of it
            stack.append((at + 1, gap - k * x, (*runs, (x, k)), -1))
        else:
            stack.append((at + 1, gap, runs, -1))
    ordered = sorted({(gap, tuple((-x, -k) for x, k in runs)) for gap, runs in out})
    return [tuple((-x, -k) for x, k in runs) for _, runs in ordered[:WIDTH]]


def dominated(used: dict[int, int], gap: int, count: list[int]) -> bool:
    """Whether a length outside the set can take the place of nothing, of one or of two of its lengths."""
    if not gap:
        return False
    own = list(used)
    sums = {0, *own} | {a + b for i, a in enumerate(own) for b in own[i:] if a != b or used[a] > 1}
    return any(count[x] > used.get(x, 0) for s in sums for x in range(s + 1, min(s + gap + 1, len(count))))


def complete_bins(count: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES) -> tuple[Plan, int]:
    """Fewest bins that the search finds for ``count[length]`` pieces, and the lower bound.

    Small inputs have few fillings and are searched to the end; ``nodes`` bounds the rest.
    """
    need = lower_bound(count, capacity)
    best = best_fit(count, capacity)
    fewest = sum(n for _, n in best)
    left = count.tolist()
    lengths = [x for x in range(capacity, 0, -1) if left[x]]
    path: list[tuple[dict, int]] = []
    used, held = 0, int((count * np.arange(capacity + 1)).sum())

    def options(tail) -> Iterator[tuple[dict, int, tuple | None]]:
        """Fillings of the bin of the longest length left, each in as many bins as go, then in fewer."""
        top = next(x for x in lengths if left[x])
        left[top] -= 1
        # one bin less than the best plan has this much room to spare, once the closed bins' gaps are off
        spare = (fewest - 1 - used) * capacity - held
        sets = fillings(left, [x for x in lengths if left[x]], capacity - top, min(spare, capacity))
        left[top] += 1
        for runs in sets:
            bin_of = dict(runs)
            bin_of[top] = bin_of.get(top, 0) + 1
            key = (capacity - sum(x * n for x, n in bin_of.items()), tuple((-x, -n) for x, n in runs))
            if tail and tail[0] == top and key <= tail[1]:
                continue                               # the same bins in another order
            most = min(left[x] // n for x, n in bin_of.items())
            for bins in range(most, 0, -1):
                yield bin_of, bins, (top, key) if bins < most else None

    levels = [options(None)] if fewest > need else []
    tried = 0
    while levels and fewest > need and tried < nodes:
        step = next(levels[-1], None)
        if step is None:
            levels.pop()
            if path:
                bin_of, bins = path.pop()
                for x, n in bin_of.items():
                    left[x] += n * bins
                    held += x * n * bins
                used -= bins
            continue
        bin_of, bins, tail = step
        gap = capacity - sum(x * n for x, n in bin_of.items())
        if (fewest - 1 - used) * capacity - held < gap * bins:
            continue                                   # wastes more than the best plan can spare
        tried += 1
        for x, n in bin_of.items():
            left[x] -= n * bins
            held -= x * n * bins
        used += bins
        path.append((bin_of, bins))
        if not held and used < fewest:
            fewest, best = used, [(tuple(sorted(d.items(), reverse=True)), n) for d, n in path]
        levels.append(options(tail) if held else iter(()))
    return best, need


def run_table(plan: Plan, capacity: int) -> dict[str, np.ndarray]:
    """For every length, which of its pieces (by number) stand in which bins, and where in them."""
    rows, taken, bins = [], {}, 0
    for runs, copies in plan:
        offset = 0
        for length, each in runs:
            first = taken.get(length, 0)
            rows.append((length, first, each, bins, offset))
            taken[length] = first + copies * each
            offset += length * each
        bins += copies
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "each", "bin", "offset"), cols))


def token_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: ``doc_id, piece, start, length, ids_crc32`` and, if kept, ``ids``
    (little-endian unsigned 32-bit ids). A document's ids end with ``END``; only documents of more than
    ``capacity`` ids are cut. A null or empty text has the closing id alone. Repeated rows are documents
    of their own. Other columns are not read.
    """
    vocab = vocabulary(docs.sparkSession, path)
    picked = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([picked.schema["doc_id"], T.StructField("piece", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")),
                           *([T.StructField("ids", T.BinaryType())] if keep_ids else [])])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocab)
        for batch in batches:
            texts, names = batch.column(1), batch.column(0)
            for lo, hi in slices(texts, 2 << 20):
                ids, n = code.encode(texts[lo:hi])
                ids = np.insert(ids, np.cumsum(n), END).astype("<u4")
                n = n + 1
                pieces = -(-n // capacity)
                row = np.repeat(np.arange(hi - lo), pieces)
                piece = spread(np.zeros(hi - lo, np.int64), pieces)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                begin = (np.cumsum(n) - n)[row] + start
                parts = [ids[a:a + b] for a, b in zip(begin.tolist(), length.tolist())]
                cols = [names[lo:hi].take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                        pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                if keep_ids:
                    cols.append(pa.array([p.tobytes() for p in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, [f.name for f in schema])

    return picked.mapInArrow(cut, schema)


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Every row of ``pieces`` (all columns kept) with ``sequence_id`` and ``offset``: its sequence of at
    most ``capacity`` tokens and its place there, without gaps. Lengths are 1 to ``capacity``. Pieces of
    one length, repeated rows too, take the places of that length in the order of the written rows. No
    pieces, no sequences. Columns named ``sequence_id`` or ``offset`` are replaced.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    columns = pieces.columns
    n, f, b, r, k, base = (free_name(pieces, x) for x in ("p_length", "p_file", "p_block", "p_row", "p_n", "p_base"))
    rows = saved(pieces, "pieces").select("*", F.col(f"`{length}`").cast("int").alias(n), F.col("_metadata.file_name").alias(f),
                                          F.shiftright("_metadata.row_index", BLOCK_BITS).alias(b),
                                          F.col("_metadata.row_index").alias(r))
    counts = saved(rows.groupBy(n, f, b).agg(F.count(F.lit(1)).alias(k)), "piece-counts")
    count = np.zeros(capacity + 1, np.int64)
    for got in counts.groupBy(n).agg(F.sum(k).alias(k)).collect():       # at most one row per length
        if not 1 <= got[0] <= capacity:
            raise ValueError(f"a piece of {got[0]} tokens does not fit {capacity}")
        count[got[0]] = got[1]
    plan, _ = complete_bins(count, capacity, nodes)
    runs = spark.sparkContext.broadcast(run_table(plan, capacity))
    before = Window.partitionBy(n).orderBy(f, b).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(n, f, b, F.coalesce(F.sum(k).over(before), F.lit(0)).alias(base))
    inside = Window.partitionBy(n, f, b).orderBy(r)
    numbered = rows.join(bases, [n, f, b]).select(
        *(F.col(f"`{c}`") for c in columns), n, (F.col(base) + F.row_number().over(inside) - 1).alias(r))
    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = runs.value
        key = t["length"] << 48 | t["first"]
        for batch in batches:
            size = batch.column(len(columns)).to_numpy(zero_copy_only=False).astype(np.int64)
            nth = batch.column(len(columns) + 1).to_numpy(zero_copy_only=False)
            at = np.searchsorted(key, size << 48 | nth, side="right") - 1
            nth = nth - t["first"][at]
            each = t["each"][at]
            cols = [*batch.columns[:len(columns)], pa.array(t["bin"][at] + nth // each),
                    pa.array(t["offset"][at] + nth % each * size)]
            yield pa.RecordBatch.from_arrays(cols, [x.name for x in schema])

    return numbered.mapInArrow(place, schema)


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """One row per sequence: ``sequence_id, n_tokens``, its ``ids`` end to end and the ids of its
    documents in that order. ``packed`` is the result of ``pack`` on pieces with their ids; a sequence
    has at most ``capacity`` rows."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.col(f"`{ids}`").alias("ids"), "doc_id", "length")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"),
        F.aggregate("parts.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"), F.col("parts.doc_id").alias("doc_ids"))

