"""Phrase collocations by weighted acyclic automata (operator 13).

Every shard of the texts sorts its n-grams and builds count transducers from them: deterministic
acyclic automata over words whose arcs carry the count of the n-gram that ends there, with equal
states (same labels, counts and targets) kept once. A transducer is cut by range of its two-word
prefixes' hashes, so a frequent first word spreads over all ranges. Ranges of all shards are united,
weights summed and rare n-grams pruned. Looking a phrase's parts up is a walk of the part through the
transducer of its range (the composition of the two).

Two passes: words and pairs first, then only triples whose two pairs are both frequent, which a
bitmap of fixed size tells (a triple is no more frequent than its pairs). Words are 64-bit hashes of
language and word until the end; two words of one hash are found when ranges are united.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, byte_class, find_words, hash_words, mix64, saved, slices, text_buffer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BREAK = byte_class(*((ord(c), ord(c)) for c in ".,;:!?"), (0x0A, 0x0D))
WORD = ~(BREAK | byte_class((0x20, 0x20), (0x09, 0x09)))
UNKNOWN = "und"
MIN_COUNT = 10
KEEP = 2000
COVERED_PCT = 50             # a phrase goes if a longer one has this share of its count
SLICE = 1 << 20              # text bytes whose n-grams are sorted at once
SHARD = 1 << 20              # n-grams of a shard, more or less
RANGES_PER_TASK = 4          # prefix ranges per shuffle partition, each (as a rule) in a task of its own
FILTER_BITS = 27             # bitmap of frequent pairs: 16 MB
ONE = np.uint64(1)


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(a ^ mix64(b + ONE))


def range_of(key: np.ndarray, ranges: int) -> np.ndarray:
    return ((key >> np.uint64(33)).astype(np.int64) * ranges) >> 31


def narrow(x: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest width, which the first byte names."""
    top = int(x.max()) if len(x) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def wide(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64)


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(start - total + size, size)


def summed(columns: list[np.ndarray], count: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns in sorted order, with the sums of their counts."""
    if not len(count):
        return columns, count
    if len(columns) == 1:
        order = np.argsort(columns[0], kind="stable")
    else:
        symbols = np.unique(np.concatenate(columns))
        bits = max(1, int(len(symbols)).bit_length())
        if bits * len(columns) < 64:
            key = np.zeros(len(count), np.int64)
            for c in columns:
                key = key << bits | np.searchsorted(symbols, c)
            order = np.argsort(key, kind="stable")
        else:
            order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.concatenate(([True], np.any([c[1:] != c[:-1] for c in columns], axis=0)))
    head = np.flatnonzero(new)
    return [c[head] for c in columns], np.add.reduceat(count[order], head)


class Grams:
    """Sorted n-grams with counts: words (with their texts and languages), pairs and triples."""

    def __init__(self, word, word_n, texts, langs, pair, pair_n, triple, triple_n):
        self.word, self.word_n, self.texts, self.langs = word, word_n, texts, langs
        self.pair, self.pair_n, self.triple, self.triple_n = pair, pair_n, triple, triple_n

    def __len__(self) -> int:
        return len(self.word) + len(self.pair_n) + len(self.triple_n)

    @staticmethod
    def union(parts: list[Grams]) -> Grams:
        if len(parts) == 1:
            return parts[0]
        word = np.concatenate([p.word for p in parts])
        texts = pa.concat_arrays([p.texts for p in parts])
        langs = pa.concat_arrays([p.langs for p in parts])
        known, first, of = np.unique(word, return_index=True, return_inverse=True)
        same = texts.take(pa.array(first)).take(pa.array(of)).equals(texts) and langs.take(pa.array(first)).take(pa.array(of)).equals(langs)
        if not same:
            raise RuntimeError("two words share a hash: choose another salt")
        word_n = np.zeros(len(known), np.int64)
        np.add.at(word_n, of, np.concatenate([p.word_n for p in parts]))
        pair, pair_n = summed([np.concatenate([p.pair[i] for p in parts]) for i in range(2)],
                              np.concatenate([p.pair_n for p in parts]))
        triple, triple_n = summed([np.concatenate([p.triple[i] for p in parts]) for i in range(3)],
                                  np.concatenate([p.triple_n for p in parts]))
        return Grams(known, word_n, texts.take(pa.array(first)), langs.take(pa.array(first)), pair, pair_n, triple, triple_n)

    def pruned(self, least: int) -> Grams:
        w, p, t = self.word_n >= least, self.pair_n >= least, self.triple_n >= least
        return Grams(self.word[w], self.word_n[w], self.texts.filter(pa.array(w)), self.langs.filter(pa.array(w)),
                     [x[p] for x in self.pair], self.pair_n[p], [x[t] for x in self.triple], self.triple_n[t])

    def by_range(self, ranges: int) -> Iterator[tuple[int, Grams]]:
        """The n-grams of every range; pairs and triples go by the hash of their first two words."""
        at = [range_of(self.word, ranges), range_of(pair_key(*self.pair), ranges), range_of(pair_key(*self.triple[:2]), ranges)]
        order = [np.argsort(x, kind="stable") for x in at]
        cuts = [np.searchsorted(x[o], np.arange(ranges + 1)) for x, o in zip(at, order)]
        for r in np.unique(np.concatenate(at)).tolist():
            w, p, t = (o[c[r]:c[r + 1]] for o, c in zip(order, cuts))
            yield r, Grams(self.word[w], self.word_n[w], self.texts.take(pa.array(w)), self.langs.take(pa.array(w)),
                           [x[p] for x in self.pair], self.pair_n[p], [x[t] for x in self.triple], self.triple_n[t])


class States:
    """States of one depth: each has a range of arcs, and equal states are kept once."""

    def __init__(self, first: np.ndarray, columns: list[np.ndarray]):
        self.first, self.columns = first, columns

    @staticmethod
    def minimal(owner_first: np.ndarray, columns: list[np.ndarray]) -> tuple[States, np.ndarray]:
        """States from arcs in order, owner by owner; and the state of each owner."""
        size = np.diff(owner_first)
        if not len(size):
            return States(np.zeros(1, np.int64), columns), np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            mark = np.zeros(len(columns[0]), np.uint64)
            for c in columns:
                mark = mix64(mark * np.uint64(3) + c.astype(np.uint64) + ONE)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mark, dtype=np.uint64)))
            sign = mix64((sums[owner_first[1:]] - sums[owner_first[:-1]]) ^ size.astype(np.uint64))
        _, kept, state = np.unique(sign, return_index=True, return_inverse=True)
        arcs = spread(owner_first[:-1], size)
        alike = np.zeros(len(size), bool)
        alike[size == size[kept][state]] = True
        if alike.all():                                   # equal marks must mean equal arcs
            model = spread(owner_first[:-1][kept][state], size)
            alike = np.array([all((c[arcs] == c[model]).all() for c in columns)])
        if not alike.all():
            kept, state = np.arange(len(size)), np.arange(len(size))
        arcs = spread(owner_first[:-1][kept], size[kept])
        return States(np.concatenate(([0], np.cumsum(size[kept]))), [c[arcs] for c in columns]), state

    def step(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The arc that each state has for a label, or -1 (binary search in all states at once)."""
        own = self.columns[0]
        lo, end = self.first[state], self.first[state + 1]
        hi = end.copy()
        while True:
            open_ = lo < hi
            if not open_.any():
                break
            mid = (lo + hi) // 2
            less = open_ & (own[np.minimum(mid, len(own) - 1)] < label)
            lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        found = (lo < end) & (own[np.minimum(lo, len(own) - 1)] == label) if len(own) else np.zeros(len(label), bool)
        return np.where(found, lo, -1)


AUTOMATON = ["root", "root_n", "root_state", "first1", "label1", "n1", "state1", "first2", "label2", "n2"]


class Transducer:
    """Acyclic automaton of phrases of one to three words: arcs carry a label, the count of the phrase
    that ends there (0 if it is counted in another range) and the state beyond."""

    def __init__(self, root, root_n, root_state, one: States, two: States):
        self.root, self.root_n, self.root_state, self.one, self.two = root, root_n, root_state, one, two

    @staticmethod
    def of(g: Grams) -> Transducer:
        """From sorted n-grams, deepest states first."""
        (a, b), (t1, t2, t3) = g.pair, g.triple
        new = np.ones(len(t1), bool)
        new[1:] = (t1[1:] != t1[:-1]) | (t2[1:] != t2[:-1])
        head = np.flatnonzero(new)
        two, state = States.minimal(np.append(head, len(t1)) if len(head) else np.zeros(1, np.int64), [t3, g.triple_n])
        # arcs of depth one: the pairs and the first two words of triples; state 0 stands for no arcs
        (p1, p2), both = summed([np.concatenate((a, t1[head])), np.concatenate((b, t2[head]))],
                                np.concatenate((g.pair_n, np.zeros(len(head), np.int64))))
        beyond = np.zeros(len(p1), np.int64)
        if len(head):
            beyond[rows_of(p1, p2, t1[head], t2[head])] = state + 1
        new = np.ones(len(p1), bool)
        new[1:] = p1[1:] != p1[:-1]
        start = np.flatnonzero(new)
        one, state = States.minimal(np.append(start, len(p1)) if len(start) else np.zeros(1, np.int64), [p2, both, beyond])
        root = np.union1d(g.word, p1[start])
        root_n, root_state = np.zeros(len(root), np.int64), np.zeros(len(root), np.int64)
        root_n[np.searchsorted(root, g.word)] = g.word_n
        root_state[np.searchsorted(root, p1[start])] = state + 1
        return Transducer(root, root_n, root_state, one, two)

    def row(self) -> list[bytes]:
        (l1, n1, s1), (l2, n2) = self.one.columns, self.two.columns
        return [self.root.tobytes(), narrow(self.root_n), narrow(self.root_state), narrow(self.one.first), l1.tobytes(),
                narrow(n1), narrow(s1), narrow(self.two.first), l2.tobytes(), narrow(n2)]

    @staticmethod
    def read(row: list[bytes]) -> Transducer:
        labels = {0, 4, 8}
        x = [np.frombuffer(b, np.uint64) if i in labels else wide(b) for i, b in enumerate(row)]
        return Transducer(x[0], x[1], x[2], States(x[3], [x[4], x[5], x[6]]), States(x[7], [x[8], x[9]]))

    def grams(self, texts: pa.Array, langs: pa.Array) -> Grams:
        """All n-grams again, in order; texts and languages are those of the words counted here."""
        own = self.root_n > 0
        has = np.flatnonzero(self.root_state)
        state = self.root_state[has] - 1
        size = np.diff(self.one.first)[state]
        arc = spread(self.one.first[state], size)
        p1, (p2, n, beyond) = np.repeat(self.root[has], size), (c[arc] for c in self.one.columns)
        deep = np.flatnonzero(beyond)
        state = beyond[deep] - 1
        size = np.diff(self.two.first)[state]
        arc = spread(self.two.first[state], size)
        triple = [np.repeat(p1[deep], size), np.repeat(p2[deep], size), self.two.columns[0][arc]]
        counted = n > 0
        return Grams(self.root[own], self.root_n[own], texts, langs, [p1[counted], p2[counted]], n[counted],
                     triple, self.two.columns[1][arc])

    def count(self, a: np.ndarray, b: np.ndarray, is_pair: np.ndarray) -> np.ndarray:
        """Counts of words ``a`` or pairs ``a b``: each is walked from the root; 0 where no path goes."""
        out = np.zeros(len(a), np.int64)
        if not len(self.root):
            return out
        at = np.minimum(np.searchsorted(self.root, a), len(self.root) - 1)
        there = self.root[at] == a
        out[there & ~is_pair] = self.root_n[at[there & ~is_pair]]
        go = np.flatnonzero(there & is_pair & (self.root_state[at] > 0))
        arc = self.one.step(self.root_state[at[go]] - 1, b[go])
        out[go[arc >= 0]] = self.one.columns[1][arc[arc >= 0]]
        return out


def rows_of(p1: np.ndarray, p2: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of the pairs ``a b`` in the sorted pairs ``p1 p2``, which hold them all."""
    key = pair_key(p1, p2)
    order = np.argsort(key)
    return order[np.searchsorted(key[order], pair_key(a, b))]


def stream(texts: pa.Array, langs: pa.Array, salt: int):
    """Words of a slice: hash with language, whether the next (and the one after) is of the same
    piece, and what gives their texts and languages."""
    buf, off = text_buffer(texts)
    low = LOWER[buf]
    start, end, first = find_words(low, off, WORD)
    breaks = np.concatenate(([0], np.cumsum(BREAK[low], dtype=np.int64)))
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    coded = langs.fill_null(UNKNOWN).dictionary_encode()
    lbuf, loff = text_buffer(coded.dictionary)
    with np.errstate(over="ignore"):
        seed = mix64(hash_words(lbuf, loff[:-1], loff[1:]) + np.uint64(salt)) if len(loff) > 1 else np.zeros(0, np.uint64)
        lang = np.asarray(coded.indices)[doc]
        symbol = mix64(hash_words(low, start, end) ^ seed[lang])
    joined = np.zeros(len(start), bool)
    joined[:-1] = (doc[1:] == doc[:-1]) & (breaks[start[1:]] == breaks[end[:-1]])
    return symbol, joined, (low, start, end, lang, coded.dictionary)


def no_grams() -> tuple[list, np.ndarray]:
    return [np.zeros(0, np.uint64)] * 3, np.zeros(0, np.int64)


def words_and_pairs(texts: pa.Array, langs: pa.Array, salt: int) -> Grams:
    symbol, joined, (low, start, end, lang, names) = stream(texts, langs, salt)
    word, first, of, n = np.unique(symbol, return_index=True, return_inverse=True, return_counts=True)
    size = (end - start)[first]
    offset = np.concatenate(([0], np.cumsum(size)))
    data = low[spread(start[first], size)]
    strings = pa.Array.from_buffers(pa.large_string(), len(word), [None, pa.py_buffer(offset), pa.py_buffer(data)])
    at = np.flatnonzero(joined)
    key, pair_n = np.unique(of[at] << 32 | of[at + 1], return_counts=True)
    triple, triple_n = no_grams()
    return Grams(word, n, strings, names.take(pa.array(lang[first])).cast(pa.large_string()), [word[key >> 32], word[key & 0xFFFFFFFF]],
                 pair_n, triple, triple_n)


def triples(texts: pa.Array, langs: pa.Array, salt: int, frequent: np.ndarray) -> Grams:
    """Triples of two pairs that ``frequent`` (a bitmap over pair hashes) may hold."""
    symbol, joined, _ = stream(texts, langs, salt)
    at = np.flatnonzero(joined)
    bit = (pair_key(symbol[at], symbol[at + 1]) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    may = np.zeros(len(symbol) + 1, bool)
    may[at] = frequent[bit >> 3] >> (bit & 7).astype(np.uint8) & 1
    at = np.flatnonzero(may[:-1] & may[1:])
    columns, n = summed([symbol[at], symbol[at + 1], symbol[at + 2]], np.ones(len(at), np.int64))
    none = pa.array([], pa.large_string())
    return Grams(np.zeros(0, np.uint64), np.zeros(0, np.int64), none, none, [np.zeros(0, np.uint64)] * 2,
                 np.zeros(0, np.int64), columns, n)


ROW = ("range int, " + ", ".join(f"{c} binary" for c in AUTOMATON) + ", words array<string>, langs array<string>, "
       "total_langs array<string>, totals array<long>")


def batch_of(rows: list[tuple[int, Grams, dict]]) -> pa.RecordBatch:
    """Rows of ``ROW``: a range's transducer, the texts of its words and its totals per language."""
    machines = list(zip(*(Transducer.of(g).row() for _, g, _ in rows)))
    ends = np.cumsum([0, *(len(g.texts) for _, g, _ in rows)])
    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(x).cast(pa.string()))
             for x in ([g.texts for _, g, _ in rows], [g.langs for _, g, _ in rows])]
    columns = [pa.array([r for r, _, _ in rows], pa.int32()), *(pa.array(m, pa.binary()) for m in machines), *lists,
               pa.array([list(t) for _, _, t in rows], pa.list_(pa.string())),
               pa.array([list(t.values()) for _, _, t in rows], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["range", *AUTOMATON, "words", "langs", "total_langs", "totals"])


def rows_of_batch(batch: pa.RecordBatch) -> Iterator[tuple[int, Grams]]:
    for i in range(batch.num_rows):
        machine = Transducer.read([batch[c][i].as_py() for c in AUTOMATON])
        yield batch["range"][i].as_py(), machine.grams(*(batch[c][i].values.cast(pa.large_string()) for c in ("words", "langs")))


def shards(docs: DataFrame, lang: str, text: str, ranges: int, make) -> DataFrame:
    """Transducers of every shard by prefix range; ``make(texts, langs)`` gives a slice's n-grams."""
    picked = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Grams] = []

        def out() -> Iterator[pa.RecordBatch]:
            rows, size = [], 0
            for r, g in Grams.union(held).by_range(ranges):
                rows.append((r, g, {}))
                size += len(g)
                if size > 1 << 18:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)

        for batch in batches:
            for lo, hi in slices(batch.column(1), SLICE):
                held.append(make(batch.column(1)[lo:hi], batch.column(0)[lo:hi]))
                if sum(map(len, held)) > SHARD:
                    yield from out()
                    held = []
        if held:
            yield from out()

    return picked.mapInArrow(run, ROW)


def unite(parts: DataFrame, least: int, ranges: int) -> DataFrame:
    """One transducer per range: weights of all shards summed, n-grams under ``least`` pruned, and the
    number of all words per language before that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def done() -> pa.RecordBatch:
            g = Grams.union(held)
            coded = g.langs.dictionary_encode()
            n = np.zeros(len(coded.dictionary), np.int64)
            np.add.at(n, np.asarray(coded.indices), g.word_n)
            return batch_of([(at, g.pruned(least), dict(zip(coded.dictionary.to_pylist(), n.tolist())))])

        for r, g in (x for batch in batches for x in rows_of_batch(batch)):
            if held and r != at:
                yield done()
                held = []
            at = r
            held.append(g)
            if len(held) > 1 and sum(map(len, held[1:])) > max(SHARD // 4, len(held[0])):
                held = [Grams.union(held)]
        if held:
            yield done()

    return parts.repartition(2 * ranges, "range").sortWithinPartitions("range").mapInArrow(run, ROW)


def expand(automata: DataFrame, words: int, ranges: int) -> DataFrame:
    """``s1..sk, n`` of the n-grams of ``words`` words. Single words come with ``lang`` and ``word``, pairs
    with their place in the bitmap (``bit``), and pairs and triples with the ranges of their words
    (``r1, r2``) and pairs (``r12, r23``)."""
    extra = {1: ["lang string", "word string"], 2: ["bit long", "r1 int", "r2 int", "r12 int"], 3: ["r12 int", "r23 int"]}[words]
    fields = [*(f"s{i + 1} long" for i in range(words)), "n long", *extra]

    def home(key: np.ndarray) -> pa.Array:
        return pa.array(range_of(key, ranges), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, g in (x for batch in batches for x in rows_of_batch(batch)):
            columns, n = {1: ([g.word], g.word_n), 2: (g.pair, g.pair_n), 3: (g.triple, g.triple_n)}[words]
            arrays = [pa.array(c.view(np.int64)) for c in columns] + [pa.array(n)]
            if words == 1:
                arrays += [g.langs.cast(pa.string()), g.texts.cast(pa.string())]
            elif words == 2:
                key = pair_key(*columns)
                bit = (key >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                arrays += [pa.array(bit), home(columns[0]), home(columns[1]), home(key)]
            else:
                arrays += [home(pair_key(*columns[:2])), home(pair_key(*columns[1:]))]
            yield pa.RecordBatch.from_arrays(arrays, [f.split(" ")[0] for f in fields])

    return automata.mapInArrow(run, ", ".join(fields))


def pair_filter(pairs: DataFrame) -> np.ndarray:
    """Bitmap of 2^FILTER_BITS bits over the hashes of the pairs. Its size does not grow: with very many
    pairs it lets more triples through, all of which are counted."""
    maps = pairs.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map")).collect()      # 4 KB each, 4,097 at most
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in maps:
        # bucket b holds the values 32768 * (b - 1) + 1 to 32768 * b, and bucket 0 holds 0
        flags = np.unpackbits(np.frombuffer(r.map, np.uint8), bitorder="little")
        values = np.flatnonzero(flags) + (32768 * (r.bucket - 1) + 1 if r.bucket else 0)
        np.bitwise_or.at(out, values >> 3, (1 << (values & 7)).astype(np.uint8))
    return out


def look_up(automata: DataFrame, parts: DataFrame, tasks: int) -> DataFrame:
    """``s1, s2, n`` for every distinct row ``range, s1, s2`` of ``parts`` (``s2`` null: a word): each goes to
    its range and is walked through the transducer there. Parts that no transducer has are left out."""
    asked = parts.distinct()
    both = automata.select("range", *AUTOMATON, F.lit(None).cast("long").alias("s1"), F.lit(None).cast("long").alias("s2")) \
        .unionByName(asked, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, machine = None, None
        for batch in batches:
            ranges_, is_machine = np.asarray(batch["range"]), np.asarray(batch["root"].is_valid())
            cut = np.flatnonzero(np.concatenate(([True], (ranges_[1:] != ranges_[:-1]) | is_machine[1:] | is_machine[:-1])))
            for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(ranges_)]):
                if is_machine[lo]:
                    at, machine = int(ranges_[lo]), Transducer.read([batch[c][lo].as_py() for c in AUTOMATON])
                elif ranges_[lo] == at:
                    a, b = batch["s1"][lo:hi], batch["s2"][lo:hi]
                    pair = np.asarray(b.is_valid())
                    n = machine.count(np.asarray(a).view(np.uint64), np.asarray(b.fill_null(0)).view(np.uint64), pair)
                    found = pa.array(n > 0)
                    yield pa.RecordBatch.from_arrays([a.filter(found), b.filter(found), pa.array(n).filter(found)],
                                                     ["s1", "s2", "n"])

    return both.repartition(tasks, "range").sortWithinPartitions("range", F.col("root").isNull()).mapInArrow(
        run, "s1 long, s2 long, n long")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = MIN_COUNT, keep: int = KEEP,
                 salt: int = 0) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``keep`` phrases of two or three
    words that come ``least`` times or more, by score, then count, then phrase.

    The score is that of the worst cut in two: a million times the phrase's count squared over the
    product of its parts' counts, rounded down. Phrases half of whose occurrences lie in one longer
    candidate go. A null language counts as ``und``; null and empty texts have no words; repeated rows
    count each. Other columns are not read. No candidates: no rows.
    """
    spark = docs.sparkSession
    ranges = RANGES_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = saved(unite(shards(docs, lang, text, ranges, lambda t, g: words_and_pairs(t, g, salt)), least, ranges), "words-pairs")
    pairs = expand(first, 2, ranges)
    bitmap = spark.sparkContext.broadcast(pair_filter(pairs))
    second = saved(unite(shards(docs, lang, text, ranges, lambda t, g: triples(t, g, salt, bitmap.value)), least, ranges), "triples")
    threes = expand(second, 3, ranges)
    col = F.col
    null = F.lit(None).cast("long")
    parts = pairs.select(col("r1").alias("range"), "s1", null.alias("s2")).union(pairs.select("r2", "s2", null)).union(
        threes.select("r12", "s1", "s2")).union(threes.select("r23", "s2", "s3"))
    counts = saved(look_up(first, parts, 2 * ranges), "part-counts")
    words = expand(first, 1, ranges).select(col("s1").alias("s"), "lang", "word")
    single = counts.where("s2 IS NULL").select(col("s1").alias("s"), "n").join(words, "s")
    double = counts.where("s2 IS NOT NULL")

    def word(k: int) -> DataFrame:
        return single.select(col("s").alias(f"s{k}"), col("n").alias(f"n{k}"), col("word").alias(f"w{k}"),
                             *([col("lang")] if k == 1 else []))

    def cut(a, l, r):  # noqa: E741
        return F.expr(f"cast(1000000 * cast({a} as decimal(20,0)) * {a} div (cast({l} as decimal(20,0)) * {r}) as long)")

    covered = threes.select("s1", "s2", "n").union(threes.select("s2", "s3", "n")).groupBy("s1", "s2").agg(F.max("n").alias("longer"))
    two = pairs.join(covered, ["s1", "s2"], "left").where(
        col("longer").isNull() | (100 * col("longer") < COVERED_PCT * col("n"))).join(word(1), "s1").join(word(2), "s2").select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), col("n").alias("a"), col("n1").alias("l"), col("n2").alias("r"),
        cut("n", "n1", "n2").alias("score"))
    three = threes.join(word(1), "s1").join(word(2).drop("n2"), "s2").join(word(3), "s3") \
        .join(double.withColumnRenamed("n", "n12"), ["s1", "s2"]) \
        .join(double.select(col("s1").alias("s2"), col("s2").alias("s3"), col("n").alias("n23")), ["s2", "s3"])
    worst = F.least(F.struct(cut("n", "n1", "n23").alias("score"), F.lit(1).alias("k"), col("n1").alias("l"), col("n23").alias("r")),
                    F.struct(cut("n", "n12", "n3").alias("score"), F.lit(2).alias("k"), col("n12").alias("l"), col("n3").alias("r")))
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), col("n").alias("a"), worst.alias("cut")) \
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    near = Window.partitionBy("lang", F.pmod(F.hash("phrase"), F.lit(64))).orderBy(*order)
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(near)).where(col("rank") <= keep)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(
        col("rank") <= keep)
    total = first.select(F.explode(F.arrays_zip("total_langs", "totals")).alias("x")).groupBy(
        col("x.total_langs").alias("lang")).agg(F.sum("x.totals").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
