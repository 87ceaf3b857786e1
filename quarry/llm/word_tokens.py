"""Token ids of a word-BPE vocabulary file for whole Arrow batches of texts.

The vocabulary's pre-tokens never cross white space. In white-space chunks of printable ASCII and
Latin-1 letters they are cut here, over the bytes of all texts of a batch at once, and each distinct
pre-token is merged once, pair by pair in the order of the file's merges. Chunks with any other
character or with the mark of an added token, and overlong pre-tokens, go through the ``tokenizers``
library itself. Both ways give the ids of ``Tokenizer.from_file(path).encode(text,
add_special_tokens=False)``; distinct pre-tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

import json
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession

from quarry.llm.common import BLANK, find_words, hash_words, mix64, text_buffer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONG = 64                    # bytes of a pre-token; longer ones are left to the library
CACHE = 1 << 20              # pre-tokens that a worker remembers
# What follows an apostrophe in the vocabulary's pre-token pattern
# 's|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+
ONE_LETTER = b"stmd"
TWO_LETTERS = (b"re", b"ve", b"ll")
SPACE, LETTER, DIGIT, MARK, ODD = range(5)
NONE = np.int32(2**31 - 1)


def byte_symbols() -> list[str]:
    """The printable character that a byte-level vocabulary writes for each byte value."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + other.index(b)) for b in range(256)]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def vocabulary(spark: SparkSession, path: str | None = None):
    """The vocabulary file as a broadcast of its bytes (under 2 MB for 49,408 ids)."""
    with open(path or vocabulary_path(), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


class Encoder:
    def __init__(self, file: bytes):
        self.file, self.library = file.decode(), None
        spec = json.loads(self.file)
        ids, merges = spec["model"]["vocab"], spec["model"]["merges"]
        suffix = spec["model"]["end_of_word_suffix"]
        if not all(t["content"].startswith("<|") for t in spec["added_tokens"]):
            raise ValueError("added tokens that do not begin with <|")
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], np.int64)
        self.final = np.array([ids[s + suffix] for s in symbols], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        key = np.array([ids[a] << 20 | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank = key[order], order.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)     # by rank
        self.forget()

    def forget(self) -> None:
        self.hash = np.zeros(0, np.uint64)               # sorted, with the entry of each
        self.entry = np.zeros(0, np.int64)
        self.ids, self.at, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def by_library(self, texts: list[str]) -> list:
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_str(self.file)
        return [e.ids for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        k = left << 20 | right
        at = np.minimum(np.searchsorted(self.key, k), len(self.key) - 1)
        return np.where(self.key[at] == k, self.rank[at], NONE)

    def merge(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens (bytes end to end, length of each) and the number of each: per round, every
        pre-token merges its pair of lowest rank, wherever it stands in it, from left to right."""
        if not len(size):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        sym = self.inner[raw]
        ends = np.cumsum(size) - 1
        sym[ends] = self.final[raw[ends]]
        word = np.repeat(np.arange(len(size)), size)
        last = np.zeros(len(sym), bool)
        last[ends] = True
        rank = np.full(len(sym), NONE, np.int32)
        at = np.flatnonzero(~last)
        rank[at] = self.ranks(sym[at], sym[at + 1])
        done_word, done_sym = [], []
        while len(sym):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(sym))))
            ready = low == NONE
            if ready.any():
                done_word.append(word[ready])
                done_sym.append(sym[ready])
                go = ~ready
                sym, word, last, rank, low = sym[go], word[go], last[go], rank[go], low[go]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == low)
            if len(hit) > 1:                             # overlapping pairs (aaa): every second of a run
                new_run = np.concatenate(([True], (np.diff(hit) > 1) | (word[hit[1:]] != word[hit[:-1]])))
                run = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            sym[hit] = self.merged[rank[hit]]
            last[hit] = last[hit + 1]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            sym, word, last, rank = sym[keep], word[keep], last[keep], rank[keep]
            hit = place[hit]
            before = hit[hit > 0] - 1
            near = np.concatenate((hit, before))
            rank[near] = NONE
            near = near[~last[near]]
            rank[near] = self.ranks(sym[near], sym[near + 1])
        w, s = np.concatenate(done_word), np.concatenate(done_sym)
        order = np.argsort(w, kind="stable")
        return s[order].astype(np.int32), np.bincount(w, minlength=len(size)).astype(np.int64)

    def learn(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, alone: np.ndarray, keys: np.ndarray) -> None:
        """Remember new units (byte ranges of ``buf``); ``alone`` marks those for the library."""
        size = end - start
        alone = alone | (size > LONG)
        easy, hard = np.flatnonzero(~alone), np.flatnonzero(alone)
        flat, n_easy = self.merge(buf[spread(start[easy], size[easy])], size[easy])
        lists = self.by_library([bytes(buf[start[i]:end[i]]).decode() for i in hard]) if len(hard) else []
        n_hard = np.fromiter(map(len, lists), np.int64, len(lists))
        n = np.concatenate((n_easy, n_hard))
        self.at = np.concatenate((self.at, len(self.ids) + np.cumsum(n) - n))
        self.ids = np.concatenate((self.ids, flat, np.array([i for x in lists for i in x], np.int32)))
        entry = len(self.size) + np.arange(len(n))
        self.size = np.concatenate((self.size, n))
        keys = keys[np.concatenate((easy, hard))]
        order = np.argsort(keys)
        place = np.searchsorted(self.hash, keys[order])
        self.hash, self.entry = np.insert(self.hash, place, keys[order]), np.insert(self.entry, place, entry[order])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end and the number of each (null and blank texts: none)."""
        if len(self.hash) > CACHE:
            self.forget()
        buf, off = text_buffer(texts)
        low, start, end, alone = units(buf, off)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        with np.errstate(over="ignore"):
            keys = hash_words(low, start, end)
            keys = np.where(alone, mix64(keys + np.uint64(1)), keys)
        keys, first, code = np.unique(keys, return_index=True, return_inverse=True)
        new = np.flatnonzero(~self.has(keys))
        if len(new):
            at = first[new]
            self.learn(low, start[at], end[at], alone[at], keys[new])
        entry = self.entry[np.searchsorted(self.hash, keys)][code]
        n = self.size[entry]
        out = self.ids[spread(self.at[entry], n)]
        total = np.concatenate(([0], np.cumsum(n)))
        return out, np.diff(total[np.searchsorted(start, off)])

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.hash):
            return np.zeros(len(keys), bool)
        return self.hash[np.minimum(np.searchsorted(self.hash, keys), len(self.hash) - 1)] == keys


def byte_kinds() -> np.ndarray:
    t = np.full(256, ODD, np.uint8)
    t[0x21:0x7F] = MARK
    t[0x30:0x3A] = DIGIT
    t[0x41:0x5B] = t[0x61:0x7B] = LETTER
    t[0x80:0xC0] = t[0xC3] = LETTER          # as two bytes; whatever else has such bytes is found below
    t[BLANK] = SPACE
    return t


KINDS = byte_kinds()


def units(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, byte ``start`` and ``end`` of every unit, and which units are whole chunks
    for the library (their bytes are as in the text)."""
    kind, low = KINDS[buf], buf.copy()
    low[(buf >= 0x41) & (buf <= 0x5A)] += 32
    odd = kind == ODD
    high = np.flatnonzero(buf >= 0x80)
    if len(high):                                # C3 80 to C3 BF but for the signs of times and division
        second = high[(buf[high] < 0xC0) & (high > 0)]
        fine = (buf[second - 1] == 0xC3) & (buf[second] != 0x97) & (buf[second] != 0xB7)
        odd[second[~fine]] = True
        upper = second[fine & (buf[second] < 0x9F)]
        low[upper] += 32
    angle = np.flatnonzero(buf[:-1] == 0x3C)
    odd[angle[buf[angle + 1] == 0x7C]] = True    # added tokens begin with these two characters
    text_start = off[:-1][off[:-1] < len(buf)]
    s = kind != SPACE
    s[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    s[text_start] = kind[text_start] != SPACE
    mark = np.flatnonzero((buf == 0x27) & s)
    if len(mark):
        ends = off[np.searchsorted(off, mark, side="right")]
        padded = np.concatenate((low, np.zeros(3, np.uint8)))
        a, b = padded[mark + 1], padded[mark + 2]
        one = np.isin(a, list(ONE_LETTER)) & (mark + 1 < ends)
        two = np.any([(a == x[0]) & (b == x[1]) for x in TWO_LETTERS], axis=0) & (mark + 2 < ends)
        s[mark[one | two] + 1] = False
        for at in (mark[one] + 2, mark[two] + 3):
            at = at[at < len(s)]
            s[at] |= kind[at] != SPACE
    if odd.any():
        cs, ce, _ = find_words(buf, off, ~BLANK)
        chunk = np.unique(np.searchsorted(cs, np.flatnonzero(odd), side="right") - 1)
        inside = spread(cs[chunk], ce[chunk] - cs[chunk])
        s[inside] = False
        s[cs[chunk]] = True
        low[inside] = buf[inside]
        whole = cs[chunk]
    else:
        whole = np.zeros(0, np.int64)
    e = kind != SPACE
    e[:-1] &= s[1:] | (kind[1:] == SPACE)
    start, end = np.flatnonzero(s), np.flatnonzero(e) + 1
    alone = np.zeros(len(start), bool)
    alone[np.searchsorted(start, whole)] = True
    return low, start, end, alone


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of consecutive ranges ``[start, start + size)``."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(start - total + size, size)


def encoder(file) -> Encoder:
    """The worker's encoder of a broadcast vocabulary, kept from task to task."""
    kept = sys.modules.setdefault("quarry_word_tokens_kept", types.ModuleType("quarry_word_tokens_kept"))
    if getattr(kept, "file", None) != file.value:
        kept.file, kept.encoder = file.value, Encoder(file.value)
    return kept.encoder
