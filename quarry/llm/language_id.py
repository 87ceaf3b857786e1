"""Language identification by rank-order n-gram profiles (operator 1).

A language's profile is the list of its most frequent letter n-grams in rank order. A document's
own list is compared with every profile by the out-of-place distance: how far each of its n-grams
stands from its place in the profile, the profile's length when it is missing there. The closest
profile wins. Texts are folded to lower-case letters with one blank between words; n-grams run over
word edges but not across words.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import mix64, slices, text_buffer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROFILE = 300                 # n-grams of a profile and of a document's list
LENGTHS = (1, 2, 3)
UNKNOWN = "und"
BLANK_CODE = 0x110000         # one past the last code point
MAX_TEXTS = 1 << 13           # texts handled together
GRAM_BITS = 50


def folded(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased letters of all texts, every run of other characters as one
    ``BLANK_CODE``, one more before each text; and the offsets of the texts."""
    buf, off = text_buffer(arr)
    points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), dtype="<u4")
    at = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))[off]
    used = np.flatnonzero(np.bincount(points)) if len(points) else np.zeros(0, np.int64)
    table = np.full((int(used[-1]) if len(used) else 0) + 1, BLANK_CODE, dtype=np.int64)
    for p in used:                                       # only characters that occur
        low = chr(p).lower()
        if chr(p).isalpha():
            table[p] = ord(low) if len(low) == 1 else p
    x = np.insert(table[points], at[:-1], BLANK_CODE)
    at = at + np.arange(len(at))
    blank = x == BLANK_CODE
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[at[:-1]] = True
    return x[keep], np.concatenate(([0], np.cumsum(keep)))[at]


def grams(x: np.ndarray, off: np.ndarray, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Code of every n-gram (21 bits a symbol) and the text it is in."""
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    codes, docs = [], []
    for n in lengths:
        m = max(0, len(x) - n + 1)
        code = np.zeros(m, dtype=np.int64)
        for j in range(n):
            code = code << 21 | x[j:j + m]
        ok = doc[:m] == doc[n - 1:n - 1 + m]
        for j in range(1 if n > 1 else 0, n - 1 if n > 1 else 1):   # blanks only at the ends
            ok &= x[j:j + m] != BLANK_CODE
        codes.append(code[ok])
        docs.append(doc[:m][ok])
    return np.concatenate(codes), np.concatenate(docs)


def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each occurs."""
    at = np.flatnonzero(np.concatenate((np.ones(min(1, len(x)), bool), x[1:] != x[:-1])))
    return x[at], np.diff(np.concatenate((at, [len(x)])))


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", size: int = PROFILE,
          lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """Profiles ``(lang, gram, n, place)`` of the non-null languages of ``docs``: the ``size`` most
    frequent n-grams of each, counted over all texts (ties by n-gram code)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[str, list] = {}
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                x, off = folded(part.column("text"))
                code, doc = grams(x, off, lengths)
                names, which = np.unique(np.array(part.column("lang").to_pylist(), dtype=object).astype(str),
                                         return_inverse=True)
                for k, name in enumerate(names):
                    total.setdefault(name, []).append(runs(np.sort(code[which[doc] == k])))
            for name, found in total.items():
                code = np.concatenate([c for c, _ in found])
                n = np.concatenate([m for _, m in found])
                order = np.argsort(code, kind="stable")
                code, n = code[order], n[order]
                if len(code):
                    first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(first)), pa.array(code[first]), pa.array(np.add.reduceat(n, first))],
                        ["lang", "gram", "n"])

    rows = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).where(
        "lang is not null and text is not null")
    counts = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.withColumn("place", place).where(F.col("place") <= size)


def _classify(arr: pa.Array, names: list[str], known: np.ndarray, places: np.ndarray, size: int,
              lengths: tuple[int, ...]) -> tuple[list, np.ndarray]:
    x, off = folded(arr)
    letters = np.concatenate(([0], np.cumsum(x != BLANK_CODE)))[off]
    code, doc = grams(x, off, lengths)
    gram = (mix64(code.view(np.uint64)) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)
    key, n = runs(np.sort(doc << GRAM_BITS | gram))
    # order inside a text: most frequent first, then by gram. Where the counts fit, one packed key sorts
    # faster; the order is the same
    top = (1 << 20) - 1
    if len(n) and n.max() > top:
        rank = np.lexsort((np.arange(len(key)), -n, key >> GRAM_BITS))
        owner = (key >> GRAM_BITS)[rank]
    else:
        rank = np.sort((key >> GRAM_BITS) << 50 | (top - n) << 30 | np.arange(len(key)))
        owner, rank = rank >> 50, rank & ((1 << 30) - 1)
    place = np.arange(len(rank)) - np.searchsorted(owner, owner)
    best = place < size
    owner, place = owner[best], place[best]
    gram = key[rank[best]] & ((1 << GRAM_BITS) - 1)
    at = np.searchsorted(known, gram)
    at[at == len(known)] = 0
    there = known[at] == gram
    docs = len(off) - 1
    used = np.bincount(owner, minlength=docs)
    dist = np.stack([np.bincount(owner, np.where(there & (p[at] < size), np.abs(p[at] - place), size), docs)
                     for p in places])
    choice = dist.argmin(axis=0)
    some = np.diff(letters) > 0
    score = np.where(some, 1 - dist[choice, np.arange(docs)] / np.maximum(1, used * size), 0.0)
    return [names[c] if s else UNKNOWN for c, s in zip(choice, some)], score


def classify(profiles: list, text: Column, size: int = PROFILE, lengths: tuple[int, ...] = LENGTHS) -> Column:
    """Struct ``(lang, score)`` of a text column. ``profiles``: collected rows of ``learn``."""
    names = sorted({r["lang"] for r in profiles})
    codes = np.array(sorted({r["gram"] for r in profiles}), dtype=np.int64)
    hashed = (mix64(codes.view(np.uint64)) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)
    order = np.argsort(hashed)
    known = hashed[order]
    column = {int(codes[o]): i for i, o in enumerate(order)}
    places = np.full((len(names), len(known)), size, dtype=np.int64)        # size: not in the profile
    for r in profiles:
        places[names.index(r["lang"]), column[r["gram"]]] = r["place"] - 1

    @F.arrow_udf("struct<lang:string,score:double>")
    def identify(arr: pa.Array) -> pa.Array:
        langs, scores = [], [np.zeros(0)]
        for lo, hi in slices(arr):
            for a in range(lo, hi, MAX_TEXTS):
                part = arr[a:min(hi, a + MAX_TEXTS)]
                if len(known):
                    lang, score = _classify(part, names, known, places, size, lengths)
                else:
                    lang, score = [UNKNOWN] * len(part), np.zeros(len(part))
                langs += lang
                scores.append(score)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(scores))],
                                          ["lang", "score"])

    return identify.asNondeterministic()(text)


def identify_languages(docs: DataFrame, training: DataFrame, lang: str = "lang", text: str = "text",
                       out: str = "language", size: int = PROFILE, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """Every row of ``docs`` (all columns kept) with a struct ``out`` of ``lang`` and ``score`` (0 to 1,
    1: every n-gram in its place), from profiles learned on ``training``.

    What reaches the driver is ``size`` rows per language name. Null, empty and letterless texts are
    ``und`` with score 0, and so is everything when ``training`` names no language. Equal distances
    go to the name that sorts first; repeated rows are classified alike. A column of ``docs`` named
    ``out`` is replaced.
    """
    profiles = learn(training, lang, text, size, lengths).collect()
    return docs.withColumn(out, classify(profiles, F.col(f"`{text}`"), size, lengths))
