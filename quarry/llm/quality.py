"""Quality rules by repetition coverage (operator 7).

Rolling hashes of several n-gram lengths mark every n-gram that equals an earlier one of its
text; the share of a text's word characters inside such later copies, and inside lines that equal
an earlier line, decides. All windows of a slice of texts are hashed together in numpy; the text
number is mixed into each window hash, so windows match only inside their own text.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (BLANK, NON_BLANK, byte_class, cover, find_words, hash_words, inside, mix64,
                               per_text, repeats, rolling, seeds, slices, text_buffer)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
REPEAT_WINDOW = 3
# largest allowed share of word characters inside later copies of n-grams, by n
MAX_NGRAM_SHARE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
# largest allowed share of word characters inside lines that equal an earlier line
MAX_LINE_SHARE = 0.20
# word characters that later copies of n-grams may cover in any text: one full line that comes again
MIN_COVERED = 80
SYMBOLS = "#*$%&|<>"

NOT_NEWLINE = ~byte_class((0x0A, 0x0A))
SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))

RESULT = ("struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,"
          "line_share:double,ngram_share:array<double>>")


def _measure(arr: pa.Array, lengths: tuple[int, ...]) -> pa.Array:
    buf, off = text_buffer(arr)
    n = len(off) - 1
    start, end, first = find_words(buf, off, NON_BLANK)
    total = len(start)
    n_words = np.diff(first)
    points = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    word_chars = points[end] - points[start]
    chars = per_text(word_chars, first)
    salt = np.repeat(seeds(n, 11), n_words)
    h = hash_words(buf, start, end)

    def covered(k: int, later: bool) -> np.ndarray:
        keys = mix64(rolling(h, k) ^ salt[:max(0, total - k + 1)])
        ok = np.flatnonzero(inside(first, k, total))
        mark = np.zeros(len(keys), dtype=bool)
        mark[ok] = repeats(keys[ok])[int(later)]
        return cover(mark, k, total)

    repeat_words = per_text(covered(REPEAT_WINDOW, False), first)
    with np.errstate(invalid="ignore", divide="ignore"):
        shares = np.stack([np.nan_to_num(per_text(np.where(covered(k, True), word_chars, 0), first) / chars)
                           for k in lengths], axis=1) if lengths else np.zeros((n, 0))
        # lines: runs without a newline; only those with a word count
        ls, le, lfirst = find_words(buf, off, NOT_NEWLINE)
        has = np.searchsorted(start, le) > np.searchsorted(start, ls)
        lsalt = np.repeat(seeds(n, 13), np.diff(lfirst))
        later = np.zeros(len(ls), dtype=bool)
        keep = np.flatnonzero(has)
        later[keep] = repeats(mix64(hash_words(buf, ls[keep], le[keep]) ^ lsalt[keep]))[1]
        visible = np.concatenate(([0], np.cumsum(((buf & 0xC0) != 0x80) & ~BLANK[buf])))
        line_chars = np.where(later, visible[le] - visible[ls], 0)
        line_share = np.nan_to_num(per_text(line_chars, lfirst) / chars)
    symbols = per_text(SYMBOL[buf], off)
    flat = pa.array(shares.ravel(), pa.float64())
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(lengths), pa.int32()), flat)
    cols = [pa.array(n_words, pa.int64()), pa.array(chars, pa.int64()), pa.array(symbols, pa.int64()),
            pa.array(per_text(later, lfirst), pa.int64()), pa.array(repeat_words, pa.int64()),
            pa.array(line_share, pa.float64()), lists]
    return pa.StructArray.from_arrays(cols, ["n_words", "word_chars", "n_symbols", "n_dup_lines",
                                             "n_repeat_words", "line_share", "ngram_share"])


def repetition(text: Column, lengths: tuple[int, ...] = tuple(MAX_NGRAM_SHARE)) -> Column:
    """Struct of word counts and repetition shares of a text column (null: a text without words)."""

    @F.arrow_udf(RESULT)
    def measure(arr: pa.Array) -> pa.Array:
        parts = [_measure(arr[lo:hi], lengths) for lo, hi in slices(arr)]
        return pa.concat_arrays(parts) if parts else _measure(arr, lengths)

    return measure.asNondeterministic()(text)


def quality(docs: DataFrame, text: str = "text", out: str = "quality",
            ngram_share: dict[int, float] | None = None, line_share: float = MAX_LINE_SHARE,
            min_covered: int = MIN_COVERED) -> DataFrame:
    """Every row of ``docs`` (all columns kept) with a struct ``out`` of measures and verdict.

    ``base_failed``: under 50 words, or more than half of the words inside repeated 3-word windows.
    ``kept``: not base_failed, and the later copies of n-grams of every length and of lines stay
    within their share of the word characters, or those of n-grams cover at most ``min_covered``
    characters. A null, empty or blank text has no words and fails.
    Repeated rows are judged alike, row by row. A column of ``docs`` named ``out`` is replaced.
    """
    limits = dict(sorted((MAX_NGRAM_SHARE if ngram_share is None else ngram_share).items()))
    m = docs.withColumn(out, repetition(F.col(f"`{text}`"), tuple(limits)))
    q = F.col(f"`{out}`")
    failed = (q.n_words < MIN_WORDS) | (100 * q.n_repeat_words > MAX_REPEAT_PCT * q.n_words)
    good = q.line_share <= line_share
    for i, most in enumerate(limits.values()):
        # a share is a whole number of characters over another, so rounding gives that number again
        good = good & ((q.ngram_share[i] <= most) | (F.round(q.ngram_share[i] * q.word_chars) <= min_covered))
    return m.withColumn(out, q.withField("base_failed", failed).withField("kept", ~failed & good))
