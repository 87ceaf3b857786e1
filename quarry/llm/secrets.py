"""Secret scan (operator 9): fixed credential patterns plus a randomness test battery.

The battery looks at every maximal token of ``[A-Za-z0-9+/_=-]``, cut where ``=`` is no trailing
padding, of at least ``MIN_TOKEN`` characters. A token that no single alphabet holds, or that is not
random as a whole, is cut at ``-_``, at ``+/`` and at both, and its parts of that length are tested. Its encoding (hex, base 32, base 36, base 62, base 64) is inferred from the characters
it uses. Three tests ask whether it could be uniform over that alphabet: chi-squared of the
symbol counts, runs above / below the middle symbol, and lag-1 serial correlation. A second
p-value asks the opposite: how likely ordinary text of that length is to look this even. It falls
with the token's length, and the Benjamini-Hochberg step-up rule over all tokens of a text,
weighted by length, holds the expected share of false finds below ``FDR``.
"""

from __future__ import annotations

import math
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, byte_class, find_words, slices, text_buffer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("assign", "access", "hex", "random")
# The three base patterns and the shortest match that counts.
ASSIGN = (r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
          r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")

MIN_TOKEN = 20
FDR = 0.01          # expected share of ordinary tokens among the reported ones
ALPHA = 0.001       # a uniform token fails one of the three uniformity tests this rarely

HEX_RUN = byte_class((0x30, 0x39), (0x61, 0x66))
TOKEN_RUN = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x2B, 0x2B), (0x2F, 0x2F), (0x5F, 0x5F),
                       (0x3D, 0x3D), (0x2D, 0x2D))
# Relative frequency of a to z in European prose, in percent.
LETTER_PCT = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.2, 0.8, 4.0, 2.4,
              6.7, 7.5, 1.9, 0.1, 6.0, 6.3, 9.1, 2.8, 1.0, 2.4, 0.2, 2.0, 0.1)
DIGITS, UPPER, LOWERS = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# inferred encodings, narrowest first: name and alphabet
ENCODINGS = (("hex", DIGITS + "abcdef"), ("HEX", DIGITS + "ABCDEF"), ("base32", UPPER + "234567"),
             ("base36", DIGITS + LOWERS), ("BASE36", DIGITS + UPPER), ("base62", UPPER + LOWERS + DIGITS),
             ("base64", UPPER + LOWERS + DIGITS + "+/"), ("base64url", UPPER + LOWERS + DIGITS + "-_"))


def tail(z: float) -> float:
    """Upper tail of the standard normal distribution."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi2_tail(x: float, df: int) -> float:
    """Upper tail of chi-squared by the Wilson-Hilferty cube-root approximation."""
    c = 2.0 / (9.0 * df)
    return tail(((max(x, 0.0) / df) ** (1 / 3) - (1 - c)) / math.sqrt(c))


def plain_excess(alphabet: str) -> float:
    """Per-character chi-squared excess of prose over this alphabet: ``k * sum(q^2) - 1``."""
    weight = [0.02 if ch in DIGITS else 0.0 if not ch.isalpha()
              else LETTER_PCT[LOWERS.index(ch.lower())] / 100 * (0.1 if ch in UPPER and "a" in alphabet else 1)
              for ch in alphabet]
    total = sum(weight)
    return len(alphabet) * sum((w / total) ** 2 for w in weight) - 1


def infer(token: str) -> tuple[str, str] | None:
    """The narrowest encoding whose alphabet holds the token (``=`` padding apart)."""
    used = set(token.rstrip("="))
    for name, alphabet in ENCODINGS:
        if used and used <= set(alphabet):
            return name, alphabet
    return None


def battery(token: str) -> dict | None:
    """Test results of one token: encoding, the three uniformity p-values and ``p_plain``, the
    chance that ordinary text of this length is at least as even. None: no encoding fits."""
    found = infer(token)
    if found is None:
        return None
    name, alphabet = found
    body = token.rstrip("=")
    k, n = len(alphabet), len(body)
    at = np.array([alphabet.index(c) for c in body])
    counts = np.bincount(at, minlength=k)
    chi2 = float(((counts - n / k) ** 2).sum() * k / n)
    high = at >= k / 2
    n1, n2 = int(high.sum()), int(n - high.sum())
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 2 * n1 * n2 / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1) if n > 1 else 0.0
    # a token on one side of the middle: as unlikely as n equal coin flips
    p_runs = 2 * tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 2.0 ** (1 - n)
    x = at - at.mean()
    ss = float((x * x).sum())
    r = float((x[1:] * x[:-1]).sum()) / ss if ss > 0 else 1.0
    p_serial = 2 * tail(abs(r + 1 / n) * math.sqrt(n))
    excess = plain_excess(alphabet)
    spread = math.sqrt(2 * (k - 1) + 4 * n * excess)
    p_plain = tail((k - 1 + n * excess - chi2) / spread)
    # mixing letters and digits is itself rare in prose: each switch counts as independent evidence
    kind = [c.isdigit() for c in body]
    switches = sum(a != b for a, b in zip(kind, kind[1:]))
    return {"encoding": name, "p_chi2": chi2_tail(chi2, k - 1), "p_runs": min(1.0, p_runs),
            "p_serial": min(1.0, p_serial), "p_plain": p_plain * 0.2 ** min(switches, 8)}


def pieces(text: str, start: int, end: int, padded: bool = True) -> list[tuple[int, int, str]]:
    """Stretches of ``text[start:end]`` without an inner ``=`` that are long enough to test;
    ``padded``: a ``=`` at the end belongs to the last."""
    return [(start + m.start(), start + m.end(), m.group())
            for m in re.finditer(r"[^=]+(?:=+\Z)?" if padded else r"[^=]+", text[start:end]) if len(m.group()) >= MIN_TOKEN]


def parts(start: int, token: str) -> list[tuple[int, int, str]]:
    """Parts of a token, cut at either pair of separators or at both, that are long enough to test,
    the token itself apart."""
    return sorted({(start + m.start(), start + m.end(), m.group()) for cut in (r"[^_-]+", r"[^+/]+", r"[^+/_-]+")
                   for m in re.finditer(cut, token) if MIN_TOKEN <= len(m.group()) < len(token)})


def random_tokens(found: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Spans of one text's tokens, or else of their parts, that pass the uniformity tests and survive
    the length-weighted Benjamini-Hochberg rule."""
    tested = []

    def test(s: int, e: int, tok: str) -> bool:
        b = battery(tok)
        if b is None:
            return False
        uniform = min(b["p_chi2"], b["p_runs"], b["p_serial"]) >= ALPHA / 3
        tested.append((s, e, b["p_plain"] if uniform else 1.0))
        return tested[-1][2] <= FDR

    for s, e, tok in found:
        if not test(s, e, tok):
            for part in parts(s, tok):
                test(*part)
    if not tested:
        return []
    length = np.array([e - s for s, e, _ in tested], dtype=float)
    p = np.array([t[2] for t in tested]) / (length / length.mean())
    order = np.argsort(p, kind="stable")
    ok = np.flatnonzero(p[order] <= FDR * np.arange(1, len(p) + 1) / len(p))
    keep = order[:ok[-1] + 1] if len(ok) else order[:0]
    spans = sorted(((tested[i][0], tested[i][1]) for i in keep), key=lambda x: (x[0], -x[1]))
    out: list[tuple[int, int]] = []
    for s, e in spans:                                  # parts of several cuts may overlap
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """All spans of one text as ``(start, kind index, end)`` in code points, sorted."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m.group(2)) >= MIN_ASSIGN]
    out += [(m.start(), 1, m.end()) for m in re.finditer(ACCESS, text) if m.end() - m.start() >= MIN_ACCESS]
    # a greedy run is maximal, so runs that are too short can be left out of the pattern itself
    out += [(m.start(), 2, m.end()) for m in re.finditer(f"(?<![0-9a-f])[0-9a-f]{{{MIN_HEX},}}", text)]
    base = sorted((s, e) for s, _, e in out)
    tokens, k = [], 0
    for m in re.finditer(f"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}", text):
        while k < len(base) and base[k][1] <= m.start():
            k += 1
        at, i = m.start(), k                            # what of the token lies outside the base spans
        while i < len(base) and base[i][0] < m.end():
            tokens += pieces(text, at, max(at, base[i][0]), padded=False)
            at, i = max(at, base[i][1]), i + 1
        tokens += pieces(text, at, max(at, m.end()))
    out += [(s, 3, e) for s, e in random_tokens(tokens)]
    return sorted(out)


def _candidates(arr: pa.Array) -> np.ndarray:
    """Rows that can hold a span: a long run, an access prefix or a keyword."""
    buf, off = text_buffer(arr)
    n = len(off) - 1
    hit = np.zeros(n, dtype=bool)
    for cls, least in ((HEX_RUN, MIN_HEX), (TOKEN_RUN, MIN_TOKEN)):
        s, e, first = find_words(buf, off, cls)
        long = np.flatnonzero(e - s >= least)
        hit[np.searchsorted(first, long, side="right") - 1] = True
    raw, low = buf.tobytes(), LOWER[buf].tobytes()
    for hay, needle in [(raw, b"AKIA"), *((low, k) for k in KEYWORDS)]:
        at = hay.find(needle)
        while at >= 0:
            row = int(np.searchsorted(off, at, side="right")) - 1
            hit[row] = True
            at = hay.find(needle, int(off[row + 1]))      # on to the next text
    return hit


def _scan(arr: pa.Array) -> pa.Array:
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(arr))]
    for lo, hi in slices(arr):
        part = arr[lo:hi]
        for i in np.flatnonzero(_candidates(part)):
            t = part[int(i)].as_py()
            found[lo + int(i)] = spans_of(t) if t else []
    return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in found],
                    pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))


def secret_spans(text: Column) -> Column:
    """Array of ``(kind, start, end)`` per text: code points, end exclusive, by start then kind."""
    udf = F.arrow_udf(_scan, "array<struct<kind:string,start:int,end:int>>")
    return udf.asNondeterministic()(text)


def scan(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Every row of ``docs`` (all columns kept) with its secret spans in ``out``.

    Base kinds, leftmost and non-overlapping each: ``assign``, ``access``, ``hex``. ``random``
    marks tokens of the test battery, or what of them lies outside the base spans. Null and empty texts have no spans;
    repeated rows are scanned alike. A column of ``docs`` named ``out`` is replaced.
    """
    return docs.withColumn(out, secret_spans(F.col(f"`{text}`")))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every (possibly overlapping) span replaced by ``mask`` once. ``spans`` are sorted
    by start, as ``scan`` gives them; null texts stay null."""
    def step(acc: Column, s: Column) -> Column:
        upto = F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], upto).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cut = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))
    return F.when(F.size(spans) > 0, cut).otherwise(text)
