"""String helpers expressed as Catalyst expressions (no Python in the row path).

``tokens`` reproduces Java ``String.split(sep)`` on a one-character separator: trailing empty
pieces are dropped, inner and leading ones are kept, an empty line gives one empty token and a
line made only of separators gives none. Spark's ``split`` keeps trailing empties, so they are
stripped first.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_REGEX_META = set(".$|()[]{}^?*+\\")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def regex_literal(sep: str) -> str:
    """Escape a literal separator for a Java regular expression."""
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in sep)


def strip_trailing(col, sep: str = " ") -> Column:
    """Remove every trailing run of ``sep`` (anchored at the absolute end of the string)."""
    return F.regexp_replace(_c(col), f"(?:{regex_literal(sep)})+\\z", "")


def tokens(col, sep: str = " ") -> Column:
    """Split with Java ``String.split`` semantics; returns ``array<string>``."""
    c = _c(col)
    # the regex runs only on lines that end with the separator
    stripped = F.when(c.endswith(sep), strip_trailing(c, sep)).otherwise(c)
    empty = F.array().cast("array<string>")
    return (F.when(c == "", F.array(F.lit("")))
             .when(stripped == "", empty)
             .otherwise(F.split(stripped, regex_literal(sep), -1)))


def lines(col) -> Column:
    """Split a text into lines the way a Hadoop text-file reader does: ``\\r\\n``, ``\\r`` and
    ``\\n`` all end a line, a final terminator does not open another (empty) line, and an
    empty text has no lines."""
    c = _c(col)
    ends = c.endswith("\n") | c.endswith("\r")
    body = F.when(ends, F.regexp_replace(c, "(?:\r\n|\r|\n)\\z", "")).otherwise(c)
    # texts without a carriage return take the single-character split (no regex engine)
    split = F.when(c.contains("\r"), F.split(body, "\r\n|\r|\n", -1)).otherwise(F.split(body, "\n", -1))
    return F.when(c == "", F.array().cast("array<string>")).otherwise(split)


#: type of the exact part of one value, and of sums of them: any value below 10^18 within 10 decimals,
#: and 10^10 rows of them without overflow
EXACT_VALUE, EXACT = "decimal(28,10)", "decimal(38,10)"


def exact_part(col, scale: int = 10) -> Column:
    """What a double has within ``scale`` decimals, as a decimal; 0 for values of 10^(28 - scale) and more,
    infinities and NaN, null for null."""
    c = _c(col).cast("double")
    kind = f"decimal(28,{scale})"
    return F.when(c.isNotNull(), F.coalesce(c.try_cast(kind), F.lit(0).cast(kind)))


def sum_parts(col, scale: int = 10) -> tuple[Column, Column]:
    """Two aggregates that add up to the sum of a double column: what the values have within ``scale``
    decimals, without error and whatever the row order, and the rest of them (nothing, for values of at
    most ``scale`` decimals below 10^(28 - scale)) as a double. Nothing is refused or rounded away."""
    part = exact_part(col, scale)
    return F.sum(part), F.sum(_c(col).cast("double") - part.cast("double"))


def exact_sum(col, scale: int = 10) -> Column:
    """Sum of a double column, as double; see ``sum_parts``."""
    exact, rest = sum_parts(col, scale)
    return exact.cast("double") + rest


def weighted_parts(cols, weights) -> tuple[Column, Column]:
    """Weighted sum of one row, ``sum(col_i * w_i)``, in two parts: exact, of what the values have within 10
    decimals and with all the digits that the weights are given with, and the rest as a double."""
    exact = rest = None
    for col, w in zip(cols, weights):
        part = exact_part(col)
        e, r = part * F.lit(Decimal(str(w))), (_c(col).cast("double") - part.cast("double")) * F.lit(float(w))
        exact, rest = (e, r) if exact is None else (exact + e, rest + r)
    return exact, rest


def weighted_score(cols, weights) -> Column:
    """Weighted sum of one row as a double, rounded once where 10 decimals hold the values; any double
    counts (NaN and infinities give what doubles give)."""
    exact, rest = weighted_parts(cols, weights)
    return exact.cast("double") + rest


def weighted_total(cols, weights) -> Column:
    """Aggregate: the sum of ``weighted_score`` over a group without its roundings. Columns are summed
    first and weighted once per group; a row with a null among the columns does not count."""
    whole = None
    for col in cols:
        ok = _c(col).isNotNull()
        whole = ok if whole is None else whole & ok
    exact = rest = None
    for col, w in zip(cols, weights):
        e, r = sum_parts(F.when(whole, _c(col).cast("double")))
        e, r = e * F.lit(Decimal(str(w))), r * F.lit(float(w))
        exact, rest = (e, r) if exact is None else (exact + e, rest + r)
    return exact.cast("double") + rest
