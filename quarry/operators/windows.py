"""Time-window statistics per key: tumbling, sliding and windows over windowed results.

Rows are aggregated once, into panes as long as the slide; longer windows are put together from
panes. ``panes``, ``tumbling`` and the ``stream_*`` forms take a batch or a streaming DataFrame,
``sliding`` and ``from_panes`` a batch. Sums are exact within 10 decimals and the average divides
last, so results do not depend on the order in which rows reach the aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import EXACT, sum_parts


def seconds(duration: str) -> int:
    """Length of ``"30 seconds"``, ``"5 minutes"`` ... in whole seconds."""
    n, unit = duration.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def panes(df: DataFrame, ts: str, slide: str, keys: list[str], value: str) -> DataFrame:
    """``keys, pane, exact, rest, cnt``: sums (see ``sum_parts``) and count per key and pane start."""
    agg = pane_totals(df, ts, slide, keys, value)
    return agg.select(*keys, F.col("window.start").alias("pane"), "exact", "rest", "cnt")


def pane_totals(df: DataFrame, ts: str, slide: str, keys: list[str], value: str) -> DataFrame:
    """The aggregate behind ``panes``, with the window as a column; a stream keeps it as its state."""
    exact, rest = sum_parts(value)
    return df.groupBy(*keys, F.window(ts, slide)).agg(exact.alias("exact"), rest.alias("rest"),
                                                      F.count(F.lit(1)).alias("cnt"))


def _statistics(df: DataFrame, keys: list[str], start, end) -> DataFrame:
    total = F.col("exact").cast("double") + F.col("rest")
    return df.select(*keys, start.alias("window_start"), end.alias("window_end"), total.alias("sum"), "cnt",
                     (total / F.col("cnt")).alias("avg"))


def tumbling(df: DataFrame, ts: str, duration: str, keys: list[str], value: str) -> DataFrame:
    """Sum, count and average per key per fixed window of ``duration``."""
    return _statistics(pane_totals(df, ts, duration, keys, value), keys, F.col("window.start"), F.col("window.end"))


def sliding(df: DataFrame, ts: str, duration: str, slide: str, keys: list[str], value: str) -> DataFrame:
    """Sum, count and average per key per window of ``duration`` starting every ``slide``; every row is
    aggregated once, whatever the number of windows it lies in."""
    return from_panes(panes(df, ts, slide, keys, value), duration, slide, keys)


def from_panes(p: DataFrame, duration: str, slide: str, keys: list[str]) -> DataFrame:
    """Windows of ``duration`` every ``slide`` from panes of ``slide``: each pane is added to the windows it
    lies in, by a partial and final aggregate, so a hot key is spread over many tasks. (A range frame
    over the panes, which moves each pane once, took twice the time.)"""
    step, length = seconds(slide), seconds(duration)
    if length % step:
        raise ValueError(f"{duration} is not a multiple of {slide}")
    starts = F.array(*(F.col("pane") - F.expr(f"INTERVAL {back} SECONDS") for back in range(0, length, step)))
    rows = p.select(*keys, F.explode(starts).alias("window_start"), "exact", "rest", "cnt").groupBy(*keys, "window_start").agg(
        F.sum("exact").cast(EXACT).alias("exact"), F.sum("rest").alias("rest"), F.sum("cnt").alias("cnt"))
    return _statistics(rows, keys, F.col("window_start"), F.col("window_start") + F.expr(f"INTERVAL {length} SECONDS"))


def composed(windowed: DataFrame, duration: str, slide: str, keys: list[str]) -> DataFrame:
    """Window over already windowed results: adds up the ``sum`` and ``cnt`` of the inner
    windows whose end falls in each outer window (``window_time`` = inner end - 1 us).

    With inner 30 s / 5 s and outer 10 s / 5 s this is S(t) + S(t - 5 s), the reference's
    "last 60 seconds" as coded.
    """
    inner_time = F.col("window_end") - F.expr("INTERVAL 1 MICROSECOND")
    exact, rest = sum_parts("sum")
    agg = windowed.groupBy(*keys, F.window(inner_time, duration, slide)).agg(
        exact.alias("exact"), rest.alias("rest"), F.sum("cnt").alias("cnt"))
    return _statistics(agg, keys, F.col("window.start"), F.col("window.end"))


def stream_composed(df: DataFrame, ts: str, inner: str, outer: str, slide: str, keys: list[str], value: str) -> DataFrame:
    """``composed(sliding(...))`` as one streaming query: panes, inner windows over the panes and outer
    windows over the inner ones are chained stateful operators, each closing its windows behind the
    watermark of ``df`` (append mode). The last windows close when the watermark passes them."""
    w = "window"
    p = pane_totals(df, ts, slide, keys, value)

    def add(x: DataFrame, duration: str) -> DataFrame:
        return x.groupBy(*keys, F.window(F.window_time(w), duration, slide)).agg(
            F.sum("exact").cast(EXACT).alias("exact"), F.sum("rest").alias("rest"), F.sum("cnt").alias("cnt"))

    return _statistics(add(add(p, inner), outer), keys, F.col("window.start"), F.col("window.end"))


def stream_sum_join_count(a: DataFrame, b: DataFrame, ts: str, duration: str, keys: list[str], value: str) -> DataFrame:
    """Sums of stream ``a`` and counts of stream ``b`` per key and window, joined on both: a stream-stream
    join of two windowed aggregates (append mode; both need a watermark)."""
    exact, rest = sum_parts(value)
    sums = a.groupBy(*keys, F.window(ts, duration)).agg(exact.alias("exact"), rest.alias("rest"))
    counts = b.groupBy(*keys, F.window(ts, duration)).agg(F.count(F.lit(1)).alias("cnt"))
    both = sums.join(counts, [*keys, "window"])
    return _statistics(both, keys, F.col("window.start"), F.col("window.end"))
