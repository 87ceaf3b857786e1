"""Keyed running state over streams.

The reference's ``updateStateByKey`` keeps one value per key and re-emits every key each
batch. Here the state lives in Spark's state store (a streaming aggregate, checkpointed with
the query), each batch emits only the keys it changed (update mode), and the current table is read
from the state store itself, so neither depends on how many batches there were. Initial state comes
in as rows of the first batch.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from decimal import Context, Decimal

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.functions.text import sum_parts
from quarry.operators.text import explode_tokens
from quarry.session import path_exists
from quarry.streaming.runner import noop_sink, run_available, state_table, sum_buffers, summed

# the per-key functions below run in Python workers; ship them by value so the workers do not
# need this package installed (a user's own state function follows the usual rule: its module
# must be importable on the executors, e.g. through ``addPyFile``)
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def running_word_totals(lines: DataFrame, col: str = "value") -> DataFrame:
    """Streaming (or batch) cumulative count per word."""
    return explode_tokens(lines, col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def running_sums(df: DataFrame, keys: list[str], value: str, out: str = "total", scale: int = 10) -> DataFrame:
    """Cumulative exact sum per key."""
    exact, rest = sum_parts(value, scale)
    return df.groupBy(*keys).agg((exact.cast("double") + rest).alias(out))


def with_seeds(stream: DataFrame, seed: DataFrame, path: str) -> DataFrame:
    """``stream`` with the rows of ``seed`` (same columns) in its first micro-batch, as an
    ``updateStateByKey`` with an initial RDD has them: they count once, their keys are in the state and
    in the first output even if no input ever has them, and a restarted query does not read them again
    (the file source's log is part of the checkpoint). ``path`` is a folder for the seed, the same at
    every start."""
    spark = stream.sparkSession
    rows = seed.select(*(F.col(f.name).cast(f.dataType) for f in stream.schema))
    if not path_exists(spark, path):
        rows.write.parquet(path)
    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(path))


def seeded_word_totals(lines: DataFrame, seed: DataFrame, path: str, col: str = "value") -> DataFrame:
    """``running_word_totals`` that starts from ``seed`` (``word, count``)."""
    words = explode_tokens(lines, col).select("word", F.lit(1).cast("long").alias("count"))
    return with_seeds(words, seed, path).groupBy("word").agg(F.sum("count").alias("count"))


def run_counts(spark: SparkSession, totals: DataFrame, checkpoint: str,
               sink: Callable[[DataFrame, int], None] = noop_sink) -> DataFrame:
    """Run a streaming count (or sum of longs) per key to the end; the current table, from the state.
    ``sink`` gets the changed keys of every batch."""
    run_available(totals, sink, checkpoint, mode="update")
    value = totals.columns[-1]
    return state_table(spark, checkpoint, f"`{value}` long")


def run_sums(spark: SparkSession, sums: DataFrame, checkpoint: str, scale: int = 10,
             sink: Callable[[DataFrame, int], None] = noop_sink) -> DataFrame:
    """Run ``running_sums`` of a stream to the end; the current table, from the state."""
    run_available(sums, sink, checkpoint, mode="update")
    return current_sums(spark, sums.columns, checkpoint, scale)


def current_sums(spark: SparkSession, columns: list[str], checkpoint: str, scale: int = 10, batch: int | None = None) -> DataFrame:
    """The table of ``running_sums`` with these ``columns``, from its state."""
    return state_table(spark, checkpoint, sum_buffers(scale), batch).select(*columns[:-1], summed().alias(columns[-1]))


def combine_in_partitions(df: DataFrame, combine: Callable[[pd.DataFrame], pd.DataFrame],
                          merge: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Map-side combine ahead of a state operator: ``combine`` folds each Arrow batch of raw rows
    to one partial row per key, ``merge`` folds these into the partition's partials whenever they are as
    many, so about two rows per key are held and each is merged a few times, however many batches a
    partition has. It is stateless
    (``mapInPandas``), so a stream may run it before ``applyInPandasWithState``; a hot key then
    reaches its state task with one row per input partition and micro-batch, not all its rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held, new = [], 0, 0
        for b in batches:
            if len(b):
                parts.append(combine(b))
                new += len(parts[-1])
                if len(parts) > 1 and new >= held:
                    parts = [merge(pd.concat(parts, ignore_index=True))]
                if len(parts) == 1:
                    held, new = len(parts[0]), 0
        if len(parts) > 1:
            parts = [merge(pd.concat(parts, ignore_index=True))]
        yield from parts
    return df.mapInPandas(run, schema)


def keyed_state(df: DataFrame, key: str, fn: Callable[[object, pd.DataFrame, object], object],
                out_schema: str, state_schema: str, mode: str = "update",
                partial: tuple[Callable, Callable, str] | None = None) -> DataFrame:
    """Hook for a user's own per-key state function.

    ``fn(key, rows, old_state) -> (new_state, out_rows)``; ``old_state`` is a tuple or None. A key's
    rows of one micro-batch come in Arrow chunks: ``fn`` is called once per chunk with the state of
    the call before, so no more than a chunk is held, and the last call's ``out_rows`` are emitted.
    ``partial = (combine, merge, schema)`` pre-aggregates in every input partition first (see
    ``combine_in_partitions``); ``fn`` then gets the partial rows. Use it whenever the state
    update is associative: without it all of a key's rows in a batch go through one task.
    """
    def step(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, out = (state.get if state.exists else None), None
        for rows in pdfs:
            held, out = fn(k[0], rows, held)
        if out is not None:
            state.update(held)
            yield out
    if partial is not None:
        df = combine_in_partitions(df, *partial)
    return df.groupBy(key).applyInPandasWithState(step, out_schema, state_schema, mode,
                                                  GroupStateTimeout.NoTimeout)


# Example state function with its map-side combine: running totals per user as decimal texts,
# exact in any batch order and any split of a batch into partials. Null values add nothing.
DIGITS = 700     # enough for every sum of doubles


def exact_total(amounts) -> Decimal:
    ctx, total = Context(prec=DIGITS, traps=[]), Decimal(0)
    for x in amounts:
        total = ctx.add(total, Decimal(x))
    return total


def amount_partial(rows: pd.DataFrame) -> pd.DataFrame:
    amounts = rows["value"].map(lambda v: "0" if pd.isna(v) else repr(float(v)))
    return amount_merge(pd.DataFrame({"user_id": rows["user_id"], "amount": amounts}))


def amount_merge(partials: pd.DataFrame) -> pd.DataFrame:
    codes, users = pd.factorize(partials["user_id"], use_na_sentinel=False)
    ctx, totals = Context(prec=DIGITS, traps=[]), [Decimal(0)] * len(users)
    for i, x in zip(codes.tolist(), partials["amount"]):
        totals[i] = ctx.add(totals[i], Decimal(x))
    return pd.DataFrame({"user_id": users, "amount": [str(t) for t in totals]})


AMOUNT_PARTIAL = (amount_partial, amount_merge, "user_id long, amount string")


def amount_total(key, rows: pd.DataFrame, old):
    """Example state function over ``AMOUNT_PARTIAL`` rows: running total per user."""
    total = exact_total([old[0] if old else "0", *rows["amount"]])
    return (str(total),), pd.DataFrame({"user_id": [key], "total": [float(total)]})
