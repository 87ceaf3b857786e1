"""Registry of named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the shared tables (or data Spark derives from them) in full; the oracle SQL
for the same name lives in ``quarry.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        return fn
    return deco


def all_queries() -> dict[str, QueryFn]:
    # importing the modules fills QUERIES
    from quarry.plans import (idset_queries, relational_queries, store_queries, text_queries,  # noqa: F401
                              stream_queries, window_graph_queries)
    return dict(QUERIES)
