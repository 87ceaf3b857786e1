"""Corpus pipeline: quality rules, near-dedup, benchmark decontamination, secret scan, source mix.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` that judges its own input. Its result
is written as Parquet and read back as the next stage's ``docs``. All stages but the last return the
columns they got; the last adds ``copies`` (how often the mix takes the row), ``size`` (words) and
``target`` (words its source should give).

No stage needs ids to be unique or columns to be free of nulls; each operator's docstring says what
becomes of null ids, null and empty texts and repeated rows. Empty tables pass through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import documents, free_name, saved
from quarry.llm.decontaminate import contamination
from quarry.llm.mixing import take
from quarry.llm.near_dedup import deduplicate
from quarry.llm.quality import quality
from quarry.llm.secrets import redact, scan

#: The secret battery, the quality verdict and the banded near-duplicates are not SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    out = free_name(docs, "quality")
    return quality(docs, out=out).where(F.col(f"{out}.kept")).select(*(F.col(f"`{c}`") for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates by five words."""
    return deduplicate(docs, shingle_words=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    out = free_name(docs, "hits")
    hit = contamination(docs, items, out=out)
    return hit.where(~F.col(f"{out}.contaminated")).select(*(F.col(f"`{c}`") for c in docs.columns))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in ``text``; ``n_chars`` follows the new text."""
    out = free_name(docs, "spans")
    found = scan(docs, out=out)
    found = found.withColumn("text", redact(F.col("text"), F.col(out)))
    if "n_chars" in docs.columns:
        masked = F.size(out) > 0
        found = found.withColumn("n_chars", F.when(masked, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(*(F.col(f"`{c}`") for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes at least once, with ``copies``, ``size`` and ``target``."""
    return take(docs)


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("decontaminate", decontaminate),
          ("secret scan", secret_scan), ("mix sources", mix_sources)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
