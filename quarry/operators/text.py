"""Text operators: line scans, token counts, delimited records.

All of them are explode + hash aggregate plans. A word that holds a third of all tokens is
pre-aggregated in every map task (partial aggregation) before the shuffle, so the hot key
costs one row per task, not one row per occurrence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import lines, tokens


def text_file(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files under ``path`` as ``value`` (the text-line scan)."""
    return spark.read.text(path)


def document_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line of each document: ``(doc_id, line_no, line)``, line_no 0-based."""
    return docs.select(id_col, F.posexplode(lines(text_col)).alias("line_no", "line"))


def explode_tokens(df: DataFrame, col: str = "line", sep: str = " ", out: str = "word",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per token of ``col`` split with Java ``split`` semantics."""
    return df.select(*keep, F.explode(tokens(col, sep)).alias(out))


def token_count(df: DataFrame, col: str = "line", sep: str = " ", out: str = "word") -> DataFrame:
    """``(token, count)``; empty tokens are counted like any other token."""
    return explode_tokens(df, col, sep, out).groupBy(out).agg(F.count(F.lit(1)).alias("count"))


def word_count(df: DataFrame, col: str = "line") -> DataFrame:
    """Word count over text lines split on one space."""
    return token_count(df, col, " ", "word")


def csv_token_count(df: DataFrame, col: str = "line") -> DataFrame:
    """Count of comma-separated tokens over text lines."""
    return token_count(df, col, ",", "token")


def distinct_words(df: DataFrame, col: str = "line") -> DataFrame:
    """Distinct non-empty words (the topics of the per-word fan-out)."""
    return explode_tokens(df, col).where(F.length("word") > 0).distinct()


def typed_records(df: DataFrame, fields: list[tuple[str, str]], col: str = "value",
                  sep: str = ",") -> DataFrame:
    """Delimited line -> typed columns: field i is ``trim(piece_i)`` cast to its type.

    Casts follow ANSI rules, so a malformed number fails the job the way ``toInt`` does.
    """
    parts = tokens(col, sep)
    out = []
    for i, (name, typ) in enumerate(fields):
        piece = F.get(parts, i) if i == 0 else F.trim(F.get(parts, i))
        out.append(piece.cast(typ).alias(name))
    return df.select(*out)


def schema_from_names(names: str) -> T.StructType:
    """All-string nullable schema from a blank-separated field-name string, e.g. ``"name age"``."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names.split()])


def dynamic_schema_records(df: DataFrame, names: str, col: str = "value", sep: str = ",") -> DataFrame:
    """Delimited line -> all-string columns named from ``names``; every field after the first is
    trimmed, as in the reference's ``Row(p(0), p(1).trim)``."""
    schema = schema_from_names(names)
    parts = tokens(col, sep)
    cols = [(F.get(parts, i) if i == 0 else F.trim(F.get(parts, i))).alias(f.name)
            for i, f in enumerate(schema.fields)]
    return df.select(*cols)


def numeric_at_least(col: str, bound: float):
    """``col >= bound`` for a string column holding numbers; non-numeric strings never match."""
    return F.expr(f"try_cast(`{col}` AS double)") >= F.lit(bound)
