"""Document writes: map or JSON documents, routed by a field, upserted by id, bulk batches.

Documents are JSON lines in files (or a ``doc`` string column); an index is a folder, a route
is a ``partitionBy`` folder, and "same id replaces" is resolved by newest version per id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.common import materialize


def map_docs(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """One JSON document per row from a string map of ``fields``: ``doc``."""
    kv = []
    for k, c in fields.items():
        kv += [F.lit(k), c.cast("string")]
    return df.select(F.to_json(F.create_map(*kv)).alias("doc"))


def parse_docs(df: DataFrame, col: str, schema: str, keep: list[str] | None = None,
               bad_col: str = "bad_doc") -> DataFrame:
    """Parse JSON strings with ``schema`` (a DDL string). Malformed documents are kept apart:
    their fields are null and ``bad_col`` holds the raw text (``PERMISSIVE`` mode)."""
    full = f"{schema}, {bad_col} STRING"
    parsed = F.from_json(F.col(col), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad_col})
    return df.select(*(keep or []), parsed.alias("d")).select(*(keep or []), "d.*")


def write_docs(docs: DataFrame, path: str, route: str | None = None, mode: str = "append") -> str:
    """Write documents as JSON lines; ``route`` names the field whose value picks the folder."""
    w = docs.write.mode(mode)
    if route:
        w = w.partitionBy(route)
    w.json(path)
    return path


def write_parsed(parsed: DataFrame, path: str, bad_col: str = "bad_doc") -> str:
    """Write ``parse_docs``' rows as JSON lines: documents to ``path/docs``, the raw text of malformed ones
    (with the kept columns) to ``path/bad``. The input is evaluated once."""
    fields = [c for c in parsed.columns if c != bad_col]
    rows = materialize(parsed)
    rows.where(F.col(bad_col).isNull()).select(*fields).write.mode("overwrite").json(f"{path}/docs")
    rows.where(F.col(bad_col).isNotNull()).write.mode("overwrite").json(f"{path}/bad")
    return path


def newest(docs: DataFrame, id_col: str, version_col: str = "version", later: str | None = None) -> DataFrame:
    """Same id replaces: keep the highest version per id (partial aggregate, no window). Of equal versions
    the one with the higher ``later`` wins, and without such a column the one whose fields hash higher:
    the same one in every run."""
    cols = [c for c in docs.columns if c not in (id_col, later)]
    tie = F.col(later) if later else F.xxhash64(F.to_json(F.struct(*cols)))
    return (docs.groupBy(id_col).agg(F.max_by(F.struct(*cols), F.struct(F.col(version_col), tie.alias("tie"))).alias("d"))
                .select(id_col, "d.*"))


def upsert(existing: DataFrame, new: DataFrame, id_col: str, version_col: str = "version") -> DataFrame:
    """Existing documents with ``new`` written over them by id; at equal versions the new one wins."""
    both = existing.withColumn("_q_new", F.lit(0)).unionByName(new.withColumn("_q_new", F.lit(1)))
    return newest(both, id_col, version_col, "_q_new")
