"""Registered queries ``opN_<name>``: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.llm.collocations import collocations
from quarry.llm.common import documents, saved
from quarry.llm.decontaminate import contamination
from quarry.llm.language_id import identify_languages
from quarry.llm.lexical_search import build_index, search
from quarry.llm.license_scan import licences, page_notice, page_path, page_text
from quarry.llm.mixing import mix
from quarry.llm.near_dedup import near_duplicates
from quarry.llm.packing import pack, token_pieces
from quarry.llm.quality import quality
from quarry.llm.secrets import scan, span_text
from quarry.llm.substring_dedup import remove_repeats
from quarry.llm.token_counts import build_trees, matches, recount_tokens, vocabulary
from quarry.llm.toxicity import toxicity

QUERIES: dict = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@register("op7_quality_rules")
def op7(spark, sf_dir):
    d = quality(documents(spark, sf_dir).select("doc_id", "text"))
    return d.select("doc_id", *(F.col(f"quality.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "line_share", "ngram_share")))


@register("op9_secret_scan")
def op9(spark, sf_dir):
    d = scan(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return d.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                    count("hex").alias("n_hex"), F.sha2(span_text(base), 256).alias("base_sha256"),
                    span_text(F.col("spans")).alias("spans"))


@register("op4_decontaminate")
def op4(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    d = contamination(documents(spark, sf_dir).select("doc_id", "text"), items)
    return d.select("doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "hits.items"), 256).alias("items_sha256"), "hits.contaminated")


@register("op6_mix_sources")
def op6(spark, sf_dir):
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@register("op8_near_dedup")
def op8(spark, sf_dir):
    d = near_duplicates(documents(spark, sf_dir), shingle_words=2)
    return d.withColumn("kept", F.col("doc_id") == F.col("component_id"))


@register("op10_substring_dedup")
def op10(spark, sf_dir):
    d = remove_repeats(documents(spark, sf_dir))
    return d.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op1_language_id")
def op1(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    # a null id has no remainder: such a row is held out
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    d = identify_languages(docs, docs.where(~held_out))
    return d.select("doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score")


@register("op5_toxicity")
def op5(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    d = toxicity(documents(spark, sf_dir).select("doc_id", "text"), labels)
    return d.select("doc_id", "toxicity.*")


@register("op2_license_scan")
def op2(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    files = pages.select("page_id", page_path(F.col("url")).alias("path"), page_text(F.col("html")).alias("text"),
                         page_notice(F.col("html")).alias("notice"))
    return licences(files, notice="notice").select("page_id", "path", "licence.*")


@register("op3_token_counts")
def op3(spark, sf_dir):
    """Counts before and after masking long numbers and addresses (the edits) in every document."""
    text = F.col("text")
    # trees and edits in one projection share their Python workers
    d = documents(spark, sf_dir).select("doc_id", "text", build_trees(text, vocabulary(spark)).alias("tree"), matches(
        text, r"[0-9]{9,}|[0-9]{1,3}(?:\.[0-9]{1,3}){3}", "[NUMBER]").alias("edits"))
    d = recount_tokens(d, "edits", keep_text=False)
    return d.select("doc_id", F.col("tree.n_tokens").alias("n_tokens"), F.size("edits").cast("long").alias("n_edits"),
                    F.col("edited.n_tokens").alias("n_tokens_after"), F.col("edited.n_encoded").alias("n_encoded"))


@register("op11_pack_sequences")
def op11(spark, sf_dir):
    return pack(token_pieces(documents(spark, sf_dir)))


@register("op12_lexical_search")
def op12(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return search(saved(build_index(documents(spark, sf_dir)), "lexical-index"), items)


@register("op13_collocations")
def op13(spark, sf_dir):
    return collocations(documents(spark, sf_dir))
