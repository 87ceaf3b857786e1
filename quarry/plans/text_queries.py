"""Queries over ``documents`` text: lines, words, comma tokens, typed records."""

from __future__ import annotations

from quarry.operators import text as tx
from quarry.plans.registry import register
from quarry.sources.tables import read_table


def _doc_lines(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return tx.document_lines(docs)


@register("text_lines")
def text_lines(spark, sf_dir):
    return _doc_lines(spark, sf_dir)


@register("word_count")
def word_count(spark, sf_dir):
    return tx.word_count(_doc_lines(spark, sf_dir))


@register("csv_token_count")
def csv_token_count(spark, sf_dir):
    return tx.csv_token_count(_doc_lines(spark, sf_dir))


@register("distinct_words")
def distinct_words(spark, sf_dir):
    return tx.distinct_words(_doc_lines(spark, sf_dir))
