"""Cases in which rows or counts used to be lost without a word."""

import tracemalloc

import numpy as np
import pyarrow as pa

from quarry.llm.common import mix64
from quarry.llm.decontaminate import Block, _search
from quarry.llm.language_id import GRAM_BITS, _classify, folded, grams
from quarry.llm.license_scan import licences
from quarry.llm.near_dedup import deduplicate, near_duplicates
from quarry.llm.toxicity import fit_chain


def test_labels_of_other_documents_do_not_push_out_the_sample(spark):
    docs = spark.createDataFrame([(i, "foul rotten words" if i % 2 else "kind sunny words") for i in range(60)], "doc_id long, text string")
    docs = docs.union(docs.limit(5))                                   # repeated rows are one document
    own = spark.range(60).selectExpr("id AS doc_id", "1 AS quality", "cast(id % 2 AS int) AS toxic")
    others = spark.range(1000, 40000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    alone = fit_chain(docs, own, fit_rows=80)
    crowded = fit_chain(docs, own.union(others), fit_rows=80)
    assert alone and all(np.allclose(a, b) for a, b in zip(alone, crowded, strict=True))
    assert any(np.abs(w).max() > 0.01 for w in alone)


def test_counts_over_a_million_keep_their_order():
    # the last text's most frequent letters come 1.2 and 1.1 million times
    text = "ab" * 1_100_000 + "a" * 100_000
    x, off = folded(pa.array([text]))
    code, _ = grams(x, off, (1,))
    key = lambda c: (mix64(np.array([c], np.int64).view(np.uint64)) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)[0]
    letters = sorted({int(c) for c in np.unique(code)}, key=lambda c: -int((code == c).sum()))[:2]
    known = np.sort(np.array([key(c) for c in letters]))
    first = np.array([0 if k == key(letters[0]) else 1 for k in known])
    names, score = _classify(pa.array([text]), ["swapped", "right"], known, np.stack([1 - first, first]), 2, (1,))
    assert names == ["right"] and score[0] == 1.0


def test_every_text_of_a_repeated_id_keeps_its_links(spark):
    words = [f"w{i}" for i in range(200)]
    text, other, third = " ".join(words), " ".join(f"o{i}" for i in range(200)), " ".join(f"t{i}" for i in range(200))
    changed = lambda t: " ".join([*t.split()[:100], "new", *t.split()[101:]])
    rows = [(5, other), (5, text), (9, text), (20, changed(text)),     # 5 has two texts, 9 and 20 link to one
            (30, changed(other)),                                      # and 30 to the other
            (40, third), (41, changed(third)), (42, third), (42, text + " again"),   # 42 joins both groups
            (50, ""), (50, "alone and short"), (51, None), (None, text)]
    got = {}
    for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        if r.n_shingles:
            got.setdefault(r.doc_id, set()).add(r.component_id)
    assert got == {**{i: {5} for i in (5, 9, 20, 30, 40, 41, 42)}, 50: {50}, None: {None}}
    alone = [r for r in rows if r[0] is not None and r[0] != 42]
    kept = deduplicate(spark.createDataFrame(alone, "doc_id long, text string")).select("doc_id").distinct()
    assert {r.doc_id for r in kept.collect()} == {5, 40, 50, 51}


def test_columns_named_like_helpers(spark):
    files = spark.createDataFrame(
        [("d/LICENSE", "Licensed under the MIT License.", "a", "b", "c"), ("d/e/x.py", "print(1)", "a", "b", "c")],
        "path string, text string, _near string, _folder string, folder string")
    rows = {r.path: r for r in licences(files).collect()}
    assert rows["d/e/x.py"].licence.how == "inherited" and rows["d/e/x.py"]["_near"] == "a"
    assert licences(files).columns == [*files.columns, "licence"]


def test_many_patterns_of_one_suffix():
    # answer templates: 20,000 patterns end in the same four words, and so does every line of the text
    tail = "the right answer is"
    block = Block([([f"a{i}", f"b{i}", f"c{i}", f"d{i}", f"e{i}", f"f{i}", *tail.split()], [f"item{i}"]) for i in range(20_000)])
    planted = {70: 3, 900: 19_999, 4000: 3}
    text = "".join(f"a{planted[i]} b{planted[i]} c{planted[i]} d{planted[i]} e{planted[i]} f{planted[i]} {tail} "
                   if i in planted else f"x{i} {tail} " for i in range(5000))
    tracemalloc.start()
    (n_words, n_hit, runs, items), = _search(pa.array([text]), block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (n_words, n_hit, items) == (len(text.split()), 30, ["item19999", "item3"]) and len(runs) == 6
    assert len(text) > 120_000 and peak < 100 << 20                     # 1.4 GB when whole buckets were expanded
