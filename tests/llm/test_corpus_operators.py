"""Operators that compare documents, the source mix and the pipeline, on small fixtures."""

import hashlib
import random
import re

import duckdb
import pytest

from quarry.llm.common import documents
from quarry.llm.mixing import mix, targets, take
from quarry.llm.near_dedup import components, deduplicate, near_duplicates
from quarry.llm.oracle import SQL
from quarry.llm.queries import QUERIES
from quarry.llm.substring_dedup import pack, remove_repeats, unpack

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id int, row string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, 7, "clash") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def near_rows():
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(400)]
    rows, k = [], 0
    base = rng.choices(vocab, k=80)
    for g in range(60):                                  # a large group of near copies of one text
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((k := k + 1, " ".join(w), "s0"))
    for g in range(60):
        w = rng.choices(vocab, k=rng.randint(1, 60))
        rows.append((k := k + 1, " ".join(w), "s1"))
        if g % 3 == 0:
            rows += [(k := k + 1, " ".join(w).upper(), "s1"), (k := k + 1, "\t".join(w) + "\n", None)]
    return [*rows, (k + 1, None, "s1"), (k + 2, "", None), (k + 3, "  ", "s2"), (None, rows[0][1], "s0"), rows[5], rows[5]]


def brute_components(rows):
    sets, up = {}, {}
    for i, t, _ in rows:
        if i is not None:
            w = (t or "").encode().lower().split()
            sets[i] = {tuple(w)} if len(w) == 1 else set(zip(w, w[1:]))
            up[i] = i

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates(spark, near_rows):
    want = brute_components(near_rows)
    got = near_duplicates(table(spark, near_rows)).collect()
    assert len(got) == len(near_rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    kept = deduplicate(table(spark, near_rows))
    assert kept.columns == table(spark, near_rows[:1]).columns
    ids = [r.doc_id for r in kept.collect()]
    assert None in ids and {i for i in ids if i is not None} == {i for i, (_, c) in want.items() if c == i}
    assert near_duplicates(table(spark, near_rows[:1]).limit(0)).count() == 0


def test_shingle_length(spark):
    words = [f"w{i}" for i in range(200)]
    near, few = list(words), list(words)
    near[10::20] = [f"x{i}" for i in range(10)]          # one word in 20: 0.82 by two words, 0.60 by five
    few[100] = "x"                                       # 0.95 by five words
    rows = [(1, " ".join(words), "s"), (2, " ".join(near), "s"), (3, " ".join(few).upper(), "s"),
            (4, "a b c", "s"), (5, "A  b\tc", "s"), (6, "a b d", "s"), (7, "a b c 0", "s"), (8, "", "s")]
    part = lambda k: {r.doc_id: (r.n_shingles, r.component_id) for r in
                      near_duplicates(table(spark, rows), shingle_words=k).collect()}
    two, five = part(2), part(5)
    assert [two[i] for i in (1, 2, 3)] == [(199, 1)] * 3 and [five[i] for i in (1, 2, 3)] == [(196, 1), (196, 2), (196, 1)]
    assert [five[i] for i in range(4, 9)] == [(1, 4), (1, 4), (1, 6), (1, 7), (0, 8)]
    import corpus_pipeline
    kept = corpus_pipeline.near_dedup(spark, table(spark, rows), "").collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 4, 6, 7, 8]


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    edges = spark.createDataFrame(path + [(7, x) for x in range(200, 230)] + [(3, 3)], "u long, v long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[x] for x in range(200, 230)} == {7}


def brute_repeats(rows, n=13):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows]
    first = {}
    for i, w in words:
        for s in range(len(w) - n + 1):
            k = tuple(w[s:s + n])
            first[k] = min(first.get(k, float("inf")), float("inf") if i is None else i)
    out = []
    for i, w in words:
        own = float("inf") if i is None else i
        gone = {s + j for s in range(len(w) - n + 1) if first[tuple(w[s:s + n])] < own for j in range(n)}
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


@pytest.mark.parametrize("cell, bucket", [(8_000_000, 16_000_000), (900, 2_000)])
def test_substring_dedup(spark, cell, bucket):
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(60):
        w = rng.choices([f"é{k}" for k in range(300)], k=rng.randint(0, 90))
        if i % 3 == 0:
            a, at = rng.randrange(40), rng.randint(0, len(w))
            w[at:at] = passage[a:a + rng.randint(10, 20)]
        rows.append((rng.choice([-1, 1]) * (i + 1) * 7, " ".join(w), "s"))
    rows += [(None, " ".join(passage), "s"), (500, None, "s"), (501, "", "s"), (502, " ".join(passage), "s"),
             (502, " ".join(passage), "s"), (503, "same " * 40, "s")]
    got = remove_repeats(table(spark, rows), cell_chars=cell, bucket_chars=bucket).collect()
    key = lambda x: str(x)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=key) == sorted(brute_repeats(rows), key=key)
    assert remove_repeats(table(spark, rows[:1]).limit(0)).count() == 0


def test_packed_hashes_round_trip():
    import numpy as np
    x = np.sort(np.random.default_rng(1).integers(0, 2 ** 64, 1000, dtype=np.uint64))
    assert (unpack(pack(x)) == x).all() and (unpack(pack(x[:1])) == x[:1]).all()


def test_targets_share_the_budget(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1000), (None, 50), ("é", 0)], "source string, source_size long")
    got = {r.source: r.target for r in targets(sizes).collect()}
    assert abs(sum(got.values()) - 1.5 * 1160) < 1e-6
    assert got["a"] == 200 and got["b"] == 20 and got[None] <= 100 and got["é"] == 0


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(["s0", "s0", "s0", "s1", "s2", None])) for i in range(900)]
    rows += [(5000, None, "s1"), (None, "a b c", "s2"), rows[3]]
    t = table(spark, rows)
    got = mix(t).collect()
    assert len(got) == len(rows) and got == mix(t).collect() or sorted(map(str, got)) == sorted(map(str, mix(t).collect()))
    for s in {r.source for r in got}:
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 61
        assert all(r.taken in (0, r.size, 2 * r.size) for r in mine)
    rows_taken = take(t)
    assert rows_taken.columns == [*t.columns, "copies", "size", "target"]
    assert rows_taken.count() == sum(r.copies > 0 for r in got)
    assert mix(t.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.execute(SQL[name])
    cols = [d[0] for d in want.description]
    got = QUERIES[name](spark, SMALL).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_op10_digest(spark):
    got = {r.doc_id: r.kept_sha256 for r in QUERIES["op10_substring_dedup"](spark, SMALL).collect()}
    rows = [(r.doc_id, r.text, None) for r in documents(spark, SMALL).collect()]
    assert got == {i: hashlib.sha256(k.encode()).hexdigest() for i, _, _, k in brute_repeats(rows)}


def test_pipeline_stages(spark):
    import corpus_pipeline
    d = documents(spark, SMALL)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near dedup", "decontaminate", "secret scan", "mix sources"]
    odd = d.limit(1).selectExpr("cast(null as long) doc_id", "cast(null as string) text", "lang", "source", "n_chars")
    for rows in (d.unionByName(odd).unionByName(d.limit(3)), d.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, SMALL)
            assert rows.columns == d.columns
            rows = spark.createDataFrame(rows.collect(), d.schema)
        last = corpus_pipeline.STAGES[-1][1](spark, rows, SMALL)
        assert last.columns[:5] == d.columns and last.where("copies < 1").count() == 0
    assert corpus_pipeline.run(spark, SMALL).count() > 20
