"""Packing, lexical search and collocations against brute force on small fixtures."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import lexical_search as ls
from quarry.llm.collocations import Transducer, collocations, words_and_pairs
from quarry.llm.common import saved
from quarry.llm.packing import complete_bins, best_fit, lower_bound, pack, sequences, token_pieces
from quarry.llm.queries import QUERIES
from quarry.llm.word_tokens import Encoder, vocabulary_path

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, rank int, sequence_id string, p_length int, n int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, 7, "clash", 3, 1) for i, t, g in rows], SCHEMA)


# --- token ids ------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary_path())


def test_ids_equal_the_library(library):
    enc = Encoder(open(vocabulary_path(), "rb").read())
    rng = random.Random(5)
    alphabet = "aaabbc'sStTrRe veELldm0129!?<|>endoftextéÉ́Σςİ  \x1c\x00\t\n中文\U0001f600ß×÷"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["<|endoftext|>", None, "", "it's we'RE <|startoftext|>x'll ''s !'s", "a" * 5000, "b!" * 300, "aaaaaaa ababab",
              "Größe ÀÉ×÷ 'select'd"]
    ids, n = enc.encode(pa.array(texts))
    at = 0
    for t, k in zip(texts, n.tolist()):
        assert ids[at:at + k].tolist() == library.encode(t or "", add_special_tokens=False).ids, t
        at += k
    assert at == len(ids)


# --- packing --------------------------------------------------------------------------------
def fewest_bins(items, cap):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for r in {b for b in bins if b >= items[i]}:
            j = bins.index(r)
            bins[j] -= items[i]
            go(i + 1, bins)
            bins[j] += items[i]
        if len(bins) + 1 < best[0]:
            go(i + 1, [*bins, cap - items[i]])
    go(0, [])
    return best[0]


def test_bin_completion_finds_the_optimum_of_small_inputs():
    rng, better = random.Random(3), 0
    for _ in range(250):
        cap = rng.choice([10, 20, 30, 50])
        items = [rng.randint(1, cap) if rng.random() < .3 else rng.randint(max(1, cap // 5), cap // 2)
                 for _ in range(rng.randint(0, 13))]
        count = np.bincount(items, minlength=cap + 1).astype(np.int64) if items else np.zeros(cap + 1, np.int64)
        plan, need = complete_bins(count, cap, nodes=20000)
        placed = np.zeros(cap + 1, np.int64)
        for runs, bins in plan:
            assert sum(x * n for x, n in runs) <= cap
            for x, n in runs:
                placed[x] += n * bins
        assert (placed == count).all()
        got = sum(n for _, n in plan)
        assert need <= got == fewest_bins(items, cap)
        better += sum(n for _, n in best_fit(count, cap)) > got
    assert better > 0                                     # completion beats best fit somewhere


def test_bin_completion_meets_the_bound_on_many_pieces():
    sizes = np.minimum(2048, np.maximum(1, np.random.default_rng(0).lognormal(6, 1, 100_000))).astype(int)
    count = np.bincount(sizes, minlength=2049).astype(np.int64)
    plan, need = complete_bins(count)
    assert sum(n for _, n in plan) <= need + 1 and need == lower_bound(count, 2048)
    # a thousand times the pieces take no longer plan
    plan, need = complete_bins(count * 1000)
    assert sum(n for _, n in plan) <= 1.001 * need and len(plan) < 20_000


def check_packing(rows, packed, library, cap):
    want = Counter()
    for i, t, _ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(-(-len(ids) // cap)):
            part = ids[k * cap:(k + 1) * cap]
            want[i, k, k * cap, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap
    return len(bins)


def test_pack_documents(spark, library):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("the red fox's über 42 häuser runs; jump!".split()) for _ in range(rng.randint(0, 90))), "en")
            for i in range(300)]
    rows += [(None, "null id", "en"), (500, None, None), (501, "", "de"), (502, " \n ", "fr"), rows[3], rows[3],
             (503, "word " * 400_000, "en")]             # a text of 2 MB
    pieces = token_pieces(table(spark, rows), capacity=64, keep_ids=True)
    packed = pack(pieces, capacity=64)
    got = packed.collect()
    n = check_packing(rows, got, library, 64)
    count = np.bincount([r.length for r in got], minlength=65)
    assert n <= lower_bound(count, 64) + 1
    whole = sequences(packed).collect()
    assert len(whole) == n and all(len(r.ids) == 4 * r.n_tokens <= 256 for r in whole)
    assert sum(r.n_tokens for r in whole) == sum(r.length for r in got)
    assert pack(token_pieces(table(spark, rows[:1]).limit(0))).count() == 0
    # columns of the pieces stay, whatever their names
    extra = spark.createDataFrame([(5, 1, "x", "y"), (9, 2, "z", "w")], "length int, p_block int, base string, p_row string")
    assert sorted(tuple(r) for r in pack(extra, capacity=10).select(*extra.columns).collect()) == [(5, 1, "x", "y"), (9, 2, "z", "w")]
    with pytest.raises(ValueError):
        pack(extra, capacity=8)


def test_op11_query(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    got = QUERIES["op11_pack_sequences"](spark, SMALL).collect()
    n = check_packing(rows, got, library, 2048)
    assert n == lower_bound(np.bincount([r.length for r in got], minlength=2049), 2048)


# --- lexical search -------------------------------------------------------------------------
def terms_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))


def brute_search(rows, items, k):
    docs = [(i, Counter(terms_of(t))) for i, t, _ in rows]
    docs = [(i, c) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for name, text in items:
        scored = []
        for i, c in docs:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(terms_of(text)) if t in c)
            if score:
                scored.append((-score, i is None, i if i is not None else 0))
        out += [(name, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.fixture(scope="module")
def search_rows():
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(300)] + ["É", "naïve"]
    rows = [(i, " ".join(rng.choices(vocab, weights=[1 / (j + 1) for j in range(len(vocab))], k=rng.randint(1, 60))), "en")
            for i in range(400)]
    rows += [(1000 + i, rows[7][1], "en") for i in range(30)]          # ties: many copies of one text
    rows += [(2000, "W1 w250! " * 40_000, "en"), (None, rows[9][1], None), (2001, None, "en"), (2002, "", "en"),
             (2003, "... ", "de"), rows[5], rows[5]]
    items = [(j, " ".join(rng.choices(vocab, k=12))) for j in range(20)]
    items += [(5, "w299 w298"), (90, None), (91, "--"), (92, "unknownword"), (93, rows[7][1]), (94, rows[9][1])]
    return rows, items


@pytest.mark.parametrize("k", [1, 10])
def test_search(spark, search_rows, k):
    rows, items = search_rows
    index = saved(ls.build_index(table(spark, rows).repartition(5)), "t-index")
    queries = spark.createDataFrame(items, "item_id long, text string")
    got = ls.search(index, queries, k=k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == Counter(brute_search(rows, items, k))


def test_search_of_nothing(spark, search_rows):
    rows, items = search_rows
    queries = spark.createDataFrame(items, "item_id long, text string")
    empty = saved(ls.build_index(table(spark, rows).limit(0)), "t-index0")
    assert ls.search(empty, queries).count() == 0
    index = saved(ls.build_index(table(spark, rows[:50])), "t-index1")
    assert ls.search(index, queries.limit(0)).count() == 0
    blank = saved(ls.build_index(table(spark, [(1, None, "en"), (2, "", "en")])), "t-index2")
    assert ls.search(blank, queries).count() == 0


def test_bounds_hold_and_spare_most_documents(search_rows):
    rows, items = search_rows
    texts = pa.array([t for _, t, _ in rows], pa.string())
    cols = ls.index_rows(texts)
    keep = np.flatnonzero(np.asarray(cols[0]))
    block = ls.Block([(i, t or "") for i, t in items])
    n_docs, n_terms = len(keep), int(np.asarray(cols[0]).sum())
    own = [np.frombuffer(b.as_py(), np.uint64) for b in cols[3]]
    df = Counter(int(np.searchsorted(block.terms, h)) for o in own for h in o if h in set(block.terms))
    block.weigh(df, n_docs, n_terms)
    s = ls.Searcher(block, 3)
    ids = [rows[i][0] for i in keep]
    some = [c.take(pa.array(keep)) for c in cols]
    s.add(ids, np.asarray(some[0]), np.asarray(some[1]), *some[2:])
    best = {(block.ids[block.asked[q]], -score) for q, b in enumerate(s.best) for score, _, _ in b[:1]}
    assert best >= {(i, sc) for i, r, _, sc in brute_search(rows, items, 1) if i != 5}
    assert s.rescored < 0.5 * len(keep) * len(block.asked)


def test_op12_query(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = QUERIES["op12_lexical_search"](spark, SMALL).collect()
    assert Counter(map(tuple, got)) == Counter(brute_search(docs, items, 10))


# --- collocations ---------------------------------------------------------------------------
def brute_collocations(rows, least, keep):
    grams, total = Counter(), Counter()
    for _, t, g in rows:
        g = "und" if g is None else g
        low = (t or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split("[.,;:!?\x0A-\x0D]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[g] += len(w)
            for k in (1, 2, 3):
                grams.update((g, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cands = {x: a for x, a in grams.items() if len(x[1]) > 1 and a >= least}
    out, longest = {}, {}
    for (g, x), f in cands.items():
        for part in (x[:2], x[1:]) if len(x) == 3 else ():
            longest[g, part] = max(f, longest.get((g, part), 0))
    for (g, x), a in cands.items():
        if len(x) == 2 and 100 * longest.get((g, x), 0) >= 50 * a:
            continue
        score, _, l, r = min((10**6 * a * a // (grams[g, x[:k]] * grams[g, x[k:]]), k, grams[g, x[:k]], grams[g, x[k:]])  # noqa: E741
                             for k in range(1, len(x)))
        out.setdefault(g, []).append((-score, -a, " ".join(x).encode(), l, r))
    return [(g, rank, p.decode(), -a, l, r, total[g], -s) for g, v in out.items()
            for rank, (s, a, p, l, r) in enumerate(sorted(v)[:keep], 1)]


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(4)
    vocab = ["the", "of", "red", "fox", "New", "york", "city", "naïve", "a\x00b", "x-y", "\x85z"]
    rows = []
    for i in range(250):
        words = []
        for _ in range(rng.randint(0, 30)):
            words += rng.choice([["new", "york", "city"], ["the"], [rng.choice(vocab)], ["of", "the"], [f"v{rng.randint(0, 99)}"]])
            words += rng.choice([[], [], ["."], [","], ["\n"], ["\t"]])
        rows.append((i, " ".join(words), rng.choice(["en", "en", "en", "de", None, "und"])))
    return [*rows, (900, None, "en"), (901, "", None), (902, " .\n", "fr"), rows[0], rows[0], (903, "New York. " * 100_000, "de")]


@pytest.mark.parametrize("least,keep", [(10, 2000), (3, 15)])
def test_collocations(spark, phrase_rows, least, keep):
    got = collocations(table(spark, phrase_rows).repartition(6), least=least, keep=keep)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(brute_collocations(phrase_rows, least, keep))


def test_collocations_of_nothing(spark, phrase_rows):
    assert collocations(table(spark, phrase_rows).limit(0)).count() == 0
    assert collocations(table(spark, [(1, "one two three", "en"), (2, None, None)])).count() == 0


def test_transducer_round_trip_and_walks(phrase_rows):
    texts = pa.array([t for _, t, _ in phrase_rows[:120]], pa.string())
    langs = pa.array([g for _, _, g in phrase_rows[:120]], pa.string())
    g = words_and_pairs(texts, langs, 0)
    rng = np.random.default_rng(1)
    pick = rng.integers(0, len(g.pair_n), 500)
    three = [g.pair[0][pick], g.pair[1][pick], g.word[rng.integers(0, len(g.word), 500)]]
    order = np.lexsort(three[::-1])
    three = [c[order] for c in three]
    new = np.concatenate(([True], np.any([c[1:] != c[:-1] for c in three], axis=0)))
    g.triple, g.triple_n = [c[new] for c in three], rng.integers(1, 4, int(new.sum()))
    m = Transducer.read(Transducer.of(g).row())
    back = m.grams(g.texts, g.langs)
    for x, y in zip([g.word, g.word_n, *g.pair, g.pair_n, *g.triple, g.triple_n],
                    [back.word, back.word_n, *back.pair, back.pair_n, *back.triple, back.triple_n]):
        assert (x == y).all()
    assert len(m.two.first) - 1 < len(np.unique(np.stack(g.triple[:2]), axis=1).T)      # equal states are shared
    yes = np.ones(len(g.pair_n), bool)
    assert (m.count(*g.pair, yes) == g.pair_n).all() and (m.count(g.word, g.word, np.zeros(len(g.word), bool)) == g.word_n).all()
    assert (m.count(g.pair[0], g.pair[1] + np.uint64(1), yes) == 0).all()
    # the union of two halves is the whole
    a, b = words_and_pairs(texts[:60], langs[:60], 0), words_and_pairs(texts[60:], langs[60:], 0)
    u, w = type(a).union([a, b]), words_and_pairs(texts, langs, 0)
    assert (u.word == w.word).all() and (u.word_n == w.word_n).all() and (u.pair_n == w.pair_n).all() and u.texts.equals(w.texts)


def test_op13_query(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = QUERIES["op13_collocations"](spark, SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(brute_collocations(docs, 10, 2000))
