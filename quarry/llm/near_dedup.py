"""MinHash near-duplicates with tensored banding (operator 8).

Two collections of ``BANDS`` sub-keys, each a hash of ``ROWS`` minhashes, give ``BANDS ** 2`` table
keys by pairing every sub-key of one with every sub-key of the other. A table key then stands for
``2 * ROWS`` minhashes although only ``2 * BANDS * ROWS`` are computed. At similarity 0.8 a pair
shares no key with probability below ``2 * (1 - 0.8 ** ROWS) ** BANDS``, 2 in 100,000.

1. Documents with equal shingle sets form a class; only its smallest id goes on, with the hash of the
   text that it has there. Classes that share an id are linked.
2. Sub-keys held by one document only are left out, so most documents emit no table key at all.
3. In each table group one pivot, the member that shares most groups, is compared with the others
   on the full shingle sets of the texts. Hot groups cost one comparison per member, and a hot
   star is cut into parts of about ``PART_ROWS`` members, each of which gets its own pivot copy.
4. Verified links are contracted to components.
5. What is left in a pivot's star across components is compared exactly in bounded blocks: two
   members' intersection follows from their differences to the pivot, so no text moves again and no
   pair is emitted unless it is a link. Every pair that shares a key shares that key's pivot, so no
   candidate pair is left out.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (LOWER, NON_BLANK, find_words, free_name, hash_words, mix64, saved, seeds, slices,
                               text_buffer)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BANDS = 16
ROWS = 3
SIMILAR_PCT = 80
SHINGLE_WORDS = 2
MARKS = 1 << 27        # bits of the broadcast filter of star members: at most 16 MB whatever the input
PART_ROWS = 256        # members of a star that meet one copy of its pivot's text, on average
STAR_LEFT = 256        # members outside the pivot's component that one block holds
STAR_ALL = 2048        # members of the star that they are compared with in one block
COLUMNS = 4096         # difference tokens per matrix product


def shingle_sets(arr: pa.Array, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (``words`` words each) of each text, sorted within the text, and the
    offsets of the texts. A shorter text has all its words as its only shingle, one without words none."""
    raw, off = text_buffer(arr)
    buf = LOWER[raw]
    start, end, first = find_words(buf, off, NON_BLANK)
    h = hash_words(buf, start, end)
    n_words = np.diff(first)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    full = np.flatnonzero(doc[words - 1:] == doc[:len(doc) - words + 1]) if len(doc) >= words else np.zeros(0, np.int64)
    short = first[:-1][(n_words > 0) & (n_words < words)]
    left = n_words[doc[short]]
    x = np.concatenate((h[full], h[short]))
    for j in range(1, words):
        more = np.flatnonzero(left > j)
        rest = np.zeros(len(short), dtype=np.uint64)
        rest[more] = h[short[more] + j]
        x = mix64(x * np.uint64(0x9E3779B97F4A7C15) + mix64(np.concatenate((h[full + j], rest)) + np.uint64(1)))
    d = np.concatenate((doc[full], doc[short]))
    order = np.lexsort((x, d))
    x, d = x[order], d[order]
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = (x[1:] != x[:-1]) | (d[1:] != d[:-1])
    x, d = x[keep], d[keep]
    return x, np.searchsorted(d, np.arange(len(n_words) + 1))


def _signatures(arr: pa.Array, bands: int, rows: int, words: int) -> pa.Array:
    x, first = shingle_sets(arr, words)
    n = np.diff(first)
    some = np.flatnonzero(n > 0)
    at = first[:-1][some]
    subkeys = np.zeros((len(n), 2 * bands), dtype=np.uint64)
    digest = np.zeros((len(n), 2), dtype=np.uint64)
    if len(some):
        for t, (a, b) in enumerate(zip(seeds(2 * bands * rows, 21), seeds(2 * bands * rows, 22))):
            low = np.minimum.reduceat(x * a + b, at)
            band = t // rows
            subkeys[some, band] = mix64(subkeys[some, band] * np.uint64(0x2545F4914F6CDD1D) + low + np.uint64(band))
        digest[some, 0] = np.add.reduceat(mix64(x + np.uint64(31)), at)
        digest[some, 1] = np.add.reduceat(mix64(x ^ np.uint64(0x5DEECE66D)), at)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * 2 * bands, pa.int32()),
                                     pa.array(subkeys.ravel().view(np.int64)))
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(digest[:, 0].view(np.int64)),
                                       pa.array(digest[:, 1].view(np.int64)), lists],
                                      ["n", "d0", "d1", "subkeys"])


def signature(text: Column, bands: int = BANDS, rows: int = ROWS, words: int = SHINGLE_WORDS) -> Column:
    """Struct of set size, 128-bit set digest and the ``2 * bands`` sub-keys of a text column."""

    @F.arrow_udf("struct<n:long,d0:long,d1:long,subkeys:array<long>>")
    def sign(arr: pa.Array) -> pa.Array:
        parts = [_signatures(arr[lo:hi], bands, rows, words) for lo, hi in slices(arr)]
        return pa.concat_arrays(parts) if parts else _signatures(arr, bands, rows, words)

    return sign.asNondeterministic()(text)


COMPARED = pa.struct([("np", pa.int64()), ("nx", pa.int64()), ("common", pa.int64()),
                      ("miss", pa.binary()), ("extra", pa.binary())])


def _compare(pivot: pa.Array, other: pa.Array, words: int) -> pa.Array:
    """Sizes and intersection of each pair of texts, and the difference of the second set to the
    first: hashes of the shingles it lacks and of those it adds."""
    # a pivot's rows tend to come together: its set is built once per run of equal texts
    change = [i for i in range(len(pivot)) if i == 0 or not pivot[i].equals(pivot[i - 1])]
    run = np.searchsorted(change, np.arange(len(pivot)), side="right") - 1
    px, pf = shingle_sets(pivot.take(pa.array(change, pa.int64())), words)
    ox, of = shingle_sets(other, words)
    out = []
    for i in range(len(other)):
        p, x = px[pf[run[i]]:pf[run[i] + 1]], ox[of[i]:of[i + 1]]
        at = np.searchsorted(p, x)
        at[at == len(p)] = 0
        same = p[at] == x if len(p) else np.zeros(len(x), dtype=bool)
        lacks = np.ones(len(p), dtype=bool)
        lacks[at[same]] = False
        out.append((len(p), len(x), int(same.sum()), p[lacks].tobytes(), x[~same].tobytes()))
    return pa.array([dict(zip(COMPARED.names, r)) for r in out], COMPARED)


def compared(pivot: Column, other: Column, words: int = SHINGLE_WORDS) -> Column:
    @F.arrow_udf("struct<np:long,nx:long,common:long,miss:binary,extra:binary>")
    def compare(a: pa.Array, b: pa.Array) -> pa.Array:
        parts = [_compare(a[lo:hi], b[lo:hi], words) for lo, hi in slices(b, 1 << 20)]
        return pa.concat_arrays(parts) if parts else pa.array([], COMPARED)
    return compare.asNondeterministic()(pivot, other)


def _star_links(table: pa.Table, similar_pct: int) -> pa.Table:
    """Links across components inside one block of one pivot's star."""
    left = table.filter(pa.compute.equal(table["side"], 0))
    right = table.filter(pa.compute.equal(table["side"], 1))
    empty = pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
    if not len(left) or not len(right):
        return empty

    def tokens(t):
        """Difference tokens (lacking and added shingles told apart) and the row of each."""
        parts, rows = [], []
        for i, (m, e) in enumerate(zip(t["miss"].to_pylist(), t["extra"].to_pylist())):
            a, b = np.frombuffer(m, np.uint64), np.frombuffer(e, np.uint64)
            parts += [mix64(a + np.uint64(77)), b]
            rows += [np.full(len(a) + len(b), i)]
        return np.concatenate(parts), np.concatenate(rows)

    lt, lr = tokens(left)
    rt, rr = tokens(right)
    vocab = np.sort(lt)
    vocab = vocab[np.concatenate(([True], vocab[1:] != vocab[:-1]))] if len(vocab) else vocab
    lc = np.searchsorted(vocab, lt)
    rc = np.searchsorted(vocab, rt)
    inside = np.flatnonzero(rc < len(vocab))
    inside = inside[vocab[rc[inside]] == rt[inside]]
    rc, rr = rc[inside], rr[inside]
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    lo_order, ro_order = np.argsort(lc, kind="stable"), np.argsort(rc, kind="stable")
    lc, lr, rc, rr = lc[lo_order], lr[lo_order], rc[ro_order], rr[ro_order]
    for c in range(0, len(vocab), COLUMNS):
        la, lb = np.searchsorted(lc, [c, c + COLUMNS])
        ra, rb = np.searchsorted(rc, [c, c + COLUMNS])
        a = np.zeros((len(left), COLUMNS), dtype=np.float32)
        b = np.zeros((len(right), COLUMNS), dtype=np.float32)
        a[lr[la:lb], lc[la:lb] - c] = 1
        b[rr[ra:rb], rc[ra:rb] - c] = 1
        shared += a @ b.T
    col = lambda t, n: t[n].to_numpy().astype(np.int64)
    lacks = lambda t: np.array([len(m) // 8 for m in t["miss"].to_pylist()], dtype=np.int64)
    # |x & y| = |p| - |lacks x or y| + |adds x and y|; the shared tokens hold both overlaps
    common = (col(left, "np")[:, None] - lacks(left)[:, None] - lacks(right)[None, :]
              + shared.astype(np.int64))
    union = col(left, "nx")[:, None] + col(right, "nx")[None, :] - common
    lu, lv, cu, cv = col(left, "x"), col(right, "x"), col(left, "label"), col(right, "label")
    link = (100 * common >= similar_pct * union) & (cu[:, None] != cv[None, :])
    us, vs = [], []
    for i in np.flatnonzero(link.any(axis=1)):           # one link per member and component is enough
        hits = np.flatnonzero(link[i])
        _, one = np.unique(cv[hits], return_index=True)
        us += [lu[i]] * len(one)
        vs += lv[hits[one]].tolist()
    return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())}) if us else empty


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(node, label)`` of every node of an edge list; the label is the smallest node reachable.

    Rounds of contraction: every node hooks to its smallest smaller neighbour, the hooks are
    flattened by pointer jumping, and edges move to the roots until none is left. Each round at
    least halves the number of nodes that still have edges. All state stays in written tables.
    """
    e = saved(edges.select(F.col(u).alias("a"), F.col(v).alias("b")).where("a <> b").distinct(), "edges")
    nodes = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
    labels = saved(nodes.withColumn("label", F.col("node")), "labels")
    while not e.isEmpty():
        hook = e.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).groupBy("node").agg(
            F.min("to").alias("to"))
        hook = saved(hook, "hooks")
        while True:                                     # pointer jumping until every hook ends at a root
            nxt = hook.select(F.col("node").alias("to"), F.col("to").alias("next"))
            jumped = saved(hook.join(nxt, "to", "left").select(
                "node", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "hooks")
            hook = jumped.select("node", "to")
            if jumped.where("moved").isEmpty():
                break
        root = lambda t, c: t.join(hook.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")), c, "left"
                                   ).withColumn(c, F.coalesce(f"{c}_to", c)).drop(f"{c}_to")
        labels = saved(root(labels, "label"), "labels")
        e = saved(root(root(e, "a"), "b").where("a <> b").distinct(), "edges")
    return labels


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bands: int = BANDS,
                    rows: int = ROWS, similar_pct: int = SIMILAR_PCT,
                    shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``.

    Documents whose sets of ``shingle_words``-word shingles (A-Z lower-cased) have ``100 * |A & B| >= similar_pct *
    |A | B|`` are linked; ``component_id`` is the smallest id reachable over links. Null, empty and
    blank texts have 0 shingles and are linked with nothing. Rows with a null id are linked with
    nothing and have a null component. Repeated rows give repeated result rows; rows with one id
    and different texts are one document: each text links as it would alone, and all its rows that have
    shingles get one component.
    """
    base = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).withColumn(
        "hash", F.xxhash64("text"))
    sig = saved(base.select("doc_id", "hash", signature(F.col("text"), bands, rows, shingle_words).alias("s")).select(
        "doc_id", "hash", "s.*"), "signatures")
    held = sig.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    # a class goes by its smallest id and, as that id may have other texts too, a hash of the text
    classes = saved(held.groupBy("d0", "d1").agg(F.min(F.struct("doc_id", "hash")).alias("rep"),
                                                 F.first("subkeys").alias("subkeys")), "classes")
    # ids with texts of several classes link those classes
    several = held.groupBy("doc_id").agg(F.min(F.struct("d0", "d1")).alias("a"), F.max(F.struct("d0", "d1")).alias("b")).where(
        "a <> b").select("doc_id")
    same = saved(held.join(several, "doc_id", "left_semi").select("doc_id", "d0", "d1").distinct().join(
        classes.select("d0", "d1", "rep"), ["d0", "d1"]).select(F.col("doc_id").alias("u"), F.col("rep.doc_id").alias("v")),
        "same-ids")

    # sub-keys that at least two classes hold
    h = classes.select("rep", F.posexplode("subkeys").alias("t", "h"))
    shared = h.groupBy("t", "h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    mine = h.join(shared, ["t", "h"]).groupBy("rep").agg(F.collect_set(F.struct("t", "h")).alias("s"))
    half = lambda op: F.filter("s", lambda x: op(x["t"]))
    pairs = F.flatten(F.transform(half(lambda t: t < bands), lambda a: F.transform(
        half(lambda t: t >= bands), lambda b: F.xxhash64(a["t"], b["t"], a["h"], b["h"]))))
    keys = saved(mine.select("rep", F.explode(pairs).alias("key")), "table-keys")
    size = keys.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    groups = saved(keys.join(size, "key"), "table-groups")

    # the pivot of a group is the member that meets most others over all its groups
    met = groups.groupBy("rep").agg(F.sum(F.col("k") - 1).alias("met"))
    ranked = groups.select("key", "rep").join(met, "rep")
    pivot = ranked.groupBy("key").agg(F.min(F.struct((-F.col("met")).alias("met"), "rep")).alias("m")).select(
        "key", F.col("m.rep").alias("p"))
    # a group of at most PART_ROWS members makes part 0; larger ones are spread by their size
    star = groups.select("key", F.col("rep").alias("x"), "k").join(pivot, "key").where("x <> p").groupBy("p", "x").agg(
        F.max("k").alias("k"))
    star = saved(star.select("p", "x", F.expr(f"pmod(xxhash64(x), cast(ceil(k / {PART_ROWS}) as int))").alias("part")),
                 "stars")
    parts = saved(star.select("p", "part").distinct(), "star-parts")
    mark = F.pmod(F.xxhash64("doc_id", "hash"), F.lit(MARKS)) + 1
    who = saved(star.select(F.col("p").alias("rep")).union(star.select("x")).distinct().select("rep.*"), "star-ids")
    # hardly any text but those of star members moves: a bit filter of fixed size, then the exact join; an
    # inner join (the ids are distinct), because the optimizer would move a semi join ahead of the filter
    marks = who.select(mark.alias("mark")).groupBy(F.bitmap_bucket_number("mark").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("mark")).alias("bits"))
    marked = (base.where(F.col("doc_id").isNotNull()).withColumn("mark", mark)
                  .withColumn("part", F.bitmap_bucket_number("mark")).withColumn("at", F.bitmap_bit_position("mark"))
                  .join(F.broadcast(marks), "part")
                  .where("getbit(cast(conv(hex(substring(bits, cast(at div 8 as int) + 1, 1)), 16, 10) as int), cast(at % 8 as int)) = 1"))
    texts = (marked.select("doc_id", "hash", "text").join(who, ["doc_id", "hash"])
                 .groupBy("doc_id", "hash").agg(F.min("text").alias("text")).select(F.struct("doc_id", "hash").alias("rep"), "text"))
    with_x = star.join(texts.select(F.col("rep").alias("x"), F.col("text").alias("tx")), "x")
    pivots = parts.join(texts.select(F.col("rep").alias("p"), F.col("text").alias("tp")), "p")
    both = with_x.join(pivots, ["p", "part"])
    seen = saved(both.select("p", "x", "part", compared(F.col("tp"), F.col("tx"), shingle_words).alias("c")).select(
        "p", "x", "part", "c.*"), "compared")
    linked = F.expr(f"100 * common >= {similar_pct} * (np + nx - common)")
    direct = seen.where(linked).select(F.col("p.doc_id").alias("u"), F.col("x.doc_id").alias("v")).union(same)
    labels = components(direct)

    # stars that still hold several components: compare their members across components
    label_of = labels.select(F.col("node").alias("id"), F.col("label").alias("l"))
    members = seen.withColumn("id", F.col("x.doc_id")).join(label_of, "id", "left").withColumn(
        "label", F.coalesce("l", "id")).drop("id", "l")
    home = parts.withColumn("id", F.col("p.doc_id")).join(label_of.withColumnRenamed("l", "pl"), "id").drop("id")
    members = members.join(home, ["p", "part"], "left").withColumn("home", F.coalesce("pl", "p.doc_id")).drop("pl")
    members = saved(members.withColumn("out", F.col("label") != F.col("home")), "star-members")
    counts = members.groupBy("p").agg(F.count(F.lit(1)).alias("n_all"), F.sum(F.col("out").cast("int")).alias("n_out"))
    # a lone outsider has only members of the pivot's component to meet, or none
    mixed = counts.where((F.col("n_out") > 0) & (F.col("n_all") > 1)).select(
        "p", F.ceil(F.col("n_out") / STAR_LEFT).cast("int").alias("lb"),
        F.ceil(F.col("n_all") / STAR_ALL).cast("int").alias("rb"))
    m = members.join(parts.join(mixed, "p"), ["p", "part"]).withColumn("spread", F.xxhash64("x"))
    span = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    cols = ["p", F.col("x.doc_id").alias("x"), "label", "np", "nx", "miss", "extra"]
    outs = m.where("out").withColumn("i", F.expr("cast(pmod(spread, lb) as int)")).select(
        *cols, F.lit(0).alias("side"), "i", F.explode(span("rb")).alias("j"))
    alls = m.withColumn("j", F.expr("cast(pmod(spread, rb) as int)")).select(
        *cols, F.lit(1).alias("side"), F.explode(span("lb")).alias("i"), "j")

    def links(table: pa.Table) -> pa.Table:
        return _star_links(table, similar_pct)

    rest = saved(outs.unionByName(alls).groupBy("p", "i", "j").applyInArrow(links, "u long, v long"), "star-links")
    final = components(direct.union(rest))
    rep_label = classes.select("d0", "d1", F.col("rep.doc_id").alias("rep")).join(
        final.withColumnRenamed("node", "rep"), "rep", "left")
    rep_label = rep_label.select("d0", "d1", F.coalesce("label", "rep").alias("component"))
    return sig.join(rep_label, ["d0", "d1"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component"))
        .otherwise(F.col("doc_id")).alias("component_id"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: one document of each component, the one whose id
    is the component's, all of its rows being one. Rows with a null id stay."""
    keep = near_duplicates(docs, doc_id, text, **options).where(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id").alias(free_name(docs, "kept_id"))).distinct()
    key = keep.columns[0]
    return docs.join(keep, docs[doc_id].cast("long") == keep[key], "left").where(
        F.col(key).isNotNull() | docs[doc_id].isNull()).drop(key)
