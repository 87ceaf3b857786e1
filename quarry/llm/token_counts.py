"""Edit-aware token counts (operator 3).

A byte-pair tokenizer first cuts a text into pre-tokens and encodes each alone, so a document's
token count is a sum over its pre-tokens. Each document keeps a tree of such sums: pre-tokens in
blocks of ``BLOCK``, and levels of sums over ``FAN`` children above; all of it is stored. The edits of a
document are taken in one pass from left to right: each finds its first pre-token by descending the
character sums, re-splits from a few characters before it until the new cuts meet an old cut again
and re-encodes that stretch alone. Each touched block then adds its difference to the sums above it.

Pre-token cuts depend on what follows by a few characters only and never on what came before, so
the stretch beyond the meeting point is cut as it was.
"""

from __future__ import annotations

import base64
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LOOKAHEAD = 4              # characters past a pre-token that can change where it ends
BLOCK, FAN = 64, 16
CACHE = 1 << 17            # pre-tokens whose counts a task remembers


class Counter(dict):
    """Token count by pre-token; unknown ones are encoded and remembered."""

    def __init__(self, vocabulary: bytes):
        import regex
        import tiktoken
        ranks = {base64.b64decode(t): int(r) for t, r in (x.split() for x in vocabulary.splitlines() if x)}
        self.encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(PATTERN)

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        n = self[piece] = len(self.encoding.encode_ordinary(piece))
        return n

    def pieces(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Length in characters and token count of every pre-token."""
        found = self.pattern.findall(text)
        return (np.fromiter(map(len, found), np.int64, len(found)),
                np.fromiter(map(self.__getitem__, found), np.int64, len(found)))


def small(x: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest width, which the first byte names."""
    top = int(x.max()) if len(x) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def large(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=f"<u{blob[0]}", offset=1).astype(np.int64)


class Tree:
    """Pre-tokens ``(chars, tokens)`` in blocks, with levels of sums; the last level is the root."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray, sizes: np.ndarray | None = None,
                 levels: list[np.ndarray] | None = None):
        self.chars, self.tokens = chars, tokens
        if sizes is None:
            n = len(chars)
            sizes = np.diff(np.append(np.arange(0, n, BLOCK), n)) if n else np.zeros(1, np.int64)
        self.sizes = sizes                                  # pre-tokens per block; an edit may change it
        if levels is None:
            at = np.concatenate(([0], np.cumsum(sizes)))
            total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[at])
            levels = [np.stack((total(chars), total(tokens)))]
            while levels[-1].shape[1] > 1:
                levels.append(np.add.reduceat(levels[-1], np.arange(0, levels[-1].shape[1], FAN), axis=1))
        self.levels = levels

    @property
    def n_tokens(self) -> int:
        return int(self.levels[-1][1, 0])

    def find(self, pos: int) -> tuple[int, int]:
        """Block that holds character ``pos`` (the last block past the end) and the block's first
        character, by descent from the root."""
        node, start = 0, 0
        for level in reversed(self.levels[:-1]):
            node *= FAN
            sums = level[0, node:node + FAN].tolist()
            for k, x in enumerate(sums):
                if start + x > pos or k + 1 == len(sums):
                    break
                start += x
            node += k
        return node, start

    def replace(self, changed: dict[int, tuple[list[int], list[int]]]) -> None:
        """Put new pre-tokens ``block -> (chars, tokens)`` in the place of those blocks' old ones and add
        the differences to the sums above. When an edit has made a block outgrow ``8 * BLOCK``, or most
        blocks are nearly empty, all are cut anew."""
        blocks = np.array(sorted(changed), dtype=np.int64)
        first = np.concatenate(([0], np.cumsum(self.sizes)))
        leaves = []
        for which, old in ((0, self.chars), (1, self.tokens)):
            parts, at = [], 0
            for b in blocks.tolist():
                parts += (old[at:first[b]], np.array(changed[b][which], dtype=np.int64))
                at = int(first[b + 1])
            leaves.append(np.concatenate(parts + [old[at:]]))
        self.chars, self.tokens = leaves
        self.sizes = self.sizes.copy()
        self.sizes[blocks] = [len(changed[b][0]) for b in blocks.tolist()]
        if int(self.sizes.max()) > 8 * BLOCK or len(self.sizes) * BLOCK > 8 * (len(self.chars) + BLOCK):
            self.__init__(*leaves)
            return
        now = np.array([[sum(changed[b][which]) for b in blocks.tolist()] for which in (0, 1)], dtype=np.int64)
        grown, node = now - self.levels[0][:, blocks], blocks
        self.levels = [x.copy() for x in self.levels]
        for level in self.levels:
            np.add.at(level, (slice(None), node), grown)
            node = node // FAN

    def pack(self) -> tuple[int, bytes, bytes, bytes, bytes]:
        return (self.n_tokens, small(self.chars), small(self.tokens), small(self.sizes),
                small(np.concatenate([x.ravel() for x in self.levels])))


def unpack(chars: bytes, tokens: bytes, sizes: bytes, sums: bytes) -> Tree:
    flat, widths = large(sums), [len(large(sizes))]
    while widths[-1] > 1:
        widths.append(-(-widths[-1] // FAN))
    ends = 2 * np.cumsum(widths)
    levels = [flat[e - 2 * w:e].reshape(2, w) for e, w in zip(ends.tolist(), widths)]
    return Tree(large(chars), large(tokens), large(sizes), levels)


class Walk:
    """One pass over the old pre-tokens from left to right. ``at`` is the character reached; blocks
    that nothing touches are passed by descent and never opened."""

    def __init__(self, tree: Tree):
        self.tree = tree
        self.first = np.concatenate(([0], np.cumsum(tree.sizes)))
        self.made: dict[int, tuple[list[int], list[int]]] = {}
        self.open(0, 0)

    def open(self, block: int, at: int) -> None:
        lo, hi = int(self.first[block]), int(self.first[block + 1])
        self.block, self.at, self.i = block, at, 0
        self.chars, self.tokens = self.tree.chars[lo:hi].tolist(), self.tree.tokens[lo:hi].tolist()
        self.end = at + int(self.tree.levels[0][0, block])
        self.out = self.made[block] = ([], [])

    @property
    def last(self) -> bool:
        return self.block + 1 == len(self.tree.sizes)

    def keep(self, n: int) -> None:
        self.out[0].extend(self.chars[self.i:self.i + n])
        self.out[1].extend(self.tokens[self.i:self.i + n])
        self.i = min(self.i + n, len(self.chars))

    def keep_to(self, pos: int) -> None:
        """Keep all pre-tokens that end at ``pos`` or before."""
        if self.end <= pos and not self.last:
            self.keep(len(self.chars))
            self.open(*self.tree.find(pos))
        n = 0
        for x in self.chars[self.i:]:
            if self.at + x > pos:
                break
            self.at += x
            n += 1
        self.keep(n)

    def drop_to(self, pos: int) -> None:
        """Drop pre-tokens until ``at`` is ``pos`` or beyond."""
        while self.at < pos:
            if self.i < len(self.chars):
                self.at += self.chars[self.i]
                self.i += 1
            else:
                self.open(self.block + 1, self.at)

    def put(self, chars: int, tokens: int) -> None:
        self.out[0].append(chars)
        self.out[1].append(tokens)

    def close(self) -> None:
        self.keep(len(self.chars))
        self.tree.replace(self.made)


def in_order(edits, length: int) -> tuple[list[tuple[int, int, str]], int]:
    """Edits by (start, end, replacement) and how many were refused: those without a start or an end,
    those that do not lie in the text, and those that begin before the end of the edit taken before."""
    usable = [(e[0], e[1], e[2] or "") for e in edits if e is not None and e[0] is not None and e[1] is not None]
    taken, done = [], 0
    for e in sorted(usable):
        if done <= e[0] <= e[1] <= length:
            taken.append(e)
            done = e[1]
    return taken, len(edits) - len(taken)


def apply_edits(tree: Tree, text: str, edits: list[tuple[int, int, str]], counter: Counter) -> tuple[str, int, int]:
    """Apply edits ``(start, end, replacement)`` to text and tree in one pass from left to right.
    Returns the new text, the number of characters encoded again and the number of edits refused (see
    ``in_order``)."""
    taken, refused = in_order(edits, len(text))
    if not taken:
        return text, 0, refused
    parts, done = [], 0
    for start, end, new in taken:
        parts += (text[done:start], new)
        done = end
    changed = "".join(parts + [text[done:]])
    old, match = Walk(tree), counter.pattern.match
    k, shift, encoded = 0, 0, 0            # shift: how far the edits passed move what follows them
    while k < len(taken):
        # pre-tokens whose end no edit can move stay
        old.keep_to(taken[k][0] - LOOKAHEAD)
        pos = begin = old.at + shift
        end = old.at
        absorb = True                      # the stretch holds its first edit and all that begin before its end
        while True:
            while k < len(taken) and (absorb or taken[k][0] + shift <= pos):
                end = taken[k][1]
                shift += len(taken[k][2]) - (end - taken[k][0])
                k, absorb = k + 1, False
            old.drop_to(max(pos - shift, end))
            if old.at == pos - shift and old.at >= end:
                break                      # an old cut again: the rest stands up to the next edit
            m = match(changed, pos)
            old.put(m.end() - pos, counter[m.group()])
            pos = m.end()
        encoded += pos - begin
    old.close()
    return changed, encoded, refused


def vocabulary(spark: SparkSession, path: str = VOCABULARY):
    """The vocabulary file as a broadcast of its bytes (under a megabyte); read on the driver."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


TREE = "struct<n_tokens:long,chars:binary,tokens:binary,sizes:binary,sums:binary>"
RECOUNT = ("struct<n_tokens:long,n_encoded:long,n_refused:long,text:string,chars:binary,tokens:binary,"
           "sizes:binary,sums:binary>")
LEAVES = [pa.field(c, pa.binary()) for c in ("chars", "tokens", "sizes", "sums")]
TREE_ARROW = pa.struct([pa.field("n_tokens", pa.int64()), *LEAVES])
RECOUNT_ARROW = pa.struct([pa.field("n_tokens", pa.int64()), pa.field("n_encoded", pa.int64()),
                           pa.field("n_refused", pa.int64()), pa.field("text", pa.string()), *LEAVES])


def build_trees(text: Column, vocab) -> Column:
    """Tree of each text of a column; null, like the empty text, has an empty tree."""

    @F.arrow_udf(TREE)
    def build(arr: pa.Array) -> pa.Array:
        counter = _counter(vocab)
        rows = [Tree(*counter.pieces(t or "")).pack() for t in (x.as_py() for x in arr)]
        return pa.array([dict(zip(TREE_ARROW.names, r)) for r in rows], TREE_ARROW)

    return build.asNondeterministic()(text)


_COUNTERS: dict = {}


def _counter(vocab) -> Counter:
    """One counter per task."""
    if "c" not in _COUNTERS:
        _COUNTERS["c"] = Counter(vocab.value)
    return _COUNTERS["c"]


def recount(text: Column, tree: Column, edits: Column, vocab, keep_text: bool = True) -> Column:
    """Apply ``edits`` (array of ``(start, end, new)``, code points) to text and tree: new count,
    characters encoded again, edits refused, new text (null unless ``keep_text``) and tree. Null or no
    edits change nothing; a null ``new`` removes. Edits go by start, then end, then replacement; one that
    lacks a start or end, lies outside the text or begins inside the edit before it is refused."""

    @F.arrow_udf(RECOUNT)
    def update(texts: pa.Array, trees: pa.Array, edits: pa.Array) -> pa.Array:
        counter, rows = _counter(vocab), []
        for t, tr, ed in zip(texts, trees, edits):
            old = tr.as_py()
            changes = ed.as_py()
            leaves = tuple(old[f.name] for f in LEAVES)
            if not changes:
                rows.append((old["n_tokens"], 0, 0, t.as_py() if keep_text else None, *leaves))
                continue
            node = unpack(*leaves)
            new, encoded, refused = apply_edits(
                node, t.as_py() or "", [e and (e["start"], e["end"], e["new"]) for e in changes], counter)
            n, *leaves = node.pack()
            rows.append((n, encoded, refused, new if keep_text else None, *leaves))
        return pa.array([dict(zip(RECOUNT_ARROW.names, r)) for r in rows], RECOUNT_ARROW)

    return update.asNondeterministic()(text, tree, edits)


def matches(text: Column, pattern: str, new: str) -> Column:
    """Edits that replace every match of a Python pattern by ``new``; null texts have none."""

    @F.arrow_udf("array<struct<start:int,end:int,new:string>>")
    def find(arr: pa.Array) -> pa.Array:
        import re
        rx = re.compile(pattern)
        return pa.array([[{"start": m.start(), "end": m.end(), "new": new} for m in rx.finditer(t or "")]
                         for t in (x.as_py() for x in arr)],
                        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("new", pa.string())])))

    return find.asNondeterministic()(text)


def count_tokens(docs: DataFrame, text: str = "text", out: str = "tree", path: str = VOCABULARY) -> DataFrame:
    """Every row of ``docs`` (all columns kept) with its tree in ``out``; ``out.n_tokens`` is the count.
    Null and empty texts count 0 tokens. Repeated rows are counted alike, row by row. A column of ``docs``
    named ``out`` is replaced."""
    return docs.withColumn(out, build_trees(F.col(f"`{text}`"), vocabulary(docs.sparkSession, path)))


def recount_tokens(counted: DataFrame, edits: str, text: str = "text", tree: str = "tree", out: str = "edited",
                   path: str = VOCABULARY, keep_text: bool = True) -> DataFrame:
    """Every row of ``counted`` with ``out``: text (if kept) and tree after the edits in column ``edits``, as in
    ``recount``. Rows stand alone, so repeated ones may have edits of their own."""
    vocab = vocabulary(counted.sparkSession, path)
    return counted.withColumn(out, recount(F.col(f"`{text}`"), F.col(f"`{tree}`"), F.col(f"`{edits}`"), vocab, keep_text))
