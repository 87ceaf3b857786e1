"""Toxicity by classifier chains (operator 5).

Categories are predicted one after the other by logistic regression over hashed words. Each model
also sees the probabilities of the categories before it. For training, those come out of fold: every
labelled document gets them from a model fitted without its fold, so later models learn from
probabilities as unsure as the ones they meet on new documents. The models of all folds of a category
are fitted side by side, one Spark task each, on a bounded sample of labelled documents.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, byte_class, find_words, hash_words, saved, slices, text_buffer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIT_ROWS = 20_000             # labelled documents the chain is fitted on, at most
FEATURE_BITS = 17
FOLDS = 3
ITERATIONS = 60
PENALTY = 1e-4
# chain order: category and the condition on a label row that makes it true
CHAIN = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))

LETTER = byte_class((0x61, 0x7A), (0x80, 0xFF))


def word_features(arr: pa.Array, bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed words (letter runs, A-Z lower-cased) of each text and the texts' offsets."""
    raw, off = text_buffer(arr)
    buf = LOWER[raw]
    start, end, first = find_words(buf, off, LETTER)
    f = (hash_words(buf, start, end) >> np.uint64(64 - bits)).astype(np.int64)
    key = np.sort(np.repeat(np.arange(len(off) - 1), np.diff(first)) << bits | f)
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    return key & ((1 << bits) - 1), np.searchsorted(key >> bits, np.arange(len(off)))


def sums(w: np.ndarray, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``w[ids]`` over each row's range of ``ids``."""
    c = np.concatenate(([0.0], np.cumsum(w[ids])))
    return c[first[1:]] - c[first[:-1]]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(ids: np.ndarray, first: np.ndarray, extra: np.ndarray, y: np.ndarray, size: int,
                 penalty: float = PENALTY, iterations: int = ITERATIONS) -> np.ndarray:
    """Weights ``[words..., extra..., intercept]`` of the L2-penalised logistic regression, by L-BFGS.
    The intercept is not penalised; with one class only it carries the whole prediction."""
    n, k = len(y), extra.shape[1]
    counts = np.diff(first)

    def value(w):
        z = sums(w[:size], ids, first) + extra @ w[size:size + k] + w[-1]
        loss = np.mean(np.logaddexp(0, z) - y * z) + penalty / 2 * float(w[:-1] @ w[:-1])
        r = (sigmoid(z) - y) / n
        g = np.concatenate((np.bincount(ids, np.repeat(r, counts), size), extra.T @ r, [r.sum()]))
        g[:-1] += penalty * w[:-1]
        return loss, g

    w = np.zeros(size + k + 1)
    share = np.clip(y.mean(), 1 / (n + 1), n / (n + 1))
    w[-1] = np.log(share / (1 - share))
    loss, g = value(w)
    past: list = []
    for _ in range(iterations):
        d, alphas = -g, []
        for s, t, rho in reversed(past):
            a = rho * (s @ d)
            alphas.append(a)
            d = d - a * t
        if past:
            s, t, _ = past[-1]
            d = d * ((s @ t) / (t @ t))
        for (s, t, rho), a in zip(past, reversed(alphas)):
            d = d + (a - rho * (t @ d)) * s
        slope, step = g @ d, 1.0
        while True:
            new = w + step * d
            new_loss, new_g = value(new)
            if new_loss <= loss + 1e-4 * step * slope or step < 1e-8:
                break
            step /= 2
        s, t = new - w, new_g - g
        w, moved, loss, g = new, loss - new_loss, new_loss, new_g
        if s @ t > 1e-12:
            past = [*past[-9:], (s, t, 1.0 / (s @ t))]
        if moved < 1e-7 * max(1.0, abs(loss)):
            break
    return w


def _rows(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a column of integer lists."""
    a = lists.combine_chunks()
    counts = pa.compute.list_value_length(a).to_numpy()
    return a.flatten().to_numpy(), np.concatenate(([0], np.cumsum(counts)))


def _probability(weights: np.ndarray, ids: np.ndarray, first: np.ndarray, before: list[np.ndarray],
                 size: int) -> np.ndarray:
    z = sums(weights[:size], ids, first) + weights[-1]
    for w, p in zip(weights[size:-1], before):
        z = z + w * p
    return sigmoid(z)


def fit_chain(docs: DataFrame, labels: DataFrame, chain=CHAIN, doc_id: str = "doc_id", text: str = "text",
              fit_rows: int = FIT_ROWS, bits: int = FEATURE_BITS, folds: int = FOLDS) -> list[np.ndarray]:
    """Weights of the chain's models, in order. Fitted on at most ``fit_rows`` labelled documents of
    ``docs``, those whose ids hash lowest; without any there is no model (an empty list). Labels of
    other documents do not count, and rows that share an id are one document (the least text)."""
    size = 1 << bits
    ids = (labels.select(F.col(f"`{doc_id}`").alias("doc_id"),
                         *(F.coalesce(F.expr(cond), F.lit(False)).cast("double").alias(f"y{i}")
                           for i, (_, cond) in enumerate(chain)))
                 .where("doc_id is not null").groupBy("doc_id").agg(*(F.max(f"y{i}").alias(f"y{i}")
                                                                      for i in range(len(chain))))
                 .join(docs.select(F.col(f"`{doc_id}`").alias("doc_id")), "doc_id", "left_semi")
                 .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))

    @F.arrow_udf("array<int>")
    def features(arr: pa.Array) -> pa.Array:
        out = []
        for lo, hi in slices(arr):
            f, first = word_features(arr[lo:hi], bits)
            out.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(f, pa.int32())))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))

    # the id side has at most fit_rows rows, so texts need not be shuffled
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).join(
        F.broadcast(ids), "doc_id")
    ys = [f"y{i}" for i in range(len(chain))]
    rows = rows.groupBy("doc_id", *ys).agg(F.min("text").alias("text"))
    data = saved(rows.select("doc_id", *ys, features.asNondeterministic()(F.col("text")).alias("x"),
                             F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)).cast("int").alias("fold")),
                 "toxicity-fit")
    if data.isEmpty():
        return []
    models: list[np.ndarray] = []
    for i in range(len(chain)):
        ps = [f"p{j}" for j in range(i)]
        last = i == len(chain) - 1

        # model k leaves fold k out; model ``folds`` uses all rows
        which = F.array(F.lit(folds)) if last else F.filter(F.sequence(F.lit(0), F.lit(folds)),
                                                            lambda k: k != F.col("fold"))
        fitted = {r["model"]: np.array(r["w"]) for r in data.withColumn("model", F.explode(which))
                  .groupBy("model").applyInArrow(_fitter(f"y{i}", ps, size), "model int, w array<double>").collect()}
        models.append(fitted[folds])
        if not last:
            before = F.array(*(F.col(p) for p in ps)) if ps else F.array().cast("array<double>")
            data = data.withColumn(f"p{i}", _held_out(fitted, size)("fold", "x", before))
            data = saved(data, "toxicity-fit")
    return models


def _fitter(y: str, before: list[str], size: int):
    """Group function: one model from the sample rows it may see, in id order."""

    def fit(part: pa.Table) -> pa.Table:
        part = part.sort_by("doc_id")
        f, first = _rows(part["x"])
        extra = np.stack([part[p].to_numpy() for p in before], axis=1) if before else np.zeros((len(part), 0))
        w = fit_logistic(f, first, extra, part[y].to_numpy(), size)
        return pa.table({"model": pa.array([part["model"][0].as_py()], pa.int32()), "w": pa.array([w.tolist()])})

    return fit


def _held_out(fitted: dict[int, np.ndarray], size: int):
    """UDF of a sample row's probability by the model that was fitted without its fold."""

    @F.arrow_udf("double")
    def predict(fold: pa.Array, x: pa.Array, before: pa.Array) -> pa.Array:
        f, first = _rows(pa.chunked_array([x]))
        known = before.flatten().to_numpy().reshape(len(fold), -1).T
        at, p = fold.to_numpy(), np.full(len(fold), 0.5)      # 0.5: never left, every row is in a fold
        for k, w in fitted.items():
            p = np.where(at == k, _probability(w, f, first, list(known), size), p)
        return pa.array(p)

    return predict.asNondeterministic()


def probabilities(models: list[np.ndarray], text: Column, bits: int = FEATURE_BITS) -> Column:
    """Array of the chain's probabilities for a text column; 0 for texts without words."""

    @F.arrow_udf("array<double>")
    def predict(arr: pa.Array) -> pa.Array:
        out = [np.zeros((0, len(models)))]
        for lo, hi in slices(arr):
            f, first = word_features(arr[lo:hi], bits)
            before: list[np.ndarray] = []
            for w in models:
                before.append(_probability(w, f, first, before, 1 << bits))
            some = np.diff(first) > 0
            out.append(np.where(some[:, None], np.stack(before, axis=1), 0.0) if models
                       else np.zeros((hi - lo, 0)))
        flat = np.concatenate(out)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * len(models), pa.int32()),
                                        pa.array(flat.ravel()))

    return predict.asNondeterministic()(text)


def toxicity(docs: DataFrame, labels: DataFrame, chain=CHAIN, doc_id: str = "doc_id", text: str = "text",
             out: str = "toxicity", bits: int = FEATURE_BITS, **options) -> DataFrame:
    """Every row of ``docs`` (all columns kept) with a struct ``out``: ``p_<category>`` and the verdict
    ``<category>`` (probability 0.5 or more) for each category of the chain.

    Null, empty and wordless texts have probability 0, and so have all texts when no label belongs to
    a document. Null label values count as false, repeated labels as true if one is; labels without a
    document are left out. A column of ``docs`` named ``out`` is replaced.
    """
    models = fit_chain(docs, labels, chain, doc_id, text, bits=bits, **options)
    df = docs.withColumn(out, probabilities(models, F.col(f"`{text}`"), bits))
    p = [F.coalesce(F.get(F.col(f"`{out}`"), F.lit(i)), F.lit(0.0)) for i in range(len(chain))]
    return df.withColumn(out, F.struct(*(x.alias(f"p_{c}") for x, (c, _) in zip(p, chain)),
                                       *((x >= 0.5).alias(c) for x, (c, _) in zip(p, chain))))
