"""Toxicity: embeddings of hashed character n-grams, averaged to words and then over a window of
words into a linear softmax. Embeddings and softmax are trained jointly in numpy.

A document is labelled as a whole, but few of its words are toxic, so training alternates: the
present model finds each document's highest window, and those windows (with further random ones of
clean documents) are the bags of the next epoch. A document's score is its highest window's.
Misspellings that were never seen share n-gram vectors with the words that were.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import subwords
from .common import below, clean_text, fold, hash_shares, materialize, released, sliced, stretch

SIZES = (3, 4, 5)


@dataclass
class Model:
    """``weights``: each bucket's vector times the difference of the softmax rows; ``bias`` likewise."""

    weights: np.ndarray
    bias: float
    bits: int
    window: int


def window_means(word: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean over every window of a text's words: means, first words, and the cut of each text's windows.

    A text with fewer words is one window; a text without words has none."""
    total = np.concatenate([[0.0], np.cumsum(word, dtype=np.float64)])
    size = np.diff(first)
    windows = np.where(size > 0, np.maximum(size - window, 0) + 1, 0)
    cuts = np.concatenate([[0], np.cumsum(windows)])
    starts = np.arange(cuts[-1]) - np.repeat(cuts[:-1] - first[:-1], windows)
    stops = np.minimum(starts + window, np.repeat(first[1:], windows))
    return (total[stops] - total[starts]) / np.maximum(stops - starts, 1), starts, cuts


def margins(model: Model, texts: list[str]) -> np.ndarray:
    """Each text's largest window margin; the bias alone where there is no word."""
    words = subwords.words_of(texts, digits=True)
    own, _, place = subwords.distinct(words)
    sums, counts = np.zeros(own.count), np.zeros(own.count, np.int64)
    for n in SIZES:
        at, bucket = subwords.ngrams(own, n, model.bits)
        more, number = subwords.sums_by_word(own, at, model.weights[bucket])
        sums += more
        counts += number
    means, _, cuts = window_means((sums / np.maximum(counts, 1))[place], words.first, model.window)
    out = np.zeros(len(texts))
    some = np.diff(cuts) > 0
    if some.any():
        out[some] = np.maximum.reduceat(means, cuts[:-1][some])
    return out + model.bias


def train(texts: list[str], labels: np.ndarray, bits: int = 17, dims: int = 8, window: int = 3, updates: int = 500,
          whole: float = 0.3, batch: int = 256, rate: float = 0.15, seed: int = 7) -> Model:
    """Joint training of the n-gram vectors and the softmax. Deterministic for equal input.

    About ``updates`` steps over bags of ``batch`` are made, the first ``whole`` of them (an epoch at
    least) over whole documents, since no window is known to be toxic yet."""
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, dtype=np.int64)
    vectors = rng.normal(0, 0.05, (1 << bits, dims)).astype(np.float32)
    rows = rng.normal(0, 0.3, (2, dims)).astype(np.float32)
    share = min(max(labels.mean(), 0.02), 0.98) if len(labels) else 0.02
    bias = np.log(np.array([1 - share, share], np.float32))
    if not len(set(labels.tolist())) > 1:
        return Model(np.zeros(1 << bits, np.float32), float(bias[1] - bias[0]), bits, window)
    known = subwords.vocabulary(texts, SIZES, bits, digits=True)
    first, counts = known.first, np.diff(known.cuts)
    seen = [np.full_like(vectors, 1e-8), np.full_like(rows, 1e-3), np.full_like(bias, 1e-3)]
    has = np.flatnonzero(np.diff(first) > 0)
    clean = has[labels[has] == 0]
    early = max(1, round(whole * updates * batch / len(has)))
    epochs = early + max(2, round((1 - whole) * updates * batch / (len(has) + len(clean))))
    for epoch in range(epochs):
        if epoch < early:
            begin, end, owner = first[:-1][has], first[1:][has], has
        else:
            score = np.concatenate([[0.0], np.cumsum((vectors @ (rows[1] - rows[0]))[known.bucket], dtype=np.float64)])
            word = (score[known.cuts[1:]] - score[known.cuts[:-1]]) / np.maximum(counts, 1)
            means, starts, wcuts = window_means(word[known.text], first, window)
            top = np.array([starts[a + int(np.argmax(means[a:b]))] for a, b in zip(wcuts[:-1][has], wcuts[1:][has])])
            size = np.diff(wcuts)[clean]
            other = starts[wcuts[:-1][clean] + (rng.random(len(clean)) * size).astype(np.int64)]
            owner = np.concatenate([has, clean])
            begin = np.concatenate([top, other])
            end = np.minimum(begin + window, first[1:][owner])
        order = rng.permutation(len(owner))
        step = rate * (1 - 0.8 * epoch / epochs)
        for i in range(0, len(order), batch):
            chosen = order[i:i + batch]
            length = end[chosen] - begin[chosen]
            edge = np.concatenate([[0], np.cumsum(length)])
            words = known.text[np.arange(edge[-1]) + np.repeat(begin[chosen] - edge[:-1], length)]
            ids, parts = known.spans(words)
            bag = np.repeat(np.repeat(np.arange(len(chosen)), length), parts)
            part = np.repeat((1 / np.maximum(parts, 1) / np.repeat(length, length)).astype(np.float32), parts)
            starts_at = np.searchsorted(bag, np.arange(len(chosen)))
            mean = np.add.reduceat(vectors[ids] * part[:, None], starts_at, axis=0)
            logits = mean @ rows.T + bias
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), labels[owner[chosen]]] -= 1
            p /= len(chosen)
            back = p @ rows
            touched, place = np.unique(ids, return_inverse=True)
            grad = np.stack([np.bincount(place, back[bag, d] * part, len(touched)) for d in range(dims)], axis=1)
            for value, g, s, where in ((vectors, grad, seen[0], touched), (rows, p.T @ mean, seen[1], slice(None)),
                                       (bias, p.sum(axis=0), seen[2], slice(None))):
                s[where] += g * g
                value[where] -= step * g / np.sqrt(s[where])
    return Model(vectors @ (rows[1] - rows[0]), float(bias[1] - bias[0]), bits, window)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int, budget: int, longest: int,
                    id_col: str = "doc_id", text_col: str = "text") -> pd.DataFrame:
    """Texts of each label (0 and 1), at most ``max_rows`` and about ``budget`` code points of each, in an order hashed from
    the text, of rows with crc32(id) mod 3 other than 1. No text is left out for its length: one of more than ``longest`` code
    points gives a stretch of so many, at a place hashed from it. An id with both labels counts as 1.

    Rows are chosen by a threshold on their hash that follows from a count of the labelled texts, by ids and sizes alone; then
    the texts of the chosen ids are read, so no text but the sample's moves. The driver holds at most ``2 * max_rows`` texts."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")) \
        .where(F.col("_label").isin(0, 1) & (fold("_id", 3) != 1)).groupBy("_id").agg(F.max("_label").alias("_label"))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_whole"), F.xxhash64(text_col, id_col).alias("_order")) \
        .where((fold("_id", 3) != 1) & F.col("_whole").isNotNull())
    sizes = texts.select("_id", "_order", F.least(F.length("_whole"), F.lit(longest)).alias("_size")).join(known, "_id")
    chosen = None
    for k, share in sorted(hash_shares(sizes, "_label", budget, max_rows).items()):
        own = sizes.where((F.col("_label") == k) & below("_order", share)).orderBy("_order", "_id").limit(max_rows)
        chosen = own if chosen is None else chosen.unionByName(own)
    if chosen is None:
        return pd.DataFrame({"_text": [], "_label": np.zeros(0, np.int64), "_order": []})
    chosen = F.broadcast(materialize(chosen.select("_id", "_order", "_label").distinct(), "labelled-sample"))  # ids of the sample alone
    return texts.join(chosen, ["_id", "_order"]).select(stretch("_whole", longest).alias("_text"), "_label", "_order") \
        .sort("_order", "_text").limit(2 * max_rows).toPandas()


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id",
                   text_col: str = "text", slice_bytes: int = 1 << 21) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, score, predicted`` from the text alone.

    Null and empty texts, and texts without a word, get the score of the bias. Repeated rows are
    scored alike; other columns are ignored; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", slice_bytes):
            margin = margins(shared.value, batch.column("text").to_pylist())
            score = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    rows = docs.select(docs[id_col].alias("doc_id"), clean_text(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(released(run), f"doc_id {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text",
               slice_bytes: int = 1 << 21) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns, in one pass.

    Null, empty and wordless texts score the bias; where the model tells nothing apart (one label) all rows stay. Long texts are
    read whole, repeated rows and null ids are judged each by their text, an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    limit = float(np.log(threshold / (1 - threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col, slice_bytes):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(margins(shared.value, texts) < limit))

    return docs.mapInArrow(released(run), docs.schema)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_rows: int = 3000,
                 budget: int = 3_000_000, longest: int = 20_000, **options) -> Model:
    """Trains on a bounded sample of the labelled rows (see ``labelled_sample``): ``max_rows`` texts and about ``budget`` code
    points a label, at any input size. With one label or none there is nothing to tell apart: all texts get the same score."""
    sample = labelled_sample(docs, labels, label_col, max_rows, budget, longest)
    return train(sample["_text"].tolist(), sample["_label"].to_numpy(), **options)


def detect_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Fits on the labelled rows outside the held-out fold and scores every row:
    ``doc_id, held_out, score, predicted``."""
    scored = score_toxicity(docs, fit_toxicity(docs, labels), threshold)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")
