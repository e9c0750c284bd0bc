"""Language identification by a linear-chain conditional random field over words.

Each word is scored by hashed affixes and inner n-grams and by lexicons of the languages; learned
transitions tie neighbours together. Forward-backward gives each word's marginals, also in
code-switched text; a text's language is the one with the largest sum of marginals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import subwords
from .common import STEPS, fold, hash_shares, released, sliced, stretch

SIZES = (2, 3, 4)
UNKNOWN = "und"


@dataclass
class Model:
    """``grams``: weights by bucket and language; ``lexicon``: sorted word codes, ``member`` the
    languages whose lexicon holds each; ``lex`` weights of membership; ``trans`` transitions."""

    langs: list[str]
    grams: np.ndarray
    lexicon: np.ndarray
    member: np.ndarray
    lex: np.ndarray
    bias: np.ndarray
    trans: np.ndarray
    bits: int


def membership(model: Model, code: np.ndarray) -> np.ndarray:
    """For each word's code the languages whose lexicon holds it."""
    out = np.zeros((len(code), len(model.langs)), np.float32)
    if len(model.lexicon) and len(code):
        at = np.minimum(np.searchsorted(model.lexicon, code), len(model.lexicon) - 1)
        hit = model.lexicon[at] == code
        out[hit] = model.member[at[hit]]
    return out


def emissions(model: Model, words: subwords.Words) -> np.ndarray:
    """Score of each language for each word: the mean of its n-gram weights, its lexicons, a bias."""
    own, code, place = subwords.distinct(words)
    out = np.zeros((own.count, len(model.langs)))
    counts = np.zeros(own.count, np.int64)
    for n in SIZES:
        at, bucket = subwords.ngrams(own, n, model.bits)
        for k in range(len(model.langs)):
            sums, number = subwords.sums_by_word(own, at, model.grams[k][bucket])
            out[:, k] += sums
        counts += number
    return (out / np.maximum(counts, 1)[:, None] + membership(model, code) @ model.lex + model.bias)[place]


def marginals(scores: np.ndarray, trans: np.ndarray, first: np.ndarray, block: int = 32) -> np.ndarray:
    """Exact marginals of chains laid end to end; chain i is scores[first[i]:first[i + 1]].

    Chains are cut into blocks. The products of a block's matrices carry the forward and backward
    messages over whole blocks, so all blocks of all chains advance together and a chain
    of n words costs n / block + block steps. Blocks are padded with identity steps."""
    size, k = np.diff(first), scores.shape[1]
    out = np.zeros_like(scores)
    if not len(scores):
        return out
    blocks = -(-size // block)
    edge = np.concatenate([[0], np.cumsum(blocks)])
    inside = np.arange(edge[-1]) - np.repeat(edge[:-1], blocks)
    begin = np.repeat(first[:-1], blocks) + inside * block
    at = begin[:, None] + np.arange(block)
    real = at < np.repeat(first[1:], blocks)[:, None]
    at[~real] = 0
    emit = np.ascontiguousarray(np.exp(scores - scores.max(axis=1, keepdims=True))[at].transpose(1, 0, 2))
    real = np.ascontiguousarray(real.T)[:, :, None]  # place, block, 1
    move = np.exp(trans - trans.max())
    opens = np.zeros((len(begin), 1), bool)
    opens[edge[:-1][size > 0]] = True  # a chain's first word has no transition

    def scaled(a: np.ndarray) -> np.ndarray:
        return a / a.sum(axis=-1, keepdims=True)

    def forward(a: np.ndarray, t: int, wide: int = 1) -> np.ndarray:
        """One step of messages (block, language), or of ``wide`` messages a block."""
        def each(x: np.ndarray) -> np.ndarray:
            return x if wide == 1 else np.repeat(x, wide, axis=0)
        moved = a @ move
        if not t:
            moved = np.where(each(opens), a.sum(axis=1, keepdims=True) / k, moved)
        moved *= each(emit[t])
        return np.where(each(real[t]), moved, a)

    whole = np.tile(np.eye(k), (len(begin), 1))
    for t in range(block):
        whole = forward(whole, t, k)
        if t % 8 == 7:
            whole = whole.reshape(-1, k * k)
            whole = (whole / whole.max(axis=1, keepdims=True)).reshape(-1, k)
    whole = whole.reshape(-1, k, k)
    ahead = np.full((len(begin), k), 1 / k)  # message that enters a block
    behind = np.full((len(begin), k), 1 / k)  # message from behind a block
    order = np.argsort(-blocks, kind="stable")
    longest = int(blocks.max(initial=0))
    more = np.searchsorted(-blocks[order], -np.arange(longest + 1), side="left")  # chains with over j blocks
    for j in range(1, longest):
        own = edge[:-1][order[:more[j]]] + j
        ahead[own] = scaled(np.einsum("ci,cij->cj", ahead[own - 1], whole[own - 1]))
        own = edge[1:][order[:more[j]]] - 1 - j
        behind[own] = scaled(np.einsum("cij,cj->ci", whole[own + 1], behind[own + 1]))
    alphas, a = [], ahead
    for t in range(block):
        a = scaled(forward(a, t))
        alphas.append(a)
    got, b = np.empty((block, len(begin), k)), behind
    for t in range(block - 1, -1, -1):
        got[t] = scaled(alphas[t] * b)
        b = np.where(real[t], scaled((emit[t] * b) @ move.T), b)
    keep = real[:, :, 0].T
    out[at[keep]] = got.transpose(1, 0, 2)[keep]
    return out


def train(texts: list[str], langs: list[str], bits: int = 16, length: int = 48, switches: int = 3, chains: int = 6000,
          epochs: int = 12, batch: int = 500, rate: float = 0.2, seed: int = 11) -> Model:
    """Fits n-gram, lexicon, bias and transition weights by the gradient of the chains' likelihood.

    The chains are code-switched: up to ``switches`` stretches of words of texts in their languages,
    ``length`` words in all. Deterministic for equal input."""
    names = sorted(set(langs))
    k = len(names)
    model = Model(names, np.zeros((k, 1 << bits), np.float32), np.empty(0, np.uint64), np.zeros((0, k), np.float32),
                  np.zeros((k, k), np.float32), np.zeros(k), np.zeros((k, k)), bits)
    known = subwords.vocabulary(texts, SIZES, bits)
    if k < 2 or not len(known.text):
        return model
    size = np.diff(known.first)
    label = np.repeat([names.index(x) for x in langs], size)
    seen = np.stack([np.bincount(known.text[label == j], minlength=len(known.codes)) for j in range(k)], axis=1)
    often = seen.sum(axis=1) >= 5
    share = (seen + 0.1) / (seen.sum(axis=0) + 1)
    model.lexicon = known.codes[often]
    model.member = (share[often] >= 0.5 * share[often].max(axis=1, keepdims=True)).astype(np.float32)

    rng = np.random.default_rng(seed)
    some = np.flatnonzero(size > 0)
    lang_of = np.array([names.index(x) for x in langs])
    by_lang = [own for j in range(k) if len(own := some[lang_of[some] == j])]
    picks = np.empty((chains, length), np.int64)
    for c in range(chains):
        cuts = np.sort(rng.choice(np.arange(4, length - 3), rng.integers(0, switches + 1), replace=False))
        for a, b in zip([0, *cuts], [*cuts, length]):
            own = by_lang[rng.integers(len(by_lang))]
            t = own[rng.integers(len(own))]
            lo, hi = known.first[t], known.first[t + 1]
            at = rng.integers(lo, max(lo + 1, hi - (b - a) + 1))
            picks[c, a:b] = np.minimum(at + np.arange(b - a), hi - 1)
    chain = known.text[picks]
    member = membership(model, known.codes)
    count = np.diff(known.cuts)
    gold = label[picks]
    memory = [np.full((1 << bits, k), 1e-6), np.full((k, k), 1e-3), np.full(k, 1e-3), np.full((k, k), 1e-3)]
    grams = np.zeros((1 << bits, k))
    first = np.arange(0, batch * length + 1, length)
    for epoch in range(epochs):
        order = rng.permutation(chains)
        for i in range(0, chains - batch + 1, batch):
            own = order[i:i + batch]
            here, back = np.unique(chain[own], return_inverse=True)
            back = back.reshape(-1)
            sel, number = known.spans(here)
            total = np.concatenate([np.zeros((1, k)), np.cumsum(grams[sel], axis=0)])
            edge = np.concatenate([[0], np.cumsum(number)])
            emit = total[edge[1:]] - total[edge[:-1]]
            per = 1 / np.maximum(count[here], 1)
            scores = (emit * per[:, None] + member[here] @ model.lex + model.bias)[back]
            p = marginals(scores, model.trans, first)
            delta = p.copy()
            delta[np.arange(len(delta)), gold[own].reshape(-1)] -= 1
            by_word = np.stack([np.bincount(back, delta[:, j], len(here)) for j in range(k)], axis=1)
            pair = expected_pairs(scores.reshape(batch, length, k), model.trans, p.reshape(batch, length, k))
            y = gold[own]
            np.subtract.at(pair, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
            owner = np.repeat(np.arange(len(here)), number)
            touched, place = np.unique(sel, return_inverse=True)
            weighted = by_word * per[:, None]
            g = np.stack([np.bincount(place, weighted[owner, j], len(touched)) for j in range(k)], axis=1) / batch
            step = rate * (1 - 0.7 * epoch / epochs)
            for value, grad, s, where in ((grams, g, memory[0], touched), (model.lex, member[here].T @ by_word / batch, memory[1], slice(None)),
                                          (model.bias, by_word.sum(axis=0) / batch, memory[2], slice(None)),
                                          (model.trans, pair / batch, memory[3], slice(None))):
                s[where] += grad * grad
                value[where] -= step * grad / np.sqrt(s[where])
    model.grams = np.ascontiguousarray(grams.T, dtype=np.float32)
    return model


def expected_pairs(scores: np.ndarray, trans: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Expected transitions of chains of equal length, given their marginals ``p``.

    P(i, j at t, t+1) is alpha_t(i) move(i, j) emit_t+1(j) beta_t+1(j), rebuilt from a forward pass."""
    emit = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(trans - trans.max())
    a = emit[:, 0]
    a = a / a.sum(axis=1, keepdims=True)
    total = np.zeros_like(trans, dtype=np.float64)
    for t in range(1, scores.shape[1]):
        flow = a[:, :, None] * move[None] * emit[:, t, None, :]
        a = flow.sum(axis=1)
        cond = flow / np.maximum(a[:, None, :], 1e-300)  # P(i at t-1 | j at t)
        total += (cond * p[:, t, None, :]).sum(axis=0)
        a = a / a.sum(axis=1, keepdims=True)
    return total


def word_languages(model: Model, texts: list[str]) -> tuple[subwords.Words, np.ndarray]:
    """The words of the texts and each word's marginals."""
    words = subwords.words_of(texts)
    return words, marginals(emissions(model, words), model.trans, words.first)


def predict(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and score (its mean marginal over the words) of each text."""
    if not model.langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    words, p = word_languages(model, texts)
    total = np.concatenate([np.zeros((1, len(model.langs))), np.cumsum(p, axis=0)])
    sums = total[words.first[1:]] - total[words.first[:-1]]
    size = np.diff(words.first)
    best = sums.argmax(axis=1)
    score = np.clip(sums[np.arange(len(texts)), best] / np.maximum(size, 1), 0, 1)
    known = [n > 0 and any(map(str.isalpha, t)) for n, t in zip(size, texts)]
    return [model.langs[b] if ok else UNKNOWN for b, ok in zip(best, known)], np.where(known, score, 0.0)


def fit_languages(docs: DataFrame, max_rows: int = 1200, longest: int = 3000, id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang", **options) -> Model:
    """Trains on at most ``max_rows`` texts a language, of rows with crc32(id) mod 4 other than 2 and a language, in an order
    hashed from the text. A text of more than ``longest`` code points gives a stretch of so many, at a place hashed from it, so a language
    of long texts is learned too. One scan takes all languages: rows below a hash threshold that follows from each language's count. The
    number of languages bounds the sample on the driver (``max_rows * longest`` code points each). Empty tables and tables
    without a language give a model that knows none."""
    rows = (docs.where((fold(id_col, 4) != 2) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_whole"), F.xxhash64(text_col, id_col).alias("_order"))
            .select("_lang", "_order", stretch("_whole", longest).alias("_text")))
    shares = hash_shares(rows.withColumn("_size", F.length("_text")), "_lang", max_rows * longest, max_rows)
    if not shares:
        return train([], [], **options)
    wanted = docs.sparkSession.createDataFrame([(k, int(v * STEPS)) for k, v in shares.items()], "_lang string, _below long")  # a row a language
    got = (rows.withColumn("_lang", F.col("_lang").cast("string")).join(F.broadcast(wanted), "_lang")
           .where(F.pmod("_order", F.lit(STEPS)) < F.col("_below")).select("_lang", "_order", "_text").toPandas())
    got = got.sort_values(["_lang", "_order", "_text"]).groupby("_lang", sort=True).head(max_rows)
    return train(got["_text"].tolist(), got["_lang"].tolist(), **options)


def label_languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    slice_bytes: int = 1 << 21) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, lang_pred, score`` from the text alone.

    ``und`` with score 0 for null texts and texts without a letter. Repeated rows are labelled alike,
    other columns are ignored, an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", slice_bytes):
            lang, score = predict(shared.value, [t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)],
                                             names=["doc_id", "lang_pred", "score"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(released(run), f"doc_id {kind}, lang_pred string, score double")


def language_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                   slice_bytes: int = 1 << 21) -> DataFrame:
    """Stretches of words of one language: ``doc_id, first_word, words, lang``, for code-switched text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", slice_bytes):
            words, p = word_languages(shared.value, batch.column("text").to_pylist())
            best = p.argmax(axis=1)
            new = np.ones(words.count, bool)
            new[1:] = best[1:] != best[:-1]
            new[words.first[:-1][np.diff(words.first) > 0]] = True
            at = np.flatnonzero(new)
            size = np.diff(np.append(at, words.count))
            doc = np.searchsorted(words.first, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(at - words.first[doc]), pa.array(size.astype(np.int64)),
                 pa.array([shared.value.langs[b] for b in best[at]], pa.string())],
                names=["doc_id", "first_word", "words", "lang"])

    from .common import clean_text
    rows = docs.select(docs[id_col].alias("doc_id"), clean_text(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(released(run), f"doc_id {kind}, first_word long, words long, lang string")


def detect_languages(docs: DataFrame) -> DataFrame:
    """Fits outside the held-out fold and labels every row: ``doc_id, held_out, lang_pred, score``."""
    labelled = label_languages(docs, fit_languages(docs))
    return labelled.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
