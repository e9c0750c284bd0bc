"""Text operators over tables.

Token arrays stay per row; anything that needs a dictionary (lemmas, lexicon
weights) is a join on the exploded tokens, so no list of words is ever held whole by
the driver or by one task."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

# Noun suffix rules of the WordNet morphological analyser, in its order.
NOUN_SUFFIX_RULES = (("s", ""), ("ses", "s"), ("xes", "x"), ("zes", "z"), ("ches", "ch"),
                     ("shes", "sh"), ("men", "man"), ("ies", "y"))


def tokens_of(df: DataFrame, text: str, name: str = "tokens", stopwords: bool = True) -> DataFrame:
    """STX-01..03: clean, tokenize, drop stop words."""
    words = F.coalesce(X.tokenize(X.clean_text(F.col(text))), F.array().cast("array<string>"))  # null text: none
    return df.withColumn(name, X.remove_stopwords(words) if stopwords else words)


def lemma_table(tokens: DataFrame, col: str = "tokens") -> DataFrame:
    """STX-04 dictionary built from the corpus: a form maps to the shortest
    suffix-rule base that is itself a word of the corpus (stand-in for the WordNet lookup)."""
    vocab = tokens.select(F.explode(col).alias("form")).distinct()
    cands = F.array(*[
        F.when(F.col("form").endswith(suf) & (F.length("form") >= len(suf)),
               F.concat(F.expr(f"substring(form, 1, length(form) - {len(suf)})"), F.lit(rep)))
        for suf, rep in NOUN_SUFFIX_RULES])
    c = vocab.select("form", F.posexplode(cands).alias("rule", "lemma")).filter(F.col("lemma") != "")
    known = c.join(vocab.withColumnRenamed("form", "lemma"), "lemma", "left_semi")
    return known.groupBy("form").agg(F.min_by("lemma", F.struct(F.length("lemma"), "rule")).alias("lemma"))


def _lemmas_in_rows(df: DataFrame, col: str, table: DataFrame, name: str) -> DataFrame:
    """Every row's tokens with the lemmas of ``table`` (form, lemma) in their place, in order; the table goes to all tasks."""
    words = table.toArrow()
    shared = df.sparkSession.sparkContext.broadcast((words.column("form").combine_chunks(), words.column("lemma").combine_chunks()))

    @F.arrow_udf("array<string>")
    def lemmas(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forms, bases = shared.value
        for rows in batches:
            flat = rows.flatten()
            ends = np.cumsum(pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False))
            found = pc.coalesce(bases.take(pc.index_in(flat, value_set=forms)), flat)
            yield pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), found)

    return df.withColumn(name, lemmas(F.col(col)))


def _lemmatized(df: DataFrame, key: str, col: str, table: DataFrame, name: str, broadcast_words: int, ids: DataFrame) -> tuple[DataFrame, bool]:
    """``df`` with lemmas, and whether its rows stand where they stood; ``ids`` has the keys of all rows."""
    none = F.array().cast("array<string>")

    def in_order(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "lemma"))), lambda s: s["lemma"]).alias(name))

    table = table.checkpoint(eager=True)  # learned once, counted and sent
    if table.count() > broadcast_words:
        ex = df.select(key, F.posexplode(col).alias("pos", "form"))
        back = in_order(ex.join(table, "form", "left").withColumn("lemma", F.coalesce("lemma", "form")))
        return df.join(back, key, "left").withColumn(name, F.coalesce(F.col(name), none)), False
    own = _lemmas_in_rows(df, col, table, name)
    single = own.withColumn(name, F.when(F.col(key).isNotNull(), F.col(name)).otherwise(none))
    again = ids.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter((F.col("__n") > 1) & F.col(key).isNotNull()).select(key).checkpoint(eager=True)
    n = again.count()
    if not n:
        return single, True
    again = F.broadcast(again) if n <= broadcast_words else again
    several = own.join(again, key, "left_semi")
    back = in_order(several.select(key, F.posexplode(name).alias("pos", "lemma")))
    merged = several.drop(name).join(back, key, "left").withColumn(name, F.coalesce(F.col(name), none))
    return single.join(again, key, "left_anti").unionByName(merged), False


def lemmatize(df: DataFrame, key: str, col: str = "tokens", table: DataFrame | None = None,
              name: str = "lemmas", broadcast_words: int = 1_000_000) -> DataFrame:
    """STX-04: each token replaced by its lemma (itself when unknown), order kept. A table of at most ``broadcast_words``
    forms (counted) goes to the rows, whose tokens then stay where they are; beyond, the tokens are exploded with positions,
    joined to it and regrouped. Rows that repeat a key have the tokens of all of them, by position; a null key has none."""
    table = table if table is not None else lemma_table(df.select(col), col)
    return _lemmatized(df, key, col, table, name, broadcast_words, df.select(key))[0]


def news_clean(df: DataFrame, key: str, text: str = "text", date: str = "date", broadcast_words: int = 1_000_000) -> DataFrame:
    """STX-07: clean -> tokens -> stop words -> lemmas -> joined text -> noise removal;
    dates coerced, rows without a date dropped, sorted by date (before the texts are cleaned, where that leaves rows in place:
    a sort reads its input twice)."""
    from ..functions.dates import parse_date_coerce
    table = lemma_table(tokens_of(df.select(text), text))
    t = tokens_of(df.withColumn(date, parse_date_coerce(F.col(date))).orderBy(date, key), text)
    t, in_place = _lemmatized(t, key, "tokens", table, "lemmas", broadcast_words, df.select(key))
    t = t.withColumn("joined_text", X.remove_noise(X.join_tokens(F.col("lemmas"))))
    t = t.filter(F.col(date).isNotNull())
    return t if in_place else t.orderBy(date, key)


def word_lexicon(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                 label: str = "quality", min_docs: int = 2) -> DataFrame:
    """A lexicon learnt by Spark from labelled documents: weight of a word = mean label
    of the documents holding it minus the overall mean, clipped to [-1, 1]. ``docs`` may
    already hold a ``tokens`` column (then the text is not tokenized again)."""
    lab = docs.join(labels.select(key, label), key, "inner")
    if "tokens" not in lab.columns:
        lab = tokens_of(lab, text)
    toks = lab.select(key, label, F.explode(F.array_distinct("tokens")).alias("word"))
    base = labels.agg(F.avg(label).alias("__m"))
    w = toks.groupBy("word").agg(F.avg(label).alias("__a"), F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= min_docs)
    m = base.first()["__m"]
    return w.select("word", F.least(F.greatest(F.col("__a") - F.lit(m), F.lit(-1.0)), F.lit(1.0)).alias("weight"))


def score_texts(df: DataFrame, key: str, text: str = "text", lexicon: DataFrame | None = None,
                scorer: Callable[[pd.Series], pd.Series] | None = None, name: str = "score",
                max_tokens: int | None = None, broadcast_words: int = 4_000_000) -> DataFrame:
    """SEN-01: a score per text. With ``scorer`` (pandas Series of texts -> Series of
    scores) it runs as an Arrow-batched pandas UDF (``score_with_model`` loads a model once a task instead);
    with ``lexicon`` (word, weight) it is the mean weight of the tokens that the lexicon
    knows (null when none), of the first ``max_tokens`` only if a limit is asked for. A lexicon of at most
    ``broadcast_words`` words (counted) is sent to the texts as hashes and weights (16 bytes a word); beyond, the hashes of
    their tokens are joined to it."""
    if scorer is not None:
        udf = F.pandas_udf(scorer, "double")
        return df.withColumn(name, udf(F.col(text)))
    t = (df.select(key, "tokens") if "tokens" in df.columns else tokens_of(df.select(key, text), text))
    if max_tokens is not None:
        t = t.withColumn("tokens", X.truncate_tokens(F.col("tokens"), max_tokens))
    ex = t.select(key, F.explode(F.transform("tokens", lambda w: F.xxhash64(w))).alias("h"))
    words = lexicon.select(F.xxhash64("word").alias("h"), "weight").checkpoint(eager=True)  # learned once, counted and joined
    small = words.count() <= broadcast_words
    s = ex.join(F.broadcast(words) if small else words, "h").groupBy(key).agg(F.avg("weight").alias(name))
    return df.join(s, key, "left")


def score_with_model(df: DataFrame, key: str, load: Callable[[], Callable[[list[list[str]]], np.ndarray]], tokens: str = "tokens",
                     name: str = "score", window: int = 512, every: bool = False, budget: int = 16_384) -> DataFrame:
    """SEN-01 with a model: ``load`` is called once a task and gives a function from windows (lists of at most ``window`` tokens) to
    scores. A text's score is that of its first window or (``every``) the mean over all its windows by their tokens; null without tokens.
    Windows of an Arrow batch go to the model sorted by length, so that a call's windows times the longest stay within ``budget`` tokens:
    calls cost alike and hardly pad. Only a call's tokens are Python objects, the batch's stay in Arrow."""
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()
        for texts in batches:
            flat = texts.flatten()
            lengths = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            count = -(-lengths // window) if every else (lengths > 0).astype(np.int64)
            owner = np.repeat(np.arange(len(lengths)), count)
            inside = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * window
            begin = (np.cumsum(lengths) - lengths)[owner] + inside
            sizes = np.minimum(lengths[owner] - inside, window)
            got = np.zeros(len(owner))
            order = np.argsort(-sizes, kind="stable")
            at = 0
            while at < len(order):
                call = order[at:at + max(1, budget // sizes[order[at]])]
                got[call] = model([flat.slice(a, n).to_numpy(zero_copy_only=False).tolist() for a, n in zip(begin[call].tolist(), sizes[call].tolist())])
                at += len(call)
            weight = np.bincount(owner, sizes, len(lengths))
            total = np.bincount(owner, got * sizes, len(lengths))
            yield pa.array(total / np.maximum(weight, 1), pa.float64(), mask=weight == 0)

    return df.withColumn(name, F.nanvl(score(F.col(tokens)), F.lit(None).cast("double")))


def fit_word_model(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", size: int = 1 << 14,
                   reg: float = 1e-3) -> tuple[np.ndarray, float]:
    """A logistic regression over hashed words (their share in the text), fitted by Spark on the labelled documents:
    ``size`` weights and the intercept."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer, Normalizer
    own = docs.join(labels.select(key, F.col(label).cast("double").alias("label")).filter("label is not null"), key)
    toks = tokens_of(own.select(key, "label", text), text).filter(F.size("tokens") > 0)
    places = F.transform("tokens", lambda w: F.pmod(F.crc32(w.cast("binary")), F.lit(size)).cast("string"))
    rows = toks.select("label", places.alias("places")).checkpoint(eager=True)  # read by each pass of the fit
    counter = CountVectorizer(inputCol="places", outputCol="counts", vocabSize=size).fit(rows)
    shares = Normalizer(inputCol="counts", outputCol="features", p=1.0).transform(counter.transform(rows)).select("label", "features")
    fit = LogisticRegression(regParam=reg, maxIter=50, standardization=False).fit(shares)
    weights = np.zeros(size)
    weights[[int(v) for v in counter.vocabulary]] = fit.coefficients.toArray()  # at most ``size`` places
    return weights, float(fit.intercept)


def word_model(spark, weights: np.ndarray, intercept: float) -> Callable[[], Callable[[list[list[str]]], np.ndarray]]:
    """A loader for ``score_with_model``: the weights are broadcast (their number is the model's); scores lie in -1 to 1."""
    shared = spark.sparkContext.broadcast((weights, intercept))

    def load() -> Callable[[list[list[str]]], np.ndarray]:
        w, b = shared.value
        known: dict[str, float] = {}

        def score(windows: list[list[str]]) -> np.ndarray:
            out = np.empty(len(windows))
            for i, words in enumerate(windows):
                for x in words:
                    if x not in known:
                        known[x] = w[zlib.crc32(x.encode()) % len(w)]
                out[i] = np.tanh((b + sum(known[x] for x in words) / len(words)) / 2)  # 2 p - 1
                if len(known) > 200_000:
                    known.clear()
            return out

        return score

    return load


def daily_sentiment(scored: DataFrame, date: str = "date", key: str = "doc_id", text: str = "text",
                    score: str = "score") -> tuple[DataFrame, DataFrame]:
    """SEN-02 / AGG-02 / AGG-03: per date the texts and scores (rows, in key order), and the
    null-skipping mean score."""
    from .panel import group_score_mean
    return group_score_mean(scored, date, text, score, [key])
