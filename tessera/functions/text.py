"""Text scalar functions. All are JVM column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop-word list of the NLTK corpus, in its own order.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them "
    "their theirs themselves what which who whom this that that'll these those am is are was "
    "were be been being have has had having do does did doing a an the and but if or because "
    "as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there "
    "when where why how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don don't should should've now d ll m o re ve y "
    "ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven "
    "haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn "
    "shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# Noise prefixes cut from headlines, tried in this order.
NOISE_SOURCES = ("reuters -", "investingcom --", "investingcom", "investing.com--",
                 "investing.com", "stocktwits -", "ians")

# Word-tokenizer contraction splits that survive the cleaning step
# (only [a-z0-9+%-] and blanks remain, so the apostrophe forms cannot occur).
CONTRACTION_SPLITS = (("cannot", "can not"), ("gimme", "gim me"), ("gonna", "gon na"),
                      ("gotta", "got ta"), ("lemme", "lem me"), ("wanna", "wan na"))

URL_PATTERN = r"https?://\S+"
# ``[^a-z0-9\-+%\s]`` with every character named: Java tests such a class by one lookup, ranges and ``\s`` one by one
KEEP_PATTERN = r"[^abcdefghijklmnopqrstuvwxyz0123456789\-+% \t\n\x0B\f\r]+"


def clean_text(c: Column) -> Column:
    """STX-01: drop URLs (before lower-casing), lower, keep ``[a-z0-9-+%]`` and blanks."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, URL_PATTERN, "")), KEEP_PATTERN, "")


def tokenize(c: Column) -> Column:
    """STX-02: word tokens of cleaned text: ``%`` and ``--`` stand alone, contractions
    split, blanks separate."""
    t = F.replace(F.replace(c, F.lit("%"), F.lit(" % ")), F.lit("--"), F.lit(" -- "))
    split = t
    for word, parts in CONTRACTION_SPLITS:
        split = F.regexp_replace(split, rf"\b{word}\b", parts)
    any_word = r"\b(" + "|".join(w for w, _ in CONTRACTION_SPLITS) + r")\b"
    t = F.when(t.rlike(any_word), split).otherwise(t)  # one scan for the common case
    return F.array_remove(F.split(F.trim(t), r"\s+"), "")  # compiled, so that ``t`` is made once


def remove_stopwords(tokens: Column) -> Column:
    """STX-03: drop stop words (a hash lookup per token), keep order and repeats."""
    return F.filter(tokens, lambda t: ~t.isin(*STOP_WORDS))


def join_tokens(tokens: Column, sep: str = " ") -> Column:
    """STX-05."""
    return F.array_join(tokens, sep)


def remove_noise(c: Column) -> Column:
    """STX-06: lower; for the first noise source (in list order) found anywhere, keep
    the text after its first occurrence, trimmed; else unchanged."""
    low = F.lower(c)
    out = low
    for noise in reversed(NOISE_SOURCES):
        at = F.instr(low, noise)
        out = F.when(at > 0, F.trim(F.substring(low, at + len(noise), 1 << 30))).otherwise(out)
    return out


def nth_word(c: Column, n: int) -> Column:
    """STX-08: n-th (1-based) blank-separated word, stripped, commas removed."""
    return F.regexp_replace(F.trim(F.try_element_at(F.split(c, " "), F.lit(n))), ",", "")


def join_paragraphs(paragraphs: Column, sep: str = " ") -> Column:
    """STX-09: non-empty paragraphs joined by ``sep``."""
    return F.array_join(F.filter(paragraphs, lambda p: F.trim(p) != ""), sep)


def truncate_tokens(tokens: Column, n: int = 512) -> Column:
    """LIM-05: at most ``n`` tokens go to the scorer."""
    return F.slice(tokens, 1, n)
