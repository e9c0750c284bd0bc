"""License scans: exact phrases over words, and fuzzy search for short license notices.

A notice may differ from its wording by k edits. Cut into k + 1 pieces, at least one piece stands
in the text unchanged (pigeonhole), so one automaton over all pieces finds every candidate
place; the regex library then matches the whole notice with at most k errors in a window
around the place and gives the span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import clean_text, released, sliced

#: fixed values: exact phrases and their labels
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: short notices (words in lower case, one blank between) and their labels
NOTICES = {
    "under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under the apache license version 1 1": "apache-1-1",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "creative commons attribution sharealike 4 0": "cc-by-sa",
    "licensed under cc by nd 4 0": "cc-by-nd",
    "creative commons attribution noderivatives 4 0": "cc-by-nd",
    "licensed under cc by 4 0": "cc-by",
    "licensed under the gnu general public license version 2": "gpl-2",
    "licensed under the gnu general public license version 3": "gpl-3",
    "licensed under the gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license version 1 1": "mpl-1-1",
    "mozilla public license version 2 0": "mpl-2",
    "all rights reserved": "all-rights-reserved",
}
#: words that tell one license from another: edits may not touch them
NAMING = frozenset("mit cc by nc sa nd".split())
#: words whose presence beside them makes it another license
NUMBER = re.compile(r"[0-9]+")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text: str) -> str:
    """A-Z in lower case; all other characters as they are."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


@dataclass(frozen=True)
class Span:
    """Words [first, stop) of a text that match a notice with some edits."""

    label: str
    first: int
    stop: int
    errors: int
    score: float


def pieces(wording: str, count: int) -> list[tuple[int, str]]:
    """``count`` consecutive pieces of nearly equal length, with their places."""
    cuts = [round(i * len(wording) / count) for i in range(count + 1)]
    return [(a, wording[a:b]) for a, b in zip(cuts, cuts[1:])]


def variants(notices: dict[str, str]) -> dict[str, str]:
    """The notices, and those of a version "2.0" with "2" alone too."""
    return notices | {w.removesuffix(" 0"): label for w, label in notices.items() if w.endswith(" 0")}


class Scanner:
    """Finds phrases and notices in a text given as its words joined by blanks.

    ``error_rate``: edits allowed per character of a notice."""

    def __init__(self, phrases: dict[str, str], notices: dict[str, str], error_rate: float = 0.1):
        self.phrases = [(f" {p} ", label) for p, label in phrases.items()]
        self.notices = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for n, (wording, label) in enumerate(variants(notices).items()):
            errors = max(1, int(len(wording) * error_rate))
            pattern = regex.compile(rf"(?b)(?<=\ )(?:{regex.escape(wording)}){{e<={errors}}}(?=\ )")
            self.notices.append((wording, label, errors, pattern))
            for at, piece in pieces(wording, errors + 1):
                seeds.setdefault(piece, []).append((n, at))
        self.seeds = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()

    def exact(self, line: str) -> list[tuple[int, str]]:
        """First word and label of all places of each phrase. ``line`` starts and ends with a blank."""
        found = []
        for phrase, label in self.phrases:
            at = line.find(phrase)
            while at >= 0:
                found.append((line.count(" ", 0, at), label))
                at = line.find(phrase, at + 1)
        return found

    @staticmethod
    def named(wording: str, found: str, behind: str) -> bool:
        """Whether the words that name the license stand in ``found`` as in the notice: the naming words and numbers in
        order, none more, and none going on behind (``behind`` is the next word)."""
        def kept(text: str) -> list[str]:
            return [w for w in text.split() if w in NAMING or NUMBER.fullmatch(w)]

        asked, own = kept(wording), kept(found)
        minor = asked and NUMBER.fullmatch(asked[-1]) and NUMBER.fullmatch(behind) and len(behind) == 1  # "2" of "2.5"
        return own == asked and not minor and not (asked and behind in NAMING and asked[-1] in NAMING)

    def fuzzy(self, line: str) -> list[Span]:
        """Notices within their error bounds whose naming words are untouched, best spans first found from the left; no two of a notice overlap."""
        starts: dict[int, set[int]] = {}
        for end, (size, places) in self.seeds.iter(line):
            for n, at in places:
                starts.setdefault(n, set()).add(end + 1 - size - at)
        found = []
        for n in sorted(starts):
            wording, label, errors, pattern = self.notices[n]
            size = len(wording)
            done = -1  # end of the last window or span
            for s in sorted(starts[n]):
                if s + size - errors <= done:
                    continue
                a, b = max(0, s - 2 * errors - 1), s + size + 2 * errors + 1
                m = pattern.search(line, a, b)
                if m is None:
                    continue
                if not self.named(wording, m.group(), line[m.end():m.end() + 24].lstrip(" ").split(" ", 1)[0]):
                    continue
                done = m.end()
                first = line.count(" ", 0, m.start()) - 1
                wrong = sum(m.fuzzy_counts)
                found.append(Span(label, first, first + m.group().strip(" ").count(" ") + 1, wrong, 1 - wrong / size))
        return found


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None,
                  error_rate: float = 0.1, id_col: str = "doc_id", text_col: str = "text",
                  slice_bytes: int = 1 << 21) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans`` (label, from, to in code points of the text, errors).

    Words are counted from 0. ``n_base`` counts all places of the exact phrases, ``first_word`` and
    ``last_word`` are the smallest and largest word they start at (null without any). ``labels``
    adds those of the fuzzy notices; ``score`` is the best span's share of characters without an
    edit, 1 for an exact phrase, 0 without any. Null and empty texts have no words. Repeated
    rows are scanned each; other columns are ignored; an empty table gives an empty result."""
    phrases, notices = phrases or PHRASES, notices or NOTICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices, error_rate)
        for batch in sliced(batches, "text", slice_bytes):
            out = [scan_text(scanner, text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*out), TYPES))], names=["doc_id", *NAMES])

    rows = docs.select(docs[id_col].alias("doc_id"), clean_text(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(released(run), f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
                                "base_labels string, labels string, score double, "
                                "spans array<struct<label:string,from:long,to:long,errors:int>>")


NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
TYPES = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
    [("label", pa.string()), ("from", pa.int64()), ("to", pa.int64()), ("errors", pa.int32())]))]


def scan_text(scanner: Scanner, text: str) -> tuple:
    lower = lowered(text)
    words = WORDS.findall(lower)
    line = f" {' '.join(words)} "
    base, spans = scanner.exact(line), scanner.fuzzy(line)
    places = []
    if spans:
        at = [(m.start(), m.end()) for m in WORDS.finditer(lower)]
        places = [{"label": s.label, "from": at[s.first][0], "to": at[min(s.stop, len(at)) - 1][1], "errors": s.errors}
                  for s in spans]
    own = {label for _, label in base}
    starts = [w for w, _ in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)),
            ",".join(sorted(own | {s.label for s in spans})),
            1.0 if base else max((s.score for s in spans), default=0.0), places)
