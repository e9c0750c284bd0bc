"""Words and hashed character n-grams of many texts at once, as flat numpy arrays.

A batch becomes one row of code points in which every word is preceded by one boundary (0) and
the row ends with one: 0 w w w 0 w w 0. N-grams may begin or end with a boundary (affixes) but
hold none inside.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from dataclasses import dataclass

import numpy as np

MULT = np.uint32(0x9E3779B1)
STEP = np.uint32(0x01000193)


@functools.cache
def letters(digits: bool) -> np.ndarray:
    """Whether a code point belongs to words: letters and marks, and digits if asked for."""
    kinds = ("L", "M", "N") if digits else ("L", "M")
    return np.fromiter((unicodedata.category(chr(c))[0] in kinds for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


@functools.cache
def lower() -> np.ndarray:
    """Lower case by code point, where it is a single one; so places in a text stay what they are."""
    cases = (chr(c).lower() for c in range(sys.maxunicode + 1))
    return np.fromiter((ord(x) if len(x) == 1 else c for c, x in enumerate(cases)), np.uint32, sys.maxunicode + 1)


@dataclass
class Words:
    """``row``: code points with boundaries; ``starts``: the boundary before each word, then the
    last one; ``first``: the first word of each text, then the number of words; ``begin`` and
    ``end``: code points [begin, end) of each word in the texts joined by one character."""

    row: np.ndarray
    starts: np.ndarray
    first: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    @property
    def count(self) -> int:
        return len(self.starts) - 1


def words_of(texts: list[str], digits: bool = False) -> Words:
    """Lower-cased words of the texts, in order."""
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = letters(digits)[codes]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begin, end = edge[::2], edge[1::2]
    starts = np.concatenate([[0], np.cumsum(end - begin + 1)])
    row = np.zeros(int(starts[-1]) + 1, np.uint32)
    letter = np.ones(len(row), bool)
    letter[starts] = False
    row[letter] = lower()[codes[inside]]
    first = np.searchsorted(begin, np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)]))
    first[-1] = len(begin)
    return Words(row, starts, first, begin, end)


def ngrams(words: Words, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``words.row`` at which n-grams without inner boundary begin, and their buckets."""
    row = words.row
    size = len(row) - n + 1
    if size <= 0 or not words.count:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = row[:size] * STEP + np.uint32(n)
    whole = np.ones(size, bool)
    for k in range(1, n):
        part = row[k:k + size]
        code = (code ^ part) * STEP
        code += code >> np.uint32(15)
        if k < n - 1:
            whole &= part != 0
    at = np.flatnonzero(whole)
    code = code[at]
    code *= MULT
    code ^= code >> np.uint32(13)
    code *= MULT
    return at, (code >> np.uint32(32 - bits)).astype(np.int64)


def word_codes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word: its letters times powers of an odd number, modulo 2**64, mixed."""
    if not words.count:
        return np.empty(0, np.uint64)
    size = np.diff(words.starts)
    place = np.arange(len(words.row) - 1, dtype=np.int32) - np.repeat(words.starts[:-1].astype(np.int32), size)
    powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(size.max()), 0xD1342543DE82EF95, np.uint64)]), dtype=np.uint64)
    value = powers[place]
    value *= words.row[:-1].astype(np.uint64) + np.uint64(1)
    out = np.add.reduceat(value, words.starts[:-1])
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def sums_by_word(words: Words, at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of values (at places of the row, ascending) by word."""
    cuts = np.searchsorted(at, words.starts)
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[cuts[1:]] - total[cuts[:-1]], np.diff(cuts)


def distinct(words: Words) -> tuple[Words, np.ndarray, np.ndarray]:
    """The distinct words (as one text), their codes, and for each word the place of its equal."""
    code, at, place = np.unique(word_codes(words), return_index=True, return_inverse=True)
    begin, size = words.starts[at], words.starts[at + 1] - words.starts[at]
    starts = np.concatenate([[0], np.cumsum(size)])
    row = np.zeros(int(starts[-1]) + 1, np.uint32)
    row[:-1] = words.row[np.arange(starts[-1]) + np.repeat(begin - starts[:-1], size)]
    return Words(row, starts, np.array([0, len(at)]), words.begin[at], words.end[at]), code, place


@dataclass
class Vocabulary:
    """Texts as numbers of distinct words, and each distinct word's n-gram buckets.

    ``codes``: the words' hashes, ascending; ``text``: the words of all texts; ``first`` as in
    Words; ``bucket[cuts[w]:cuts[w + 1]]``: the n-grams of word w."""

    codes: np.ndarray
    text: np.ndarray
    first: np.ndarray
    cuts: np.ndarray
    bucket: np.ndarray

    def spans(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the words, end to end, and their number by word."""
        size = self.cuts[words + 1] - self.cuts[words]
        edge = np.cumsum(size) - size
        return self.bucket[np.arange(size.sum()) + np.repeat(self.cuts[words] - edge, size)], size


def vocabulary(texts: list[str], sizes: tuple[int, ...], bits: int, digits: bool = False, step: int = 1 << 19) -> Vocabulary:
    """Read ``step`` code points at a time, so only distinct words' n-grams are held."""
    codes, texts_, lengths, buckets, numbers = [], [], [np.zeros(1, np.int64)], [], []
    at = 0
    while at < len(texts):
        stop, held = at, 0
        while stop < len(texts) and (held < step or stop == at):
            held += len(texts[stop])
            stop += 1
        words = words_of(texts[at:stop], digits)
        own, code, place = distinct(words)
        found = [ngrams(own, n, bits) for n in sizes]
        where = np.concatenate([a for a, _ in found])
        order = np.argsort(where, kind="stable")
        codes.append(code)
        texts_.append(code[place])
        lengths.append(np.diff(words.first))
        buckets.append(np.concatenate([b for _, b in found])[order].astype(np.int32))
        numbers.append(np.diff(np.searchsorted(where[order], own.starts)))
        at = stop
    if not codes:
        empty = np.empty(0, np.int64)
        return Vocabulary(empty.astype(np.uint64), empty, np.zeros(1, np.int64), np.zeros(1, np.int64), empty)
    whole, index = np.unique(np.concatenate(codes), return_index=True)
    number = np.concatenate(numbers)
    begin = np.cumsum(number) - number
    size = number[index]
    cuts = np.concatenate([[0], np.cumsum(size)])
    bucket = np.concatenate(buckets)[np.arange(cuts[-1]) + np.repeat(begin[index] - cuts[:-1], size)]
    return Vocabulary(whole, np.searchsorted(whole, np.concatenate(texts_)), np.cumsum(np.concatenate(lengths)), cuts, bucket)
