"""Token counts: batch encoding in Arrow functions that return lengths only.

A text is split at safe boundaries: in front of a run of blanks that follows another
character. No piece of the vocabulary holds the word mark behind another character (this is
checked when the model is loaded), so no merge crosses such a boundary and the counts of the
parts add up to the count of the whole text. The distinct parts of a batch are encoded together, in
batches balanced by bytes, and their counts are kept in a bounded dictionary of the worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import RELEASE, clean_text, released, sliced

MARK = "▁"
PARTS = re.compile(r" +[^ ]*|[^ ]+")
IRREGULAR = re.compile(r"^ | $|  ")


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class PieceCounter:
    """Counts sentencepiece tokens of whole texts by their parts."""

    def __init__(self, path: str, batch_bytes: int = 1 << 18, keep: int = 1_000_000, longest: int = 64):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.batch_bytes, self.keep, self.longest = batch_bytes, keep, longest
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.splittable = not any(MARK in p.lstrip(MARK) for p in pieces) and self.model.encode("  x ", out_type=str)[-1] == MARK
        self.known: dict[str, int] = {}

    def encode(self, texts: list[str]) -> list[int]:
        """Token counts of the texts as they are, batched by bytes."""
        out: list[int] = []
        batch: list[str] = []
        size = 0
        for text in texts:
            batch.append(text)
            size += len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))
            if size >= self.batch_bytes:
                out += map(len, self.model.encode(batch, num_threads=1))
                batch, size = [], 0
        return out + [len(x) for x in self.model.encode(batch, num_threads=1)] if batch else out

    def parts(self, text: str) -> tuple[list[str], int]:
        """Strings whose counts add up to the text's, and how many single marks come besides."""
        if not self.splittable or MARK in text:
            return [text], 0
        if not IRREGULAR.search(text):
            return text.split(" "), 0
        found = PARTS.findall(text)
        rest = [p[1:] for p in found[1:]]
        marks = rest.count("")
        return [found[0], *filter(None, rest)], marks

    def counts(self, texts: list[str]) -> list[int]:
        split = [self.parts(t) if t else ([], 0) for t in texts]
        missing = set().union(*(p for p, _ in split)).difference(self.known)
        if len(self.known) + len(missing) > self.keep:
            self.known.clear()
            missing = set().union(*(p for p, _ in split))
        new = list(missing)
        known = self.known
        known.update(zip(new, self.encode(new)))
        out = [sum(map(known.__getitem__, parts)) + marks for parts, marks in split]
        for part in new:
            if len(part) > self.longest:
                del known[part]
        return out


_COUNTERS: dict[str, PieceCounter] = {}
RELEASE.append(lambda: [c.known.clear() for c in _COUNTERS.values()] and None)


def counter(path: str) -> PieceCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None,
                 limit: int = 4096, slice_bytes: int = 1 << 21) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted each, null ids
    are kept, other columns are ignored, an empty table gives an empty result. Texts of any
    length are counted whole; only their parts meet the model. ``model`` is the path of a
    sentencepiece model that every worker can read."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", slice_bytes):
            texts = batch.column("text").to_pylist()
            tokens = np.asarray(counter(path).counts(texts), dtype=np.int64)
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(docs[id_col].alias("doc_id"), clean_text(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(released(run, keep=True), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
