"""Best-fit packing of tokenized documents into sequences of a fixed size.

Documents are encoded once, in Arrow batches; only the pieces' lengths travel on. Each packing
group takes its pieces in order of arrival and keeps a fixed number of bins open. The bins'
free spaces stand in a bitset (bit f: some open bin has f places free), so the best fit is the
lowest set bit at or above a piece's length. If nothing fits and all bins are taken, the
fullest bin closes first.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RELEASE, clean_text, materialize, release, released, sliced

UNITS = re.compile(r"\s*\S+|\s+")
#: white space other than blank and line feed; the libraries differ on the kind of the first four
OTHER_SPACE = re.compile("[\x1c-\x1f\t\x0b-\x0d\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
UNSURE = re.compile(r"[\x1c-\x1f]")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class UnitEncoder:
    """Token ids of whole texts as little-endian 32-bit bytes.

    The vocabulary's pre-tokenizer never joins a blank to what stands before it, so a text may be
    cut in front of any run of white space that follows another character. The distinct units
    are encoded by the tokenizers library in batches and kept in a bounded dictionary."""

    def __init__(self, path: str, batch: int = 4096, keep: int = 900_000, longest: int = 64):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.batch, self.keep, self.longest = batch, keep, longest
        self.known: dict[str, bytes] = {}   # of units as they stand
        self.spaced: dict[str, bytes] = {}  # of words that follow a blank

    def encode(self, units: list[str]) -> list[bytes]:
        """Ids of each unit; a batch of units is one call, told apart by the unit each token is of."""
        out: list[bytes] = []
        for i in range(0, len(units), self.batch):
            batch = units[i:i + self.batch]
            found = self.model.encode(batch, is_pretokenized=True, add_special_tokens=False)
            ids = np.asarray(found.ids, dtype="<u4").tobytes()
            cuts = (4 * np.searchsorted(np.asarray(found.word_ids, dtype=np.int64), np.arange(len(batch) + 1))).tolist()
            out += [ids[x:y] for x, y in zip(cuts, cuts[1:])]
        return out

    def _fill(self, known: dict[str, bytes], wanted: set[str], before: str) -> list[str]:
        missing = wanted.difference(known)
        if len(known) + len(missing) > self.keep:
            known.clear()
            missing = wanted
        new = list(missing)
        known.update(zip(new, self.encode([before + x for x in new])))
        return [x for x in new if len(x) > self.longest]

    def ids(self, texts: list[str]) -> list[bytes]:
        plain: list[tuple[list[str], list[str]]] = []
        for text in texts:
            if not text:
                plain.append(([], []))
            elif "  " not in text and "\n " not in text and not OTHER_SPACE.search(text):
                rest = text.split(" ")  # a blank is cut off what stands before it, which is no space
                plain.append(([rest.pop(0)], rest))
            elif UNSURE.search(text):
                plain.append(([text], []))
            else:
                plain.append((UNITS.findall(text), []))
        long = self._fill(self.known, set().union(*(a for a, _ in plain)), "")
        far = self._fill(self.spaced, set().union(*(b for _, b in plain)), " ")
        out = [b"".join([*map(self.known.__getitem__, a), *map(self.spaced.__getitem__, b)]) for a, b in plain]
        for x in long:
            del self.known[x]
        for x in far:
            del self.spaced[x]
        return out


_ENCODERS: dict[str, UnitEncoder] = {}
RELEASE.append(lambda: [(e.known.clear(), e.spaced.clear()) for e in _ENCODERS.values()] and None)


def encoder(path: str) -> UnitEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, size: int = 1024, end_id: int | None = 2, vocabulary: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
                 slice_bytes: int = 1 << 21) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, slot`` (and ``ids`` if asked for) of each document.

    A document is its ids and then ``end_id``. Only longer documents than ``size`` are cut; the
    first piece takes the remainder, all others are full. Null or empty texts hold ``end_id``
    alone. ``slot`` spreads the pieces evenly over packing groups, whatever the ids are."""
    path = vocabulary or default_vocabulary()
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        for batch in sliced(batches, "text", slice_bytes):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, body in enumerate(encoder(path).ids(batch.column("text").to_pylist())):
                body += tail
                n = len(body) // 4
                cut = [0, *range(n % size or size, n + 1, size)] if n > size else [0, n]
                for k in range(len(cut) - 1):
                    own = body[4 * cut[k]:4 * cut[k + 1]]
                    row.append(i)
                    piece.append(k)
                    start.append(cut[k])
                    length.append(cut[k + 1] - cut[k])
                    crc.append(zlib.crc32(own))
                    if keep_ids:
                        ids.append(np.frombuffer(own, dtype="<u4").astype(np.int32))
            slots = [zlib.crc32(b"%d:%d" % (part, count + i)) for i in range(len(row))]
            count += len(row)
            arrays = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                      pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                      pa.array(slots, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "slot"]
            if keep_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
            release(True)  # what the encoder has freed

    rows = docs.select(docs[id_col].alias("doc_id"), clean_text(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, slot long"
    return rows.mapInArrow(released(run, keep=True), schema + (", ids array<int>" if keep_ids else ""))


def best_fit(lengths: list[int], size: int, open_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each length, in order of arrival, with at most ``open_bins`` open."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]  # open bins by free space
    bits, opened, made = 0, 0, 0
    for i, need in enumerate(lengths):
        fits = bits >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            own = stacks[free].pop()
            if not stacks[free]:
                bits &= ~(1 << free)
            opened -= 1
        else:
            if opened >= open_bins:  # the fullest closes
                low = (bits & -bits).bit_length() - 1
                stacks[low].pop()
                if not stacks[low]:
                    bits &= ~(1 << low)
                opened -= 1
            own, free, made = made, size, made + 1
        bins[i], offsets[i] = own, size - free
        if left := free - need:
            stacks[left].append(own)
            bits |= 1 << left
            opened += 1
    return bins, offsets


def pack(pieces: DataFrame, size: int = 1024, open_bins: int = 4096, group_pieces: int = 20_000) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table of pieces with ``length`` (1 to ``size``) and ``slot``.

    Groups hold about ``group_pieces`` pieces however large the table is; each is packed by one
    task in order of slot. Sequence ids are unique over all groups."""
    groups = max(1, round(pieces.count() / group_pieces))
    schema = pieces.schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="_group")
        rows = rows.iloc[np.lexsort((rows["start"].to_numpy(), rows["slot"].to_numpy()))]
        bins, offsets = best_fit(rows["length"].tolist(), size, open_bins)
        return rows.assign(sequence_id=bins + (np.int64(key[0]) << 32), offset=offsets)

    return (pieces.withColumn("_group", F.expr(f"cast(slot % {groups} as long)"))
            .groupBy("_group").applyInPandas(run, f"{fields}, sequence_id long, offset long"))


def pack_documents(docs: DataFrame, size: int = 1024, end_id: int | None = 2, open_bins: int = 4096,
                   group_pieces: int = 20_000, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Packs whole documents: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null and empty texts are one piece that holds ``end_id``. Repeated rows are packed each; null
    ids are kept; other columns are ignored; an empty table gives an empty result."""
    pieces = materialize(token_pieces(docs, size, end_id, vocabulary, keep_ids=keep_ids), "pieces")
    return pack(pieces, size, open_bins, group_pieces).drop("slot")
