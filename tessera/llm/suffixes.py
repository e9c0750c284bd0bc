"""Repeated byte strings by a depth-limited radix sort of suffixes.

A suffix is ordered only through its first ``least`` bytes, by passes over digits from the most significant one.
After each pass a suffix that is alone in its group is done: nothing equals it. Groups left after the last pass are
exactly the repeated windows of ``least`` bytes. A digit is the fingerprint (64 bits) of a fifth of the window.

Two things keep the sort small without losing a window:

* A window's anchor is the seed of ``seed`` bytes in it with the least fingerprint (the leftmost of equal ones). It
  depends on the window's bytes alone, so equal windows have equal anchors. Consecutive windows with one anchor are a span.
  The first pass deals spans by the anchor's fingerprint; an anchor seen once ends its span there.
* Spans with equal bytes are counted, and one of them stands for all. A span counted twice is repeated whole.

The spans left (same anchor, other bytes around it) are dealt by anchor, and their windows sorted. An anchor with more than ``bucket``
different spans is dealt over several buckets; windows that stay alone in one of them are then counted over all by their digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_text, materialize, released, sliced

PASSES = 5
#: bytes of text whose windows are looked at together; a longer text goes in parts that overlap by a window
PART = 1 << 20
_R = 0x9E3779B97F4A7C15  # odd, 5 modulo 8: differences of its powers have few factors of two
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class Blocks:
    """Fingerprints of blocks of one byte array: a polynomial over fixed random byte values modulo 2 ** 64."""

    value = np.random.default_rng(400).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    power = np.ones(1, np.uint64)
    inverse = np.ones(1, np.uint64)

    @classmethod
    def grow(cls, size: int) -> None:
        if len(cls.power) < size:
            for name, base in (("power", _R), ("inverse", pow(_R, -1, 1 << 64))):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                setattr(cls, name, np.cumprod(table))

    def __init__(self, data: np.ndarray):
        self.grow(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.power[:len(data)], out=self.sums[1:])

    def __call__(self, start, end) -> np.ndarray:
        """The fingerprints of [start, end), for arrays or slices of places."""
        got = (self.sums[end] - self.sums[start]) * self.inverse[start]
        got ^= got >> np.uint64(32)
        got *= _MIX
        got ^= got >> np.uint64(29)
        return got


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each run of ``width`` values."""
    step = 1
    while step * 2 <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return values if step == width else np.minimum(values[:step - width], values[width - step:])


def find_spans(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, least: int, seed: int):
    """Spans of the windows inside the texts [begins, ends) of ``data``: first window, number of windows,
    fingerprints of the anchor and of all bytes the span's windows cover."""
    none = np.zeros(0, np.int64)
    whole = ends - begins >= least
    if not whole.any():
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    blocks = Blocks(data)
    n = len(data)
    seeds = blocks(slice(0, n - seed + 1), slice(seed, n + 1))
    low = np.uint64((1 << 24) - 1)
    place = least_of((seeds & ~low) | np.arange(len(seeds), dtype=np.uint64), least - seed + 1) & low
    edges = np.zeros(len(place) + 1, np.int8)
    edges[begins[whole]] += 1
    np.add.at(edges, ends[whole] - least + 1, -1)
    inside = np.cumsum(edges[:-1], dtype=np.int8) > 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (place[1:] != place[:-1])
    start = np.flatnonzero(new)
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | new[1:]
    end = np.flatnonzero(stop) + 1
    return start, end - start, seeds[place[start].astype(np.int64)], blocks(start, end + least - 1)


def equal_runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the rows by ``keys`` (the first one most significant), each row's group in that order, and the groups' sizes."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        own = k[order]
        new[1:] |= own[1:] != own[:-1]
    group = np.cumsum(new) - 1
    return order, group, np.bincount(group) if len(group) else np.zeros(0, np.int64)


def sort_windows(data: np.ndarray, start: np.ndarray, bucket: np.ndarray, least: int) -> np.ndarray:
    """The radix passes: the group (from 0) of each window at ``start`` that equals another of its
    bucket in all ``least`` bytes; -1 for a window that is alone."""
    blocks = Blocks(data)
    cuts = np.linspace(0, least, PASSES + 1).astype(np.int64)
    alive, group = np.arange(len(start)), bucket
    for a, b in zip(cuts[:-1], cuts[1:]):
        order, runs, sizes = equal_runs(group, blocks(start[alive] + a, start[alive] + b))
        keep = sizes[runs] > 1
        alive, group = alive[order][keep], runs[keep]
    out = np.full(len(start), -1, np.int64)
    if len(group):
        out[alive] = np.unique(group, return_inverse=True)[1]
    return out


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of true values."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    start = np.flatnonzero(edge == 1)
    return start, np.flatnonzero(edge == -1) - start


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the batch's texts, and where each begins (and the last ends)."""
    col = batch.column("text")
    at = np.frombuffer(col.buffers()[1], np.int32 if pa.types.is_string(col.type) else np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, at.astype(np.int64) - int(at[0])


#: n: how often a span's bytes were seen here; 0: a stretch of windows that are known to be repeated
SPANS = "k long, own long, start long, count long, anchor long, bytes long, n int"


def text_spans(keyed: DataFrame, least: int, seed: int) -> DataFrame:
    """The spans of every text of ``keyed`` (k, own, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", PART):
            data, at = _texts(batch)
            found = []
            for lo in range(0, max(1, len(data) if batch.num_rows == 1 else 1), PART):
                part = data[lo:lo + PART + least - 1] if batch.num_rows == 1 else data
                begins, ends = (np.array([0]), np.array([len(part)])) if batch.num_rows == 1 else (at[:-1], at[1:])
                start, *more = find_spans(part, begins, ends, least, seed)
                found.append((start + lo, *more))
            start, count, anchor, union = (np.concatenate(x) for x in zip(*found))
            doc = np.searchsorted(at, start, side="right") - 1
            order, group, sizes = equal_runs(anchor, union)
            first = np.zeros(len(order), bool)
            first[:1] = True
            first[1:] = group[1:] != group[:-1]
            one = order[first]  # stands for its equals of this batch
            known = np.zeros(len(data) + 1, np.int8)  # stretches of windows seen twice here; none reaches the next text's windows
            twice = order[sizes[group] > 1]
            np.add.at(known, start[twice], 1)
            np.add.at(known, start[twice] + count[twice], -1)
            seen, length = _runs(np.cumsum(known[:-1], dtype=np.int64) > 0)
            rows = np.concatenate([doc[one], np.searchsorted(at, seen, side="right") - 1])
            starts = np.concatenate([start[one], seen])
            none = np.zeros(len(seen), np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k").take(pa.array(rows)), batch.column("own").take(pa.array(rows)), pa.array(starts - at[rows]),
                 pa.array(np.concatenate([count[one], length])),
                 pa.array(np.concatenate([anchor[one], none]).view(np.int64)), pa.array(np.concatenate([union[one], none]).view(np.int64)),
                 pa.array(np.concatenate([sizes, np.zeros(len(seen), np.int64)]).astype(np.int32))],
                names=["k", "own", "start", "count", "anchor", "bytes", "n"])

    return keyed.mapInArrow(released(run), SPANS)


PIECES = "anchor long, part int, parts int, bytes long, n long, count long, piece binary"


def pieces(keyed: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """The bytes of the ``wanted`` spans (k, own and a list of spans for each text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", PART):
            data, at = _texts(batch)
            lists = batch.column("spans")
            flat = lists.flatten()
            doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            start = at[doc] + flat.field("start").to_numpy()
            end = start + flat.field("count").to_numpy() + least - 1
            for lo in range(0, len(flat), 4096):
                part = slice(lo, lo + 4096)
                own = flat.slice(lo, 4096)
                yield pa.RecordBatch.from_arrays(
                    [*(own.field(c) for c in ("anchor", "part", "parts", "bytes", "n", "count")),
                     pa.array([data[a:b].tobytes() for a, b in zip(start[part], end[part])], pa.binary())],
                    names=["anchor", "part", "parts", "bytes", "n", "count", "piece"])

    return keyed.join(wanted, ["k", "own"]).select("text", "spans").mapInArrow(released(run), PIECES)


#: repeated windows [at, at + length) of a span; or (``packed``) the distinct windows of divided anchors, of one range of digits
SORTED = "anchor long, bytes long, at long, length long, range int, packed binary"
REPEATED = "anchor long, bytes long, at long, length long"
NAMES = ["anchor", "bytes", "at", "length", "range", "packed"]
#: columns of a packed window: its digits, a place where it is, and 1 if it was there once
FIELDS = 6


def sort_buckets(dealt: DataFrame, least: int, windows: int, ranges: int) -> DataFrame:
    """Sorts the windows of every bucket (anchor, part); about ``windows`` of them at a time, a bucket never divided.
    The windows of an anchor that has several buckets go on, packed, one row for a block and range of digits."""

    def block(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        distinct = list({(r[0], r[1], r[3]): r for r in rows}.values())  # a repeated row of the table sends its pieces again
        anchor, part, parts, union, n, count = (np.array(x, np.int64) for x in list(zip(*distinct))[:6])
        lengths = np.array([len(r[6]) for r in distinct], np.int64)
        base = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(r[6] for r in distinct), np.uint8)
        first = np.cumsum(count) - count
        piece = np.repeat(np.arange(len(count)), count)
        at = np.arange(len(piece)) - first[piece]
        start = base[piece] + at
        bucket = np.zeros(len(count), np.int64)
        bucket[1:] = np.cumsum((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]))
        group = sort_windows(data, start, bucket[piece], least)
        sizes = np.bincount(group[group >= 0], minlength=1)
        seen = np.where(group >= 0, sizes[group], 1) * np.where(n[piece] > 1, 2, 1)
        told = seen * (n[piece] == 1) > 1  # spans counted twice are known to be repeated whole
        edge = np.zeros(len(told) + 1, bool)
        edge[first] = edge[-1] = True  # a run ends with its span
        opens = told & (edge[:-1] | ~np.append(False, told[:-1]))
        closes = told & (edge[1:] | ~np.append(told[1:], False))
        a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(anchor[piece[a]]), pa.array(union[piece[a]]), pa.array(at[a]), pa.array(b - a),
                                              pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.binary())], names=NAMES)
        divided = np.flatnonzero(parts[piece] > 1)
        if len(divided):
            own = group[divided]
            _, lead = np.unique(np.where(own < 0, -1 - divided, own), return_index=True)  # one row a distinct window
            w = divided[lead]
            blocks = Blocks(data)
            half = least // 2
            first_digit = blocks(start[w], start[w] + half)
            rows = np.column_stack([first_digit.view(np.int64), blocks(start[w] + half, start[w] + least).view(np.int64),
                                    anchor[piece[w]], union[piece[w]], at[w], (seen[w] == 1).astype(np.int64)])
            where = (first_digit % np.uint64(ranges)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            cuts = np.searchsorted(where[order], np.arange(ranges + 1))
            told = [(r, rows[order[x:y]].tobytes()) for r, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x]
            none = pa.nulls(len(told), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array([r for r, _ in told], pa.int32()),
                                              pa.array([x for _, x in told], pa.binary())], names=NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        total = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if total >= windows and row[:2] != held[-1][:2]:
                    yield from block(held)
                    held, total = [], 0
                held.append(row)
                total += row[5]
        if held:
            yield from block(held)

    return dealt.mapInArrow(released(run), SORTED)


def meet_ranges(packed: DataFrame) -> DataFrame:
    """Windows that were alone in their bucket and equal one of another bucket. Rows are sorted by range; a range holds
    about a million windows, each once for every block that it is in."""

    def met(held: list[bytes]) -> pa.RecordBatch:
        rows = np.frombuffer(b"".join(held), np.int64).reshape(-1, FIELDS)
        order, group, sizes = equal_runs(rows[:, 0], rows[:, 1])
        keep = rows[order[(sizes[group] > 1) & (rows[order, 5] == 1)]]
        return pa.RecordBatch.from_arrays([*(pa.array(keep[:, c]) for c in (2, 3, 4)), pa.array(np.ones(len(keep), np.int64))],
                                          names=NAMES[:4])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        last = None
        for batch in batches:
            for r, x in zip(batch.column("range").to_pylist(), batch.column("packed").to_pylist()):
                if held and r != last:
                    yield met(held)
                    held = []
                last = r
                held.append(x)
        if held:
            yield met(held)

    return packed.mapInArrow(released(run), REPEATED)


def repeated_windows(keyed: DataFrame, least: int, seed: int, bucket: int, windows: int) -> DataFrame:
    """``k, own, start, length``: stretches of windows that start anywhere else too, for each text of ``keyed``."""
    every = materialize(text_spans(keyed, least, seed), "suffix-spans")
    spans = every.filter("n > 0")
    often = spans.groupBy("anchor").agg(F.sum("n").alias("t")).filter("t > 1").select("anchor")
    shared = materialize(spans.join(often, "anchor", "left_semi"), "suffix-shared")
    # one text stands for all whose span has the same bytes; written, since which one it is depends on the order of arrival
    kinds = materialize(shared.groupBy("anchor", "bytes").agg(
        F.sum("n").alias("n"), *(F.first(c).alias(c) for c in ("k", "own", "start", "count"))), "suffix-kinds")
    mixed = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("t")).filter("t > 1")
    parts = F.ceil(F.col("t") / bucket).cast("int")
    wanted = (kinds.join(mixed, "anchor").withColumn("parts", parts).withColumn("part", F.pmod("bytes", "parts").cast("int"))
              .groupBy("k", "own").agg(F.collect_list(F.struct("anchor", "part", "parts", "bytes", "n", "start", "count")).alias("spans")))
    dealt = pieces(keyed, wanted, least).repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    over = mixed.filter(F.col("t") > bucket).agg(F.sum("t")).first()[0] or 0  # spans of divided anchors
    done = materialize(sort_buckets(dealt, least, windows, 1 + over * (least - seed + 1) // (2 * windows)), "suffix-sorted")
    met = meet_ranges(done.filter("range is not null").select("range", "packed").repartition("range").sortWithinPartitions("range"))
    known = (kinds.filter("n > 1").select("anchor", "bytes", F.lit(0).cast("long").alias("at"), F.col("count").alias("length"))
             .unionByName(done.filter("range is null").select("anchor", "bytes", "at", "length"))
             .unionByName(met))
    return (shared.select("k", "own", "start", "anchor", "bytes").join(known, ["anchor", "bytes"])
            .select("k", "own", (F.col("start") + F.col("at")).alias("start"), "length")
            .unionByName(every.filter("n = 0").select("k", "own", "start", F.col("count").alias("length"))))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 400, seed: int = 64,
                   bucket: int = 2048, windows: int = 1 << 20) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans`` (start and length of each maximal removed run of bytes) and ``kept`` (the
    remaining bytes). Every byte goes that is covered by a string of ``least`` bytes that also starts anywhere
    else, in this or another row. All occurrences go, the first one too.

    Null texts are empty ones; texts shorter than ``least`` bytes stay. Rows are compared by their texts, whatever their
    ids: a row that is there twice with ``least`` bytes or more goes whole, with null ids too. Long texts are read in overlapping parts, so every
    window is seen. Other columns are ignored; an empty table gives an empty result. ``bucket`` spans of one anchor are
    sorted together at most, ``windows`` windows at a time or one bucket."""
    if not 0 < seed <= least:
        raise ValueError("seed has to lie between 1 and least")
    texts = docs.select(docs[id_col].alias("doc_id"), clean_text(text_col).alias("text"))
    keyed = texts.withColumns({"k": F.xxhash64("text"), "own": F.xxhash64(F.col("doc_id").cast("string"))})
    long = keyed.filter(F.octet_length("text") >= least).select("k", "own", "text")
    found = (repeated_windows(long, least, seed, bucket, windows).distinct()
             .groupBy("k", "own").agg(F.collect_list(F.struct("start", "length")).alias("found")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", PART):
            data, at = _texts(batch)
            lists = batch.column("found")
            flat = lists.flatten()
            doc = np.repeat(np.arange(batch.num_rows), [0 if x is None else x for x in lists.value_lengths().to_pylist()])
            lo = at[doc] + flat.field("start").to_numpy()
            edge = np.zeros(len(data) + 1, np.int64)
            np.add.at(edge, lo, 1)
            np.add.at(edge, lo + flat.field("length").to_numpy() + least - 1, -1)
            gone = np.cumsum(edge[:-1]) > 0
            spans, kept = [], []
            for a, b in zip(at[:-1], at[1:]):
                own = gone[a:b]
                if own.any():
                    spans.append([{"start": int(s), "length": int(n)} for s, n in zip(*_runs(own))])
                    kept.append(data[a:b][~own].tobytes())
                else:
                    spans.append([])
                    kept.append(data[a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(at[1:] - at[:-1]),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return (keyed.join(found, ["k", "own"], "left").select("doc_id", "text", "found")
            .mapInArrow(released(cut), f"doc_id {kind}, n_bytes long, spans array<struct<start:bigint,length:bigint>>, kept binary"))


def repeats_digest(docs: DataFrame, least: int = 400) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` from ``remove_repeats``."""
    return (remove_repeats(docs, least=least)
            .select(F.col("doc_id").cast("long").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                    F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")))


def repeats_sql(least: int = 400) -> str:
    """DuckDB text for ``repeats_digest``: every window of every text, by its bytes' md5 (for small tables)."""
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h,
  octet_length(encode(coalesce(text, ''))) AS n_bytes FROM documents),
w AS MATERIALIZED (SELECT r, i, md5(substr(h, 2 * i + 1, {2 * least})) AS m FROM (SELECT r, h, unnest(range(n_bytes - {least - 1})) AS i FROM d)),
hit AS MATERIALIZED (SELECT r, i FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
edge AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS gap FROM hit),
run AS (SELECT r, i, sum(CASE WHEN gap IS NULL OR gap > {least} THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS g FROM edge),
span AS (SELECT r, g, min(i) AS a, max(i) + {least} AS b FROM run GROUP BY r, g),
-- what is kept lies before each span and behind the last one
piece AS (SELECT r, b AS place, coalesce(lead(a) OVER (PARTITION BY r ORDER BY a), 1099511627776) AS until FROM span
  UNION ALL SELECT d.r, 0 AS place, coalesce(min(a), 1099511627776) FROM d LEFT JOIN span USING (r) GROUP BY d.r),
kept AS (SELECT d.r, any_value(doc_id) AS doc_id, any_value(n_bytes) AS n_bytes,
  string_agg(substr(h, 2 * place + 1, greatest(0, 2 * (least(until, n_bytes) - place))), '' ORDER BY place) AS h, count(*) - 1 AS n_spans
  FROM d JOIN piece USING (r) GROUP BY d.r)
SELECT doc_id, n_bytes, CAST(n_bytes - length(h) // 2 AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans, sha256(unhex(h)) AS kept_sha256 FROM kept"""
