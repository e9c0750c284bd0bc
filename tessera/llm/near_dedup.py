"""Near duplicates of texts: improved consistent weighted sampling over TF-IDF word shingles, banded,
verified by weighted Jaccard similarity.

1. Tasks hash the word shingles of blocks of documents and send them, packed and sorted, to
   ranges of the hash. A range counts each shingle's documents over the whole corpus and answers every
   block with those that occur in two documents or more. A shingle that many documents of a block
   share is sent once with its count; its documents wait in the block's own list. So a hot
   shingle costs a range a few entries a block, however many documents hold it.
2. A pair with weighted Jaccard similarity s shares at least s of either document's weight, and what
   is shared occurs twice. Documents with less such weight cannot have a partner and end here,
   without any loss. The others draw their weighted samples.
3. Equal vectors are one class. In every band's bucket the classes meet the smallest one (a star);
   buckets that still hold several components afterwards are compared in blocks of bounded size,
   without the smallest one and without the pairs inside the largest component.
   What leaves a block is a spanning forest of the links, so no pair that the bands bring
   together goes unexamined unless its two ends are already connected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import subwords
from .common import materialize, one_text_ids, release, released, sliced
from .components import components
from .vectors import _groups

MANY = np.uint32(0xFFFFFFFF)  # in place of a document: all documents of the block's list
ENTRIES, BLOCK, LISTS = 0, 1, 2
MIXER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(codes: np.ndarray, *numbers: np.ndarray) -> bytes:
    """Ascending codes (as differences) and 32-bit numbers, byte by byte, compressed."""
    steps = np.diff(codes, prepend=np.uint64(0)).astype("<u8")
    body = steps.view(np.uint8).reshape(-1, 8).T.tobytes() + b"".join(
        x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for x in numbers)
    return pa.compress(body, codec="zstd", asbytes=True)


def unpack(body: bytes, count: int, numbers: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(body, decompressed_size=count * (8 + 4 * numbers), codec="zstd", asbytes=True), np.uint8)
    codes = np.cumsum(np.ascontiguousarray(raw[:8 * count].reshape(8, count).T).view("<u8").ravel(), dtype=np.uint64)
    rest = raw[8 * count:].reshape(numbers, 4, count)
    return [codes, *(np.ascontiguousarray(x.T).view("<u4").ravel() for x in rest)]


def shingle_codes(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """56-bit hash and text number of every shingle of ``size`` words, by text and place.

    A text with fewer words has one shingle of all its words, one without words has none."""
    words = subwords.words_of(texts, digits=True)
    word = subwords.word_codes(words) if words.count else np.empty(0, np.uint64)
    length = np.diff(words.first)
    text = np.repeat(np.arange(len(texts)), length)
    code = np.zeros(max(0, words.count - size + 1), np.uint64)
    for k in range(size):
        code = (code + word[k:k + len(code)]) * MIXER
    whole = text[:len(code)] == text[size - 1:]
    codes, owner = [code[whole]], [text[:len(code)][whole]]
    for n in range(1, size):
        own = np.flatnonzero(length == n)
        code = np.full(len(own), n, np.uint64)
        for k in range(n):
            code = (code + word[words.first[own] + k]) * MIXER
        codes.append(code)
        owner.append(own)
    return mix(np.concatenate(codes)) >> np.uint64(8), np.concatenate(owner)


def _block(ids: list, texts: list[str], block: int, size: int, bits: int, many: int, damping: float) -> Iterator[tuple]:
    """Rows (range, block, kind, n, body) that a block of documents sends out."""
    codes, owner = shingle_codes(texts, size)
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(codes)))
    codes, owner = codes[at], owner[at].astype(np.uint32)
    counts = np.bincount(owner, minlength=len(texts)).astype("<i8")
    sums = np.bincount(owner, term_weight(times, damping), len(texts)).astype("<f8")
    first = np.ones(len(codes), bool)
    first[1:] = codes[1:] != codes[:-1]
    run = np.flatnonzero(first)
    docs = np.diff(np.append(run, len(codes)))
    hot = np.repeat(docs >= many, docs)
    if hot.any():
        body = pack(codes[hot], owner[hot], times[hot])
        yield int(mix(np.uint64([block]))[0] >> np.uint64(64 - bits)), block, LISTS, int(hot.sum()), body
        lead = hot & first
        keep = ~hot | lead
        owner = np.where(lead, MANY, owner)[keep]
        times = np.where(lead, np.repeat(docs, docs), times)[keep]
        codes = codes[keep]
    cuts = np.searchsorted(codes, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(56 - bits))
    for r, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if b > a:
            yield r, block, ENTRIES, b - a, pack(codes[a:b], owner[a:b], times[a:b])
    about = np.asarray([-1 if i is None else i for i in ids], "<i8").tobytes() + counts.tobytes() + sums.tobytes()
    yield int(mix(np.uint64([block + 1]))[0] >> np.uint64(64 - bits)), block, BLOCK, len(ids), about


SENT = pa.schema([("range", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("n", pa.int64()), ("body", pa.binary())])


def _answer(table: pa.Table) -> pa.Table:
    """A range's answer: entries of shingles that occur in two documents or more, with that number."""
    kinds = table.column("kind").to_numpy()
    through = table.select(["block", "kind", "n", "body"]).filter(pa.array(kinds != ENTRIES))
    rows = table.filter(pa.array(kinds == ENTRIES))
    if not rows.num_rows:
        return through
    blocks = rows.column("block").to_numpy()
    sizes = rows.column("n").to_numpy()
    parts = [unpack(b, n, 2) for b, n in zip(rows.column("body").to_pylist(), sizes)]
    codes, owner, times = (np.concatenate(x) for x in zip(*parts))
    source = np.repeat(np.arange(len(blocks)), sizes)
    order = np.argsort(codes, kind="stable")
    codes, owner, times, source = codes[order], owner[order], times[order], source[order]
    run = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    docs = np.add.reduceat(np.where(owner == MANY, times, 1).astype(np.int64), run)
    found = np.repeat(docs, np.diff(np.append(run, len(codes))))
    keep = np.flatnonzero(found >= 2)
    keep = keep[np.argsort(source[keep], kind="stable")]
    edge = np.searchsorted(source[keep], np.arange(len(blocks) + 1))
    out = [(int(blocks[s]), ENTRIES, int(b - a), pack(codes[own], owner[own], times[own], found[own]))
           for s, (a, b) in enumerate(zip(edge[:-1], edge[1:])) if b > a for own in (keep[a:b],)]
    answers = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                                   names=["block", "kind", "n", "body"]) if out else through.slice(0, 0)
    return pa.concat_tables([through, answers.cast(through.schema)])


def term_weight(times: np.ndarray, damping: float) -> np.ndarray:
    return 1 + damping * np.log(times)


def weights_of(times: np.ndarray, docs: np.ndarray, corpus: int, damping: float) -> np.ndarray:
    """Damped TF-IDF: (1 + d ln occurrences) * (1 + d ln(corpus / documents) / ln(corpus + 1)).

    With a small d the weighted similarity of texts stays near the plain one: neither a line that is
    repeated often nor an edit's unique shingles outweigh the rest."""
    return term_weight(times, damping) * (1 + damping * np.log(np.maximum(corpus, docs) / docs) / math.log(corpus + 1))


def weighted_samples(codes: np.ndarray, weights: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """``count`` improved consistent weighted samples of each weighted set, as 64-bit codes.

    Sets lie end to end from ``starts``. For element x and sample k: r and c are Gamma(2, 1) and b is
    uniform, all hashed from (x, k); t = floor(ln w / r + b); the element with the least
    ln c - r (t - b + 1) is drawn together with its t."""
    sizes = np.diff(np.append(starts, len(codes)))
    log_w = np.log(weights).astype(np.float32)
    out = np.empty((len(starts), count), np.uint64)

    def unit(bits: np.ndarray) -> np.ndarray:
        return (bits.astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24)

    low = np.uint64(0xFFFFFF)
    for k in range(count):
        a = mix(codes * MIXER + np.uint64(2 * k + 1))
        b = mix(a + np.uint64(2 * k + 2))
        r = -np.log(unit(a & low) * unit((a >> np.uint64(24)) & low))
        c = -np.log(unit(b & low) * unit((b >> np.uint64(24)) & low))
        beta = ((a >> np.uint64(48)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-16)
        t = np.floor(log_w / r + beta)
        score = np.log(c) - r * (t - beta + 1)
        least = np.minimum.reduceat(score, starts)
        hit = np.flatnonzero(score == np.repeat(least, sizes))
        hit = hit[np.searchsorted(hit, starts)]
        out[:, k] = mix(codes[hit] * MIXER ^ t[hit].astype(np.int64).astype(np.uint64))
    return out


def weighted_jaccard(a: tuple, b: tuple) -> float:
    """Sum of the lesser over the sum of the greater weights; a and b are (codes, weights, whole weight)."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    same = a[0][at] == b[0] if len(a[0]) else np.zeros(len(b[0]), bool)
    least = np.minimum(a[1][at[same]], b[1][same]).sum()
    return float(least / (a[2] + b[2] - least))


def _vector(n: int, whole: float, body: bytes, corpus: int, damping: float) -> tuple:
    codes, times, docs = unpack(body, n, 2)
    return codes, weights_of(times.astype(np.float64), docs.astype(np.float64), corpus, damping), whole


def near_duplicates(docs: DataFrame, threshold: float = 0.8, size: int = 5, damping: float = 0.25, bands: int = 20,
                    rows: int = 5, block_bytes: int = 1 << 21, many: int = 8, chunk: int = 256,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, group_id`` (smallest id of its group), ``kept`` (it is that one).

    Words are runs of letters, marks and digits in lower case; a shingle is ``size`` words, or all words
    of a shorter text. Weights are damped term and inverse document frequencies, the latter over all
    documents (``weights_of``). Null texts, empty texts and texts without a word have no shingle and group with
    nothing; null ids group with nothing; both are kept. Rows with equal ids are one document
    whose group joins all that is near to any of them. Other columns are ignored; an empty table
    gives an empty result. A pair at the threshold shares a band with probability
    1 - (1 - threshold ** rows) ** bands (0.9996 by default); nearer pairs more surely."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    split = one_text_ids(docs, id_col, text_col, "_one")
    if split is None:
        links = near_links(docs, threshold, size, damping, bands, rows, block_bytes, many, chunk, id_col, text_col)
    else:  # texts are compared one by one, their links are those of their ids
        found = near_links(split[0], threshold, size, damping, bands, rows, block_bytes, many, chunk, "_one", text_col)
        a, b = (split[1].select(F.col("_one").alias(c), F.col("id").alias(f"{c}_id")) for c in ("a", "b"))
        links = (found.join(a, "a").join(b, "b").where("a_id <> b_id")
                 .select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct())
    joined = components(links)
    return (ids.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", F.coalesce("component", "doc_id").alias("group_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("group_id"), F.lit(True))))


def candidates(docs: DataFrame, threshold: float, size: int, damping: float, count: int, rows: int, block_bytes: int,
               many: int, id_col: str, text_col: str, corpus: int) -> DataFrame:
    """Documents that share enough weight: ``doc_id, n, whole, body, k1, k2, codes`` (a code per band)."""
    spark = docs.sparkSession
    bits = max(4, (2 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        keys, texts, held = [], [], 0

        def out() -> pa.RecordBatch:
            got = list(_block(keys, texts, block, size, bits, many, damping))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got), SENT)], schema=SENT)

        for batch in sliced(batches, "text", block_bytes):
            keys += batch.column("doc_id").to_pylist()
            texts += batch.column("text").to_pylist()
            held += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
            if held >= block_bytes:
                yield out()
                block += 1
                keys, texts, held = [], [], 0
        if keys:
            yield out()

    def assemble(table: pa.Table) -> pa.Table:
        release()
        kinds = table.column("kind").to_numpy()
        about = table.filter(pa.array(kinds == BLOCK))
        raw = np.frombuffer(about.column("body")[0].as_py(), "<i8")
        keys, counts, sums = np.split(raw, 3)
        sums = sums.view("<f8")
        found = [unpack(b, n, 3) for k, n, b in zip(kinds, table.column("n").to_pylist(), table.column("body").to_pylist()) if k == ENTRIES]
        if not found:
            return CANDIDATES.empty_table()
        codes, owner, times, docs_ = (np.concatenate(x) for x in zip(*found))
        lists = table.filter(pa.array(kinds == LISTS))
        if lists.num_rows:
            lead = owner == MANY
            known, docs_of = codes[lead], docs_[lead]
            order = np.argsort(known)
            known, docs_of = known[order], docs_of[order]
            own_codes, own_docs, own_times = unpack(lists.column("body")[0].as_py(), lists.column("n")[0].as_py(), 2)
            at = np.searchsorted(known, own_codes)
            codes = np.concatenate([codes[~lead], own_codes])
            owner = np.concatenate([owner[~lead], own_docs])
            times = np.concatenate([times[~lead], own_times])
            docs_ = np.concatenate([docs_[~lead], docs_of[at]])
        order = np.lexsort((codes, owner))
        codes, owner, times, docs_ = codes[order], owner[order], times[order].astype(np.float64), docs_[order]
        weight = weights_of(times, docs_.astype(np.float64), corpus, damping)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        who = owner[starts]
        shared = np.add.reduceat(weight, starts)
        alone = counts[who] - np.diff(np.append(starts, len(codes)))
        rest = sums[who] - np.add.reduceat(term_weight(times, damping), starts)
        whole = shared + np.where(alone > 0, rest, 0.0) * weights_of(1.0, np.float64(1), corpus, damping)
        good = (shared >= threshold * whole - 1e-9) & (keys[who] >= 0)
        if not good.any():
            return CANDIDATES.empty_table()
        sizes = np.diff(np.append(starts, len(codes)))
        pick = np.repeat(good, sizes)
        codes, times, docs_, weight = codes[pick], times[pick], docs_[pick], weight[pick]
        sizes, who, whole, alone = sizes[good], who[good], whole[good], alone[good]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        drawn = weighted_samples(codes, weight, starts, count * rows).reshape(len(who), count, rows)
        band = np.zeros((len(who), count), np.uint64)
        for k in range(rows):
            band = mix((band + drawn[:, :, k]) * MIXER)
        seed = mix(codes * MIXER + times.astype(np.uint64))
        k1, k2 = np.add.reduceat(seed, starts), np.add.reduceat(mix(seed + np.uint64(77)), starts)
        k1 = np.where(alone > 0, keys[who].astype(np.uint64), k1)
        k2 = np.where(alone > 0, np.uint64(1), k2 | np.uint64(2))
        body = [pack(codes[a:a + n], times[a:a + n], docs_[a:a + n]) for a, n in zip(starts, sizes)]
        return pa.Table.from_arrays(
            [pa.array(keys[who]), pa.array(sizes.astype(np.int64)), pa.array(whole), pa.array(body, pa.binary()),
             pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(list(band.view(np.int64)), pa.list_(pa.int64()))],
            schema=CANDIDATES)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .where(F.col("text").isNotNull() & (F.col("text") != ""))
    sent = texts.mapInArrow(released(send), "range int, block long, kind int, n long, body binary")
    answers = sent.groupBy("range").applyInArrow(_answer, "block long, kind int, n long, body binary")
    return answers.groupBy("block").applyInArrow(
        assemble, "doc_id long, n long, whole double, body binary, k1 long, k2 long, codes array<long>")


CANDIDATES = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("whole", pa.float64()), ("body", pa.binary()),
                        ("k1", pa.int64()), ("k2", pa.int64()), ("codes", pa.list_(pa.int64()))])


def near_links(docs: DataFrame, threshold: float = 0.8, size: int = 5, damping: float = 0.25, bands: int = 20, rows: int = 5,
               block_bytes: int = 1 << 21, many: int = 8, chunk: int = 256, id_col: str = "doc_id",
               text_col: str = "text", broadcast_rows: int = 500_000) -> DataFrame:
    """Links (a, b) whose components are the groups of near duplicates: a spanning set, not all pairs."""
    corpus = docs.count()
    found = materialize(candidates(docs, threshold, size, damping, bands, rows, block_bytes, many, id_col, text_col, corpus),
                        "near-candidates")
    reps = materialize(found.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.any_value("codes").alias("codes")),
                       "near-classes")
    copies = (found.select("doc_id", "k1", "k2").join(reps.select("k1", "k2", "rep"), ["k1", "k2"])
              .where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))

    def vectors(ids: DataFrame, *more: str) -> DataFrame:
        """The vectors asked for; where the ids can go to all tasks the others need not be shuffled."""
        own, ids = found.select(F.col("doc_id").alias("rep"), "n", "whole", "body", *more), ids.distinct()
        return own.join(F.broadcast(ids), "rep", "left_semi") if ids.count() <= broadcast_rows else own

    # every class of a bucket meets the smallest one
    places = reps.select("rep", F.posexplode("codes").alias("band", "code"))
    hubs = places.groupBy("band", "code").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("m")).where("m > 1")
    pairs = materialize(places.join(hubs, ["band", "code"]).where("rep <> hub").select("hub", "rep").distinct(), "near-pairs")
    salts = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("salts"))
    salted = pairs.join(salts, "hub").select("hub", F.pmod(F.xxhash64("rep"), F.col("salts")).alias("salt"), "rep", F.lit(1).alias("role"))
    stars = salted.unionByName(salted.select("hub", "salt", F.col("hub").alias("rep"), F.lit(0).alias("role")).distinct())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, vector = None, None
        for batch in batches:
            a, b = [], []
            for own, rep, role, n, whole, body in zip(*(batch.column(c).to_pylist() for c in ("hub", "rep", "role", "n", "whole", "body"))):
                if not role:
                    hub, vector = own, _vector(n, whole, body, corpus, damping)
                elif own == hub and weighted_jaccard(vector, _vector(n, whole, body, corpus, damping)) >= threshold:
                    a.append(own)
                    b.append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    linked = (stars.join(vectors(pairs.select("rep").union(pairs.select("hub"))), "rep").repartition("hub", "salt").sortWithinPartitions("hub", "salt", "role")
              .mapInArrow(released(verify), "a long, b long"))
    links = materialize(copies.unionByName(linked), "near-links")

    # buckets that still hold several components are compared in blocks; all in them have met the hub, and the largest
    # component's classes need not meet one another
    joined = components(links).withColumnRenamed("node", "rep")
    known = places.join(hubs.select("band", "code", "hub"), ["band", "code"]).where("rep <> hub").join(joined, "rep", "left") \
        .select("band", "code", "rep", F.coalesce("component", "rep").alias("component"))
    open_ = (known.groupBy("band", "code", "component").agg(F.count(F.lit(1)).alias("m"))
             .groupBy("band", "code").agg(F.max(F.struct("m", "component")).alias("main"), F.sum("m").alias("m"), F.count(F.lit(1)).alias("several"))
             .where("several > 1")
             .select("band", "code", F.col("main.component").alias("main"), F.ceil(F.col("main.m") / chunk).cast("int").alias("more"),
                     F.ceil((F.col("m") - F.col("main.m")) / chunk).cast("int").alias("few")))
    dealt, beside = F.xxhash64(F.lit(5), "rep"), F.col("component") == F.col("main")
    blocks = (
        known.join(open_, ["band", "code"])
        .withColumn("own", F.when(beside, F.col("few") + F.pmod(dealt, F.col("more"))).otherwise(F.pmod(dealt, F.col("few"))).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(beside, F.col("few")).otherwise(F.col("few") + F.col("more")) - 1)))
        .where("own <> other")
        .select("band", "code", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"), "few", "own", "rep", "component"))
    key = ["band", "code", "c1", "c2"]

    # a class goes to a block with its vector only where a pair is left to it; the codes alone tell
    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, key):
            left = _left_in_block(group, group.column("c2")[0].as_py(), group.column("few")[0].as_py())
            if left.any():
                yield from group.drop_columns(["codes"]).filter(pa.array(left)).combine_chunks().to_batches()

    placed = materialize(blocks, "near-places")
    earlier = F.slice("codes", F.lit(1), F.col("band")).alias("codes")
    blocks = materialize(placed.join(reps.select("rep", "codes"), "rep").select(*placed.columns, earlier).repartition(*key).sortWithinPartitions(*key)
                         .mapInArrow(released(needed), placed.schema), "near-blocks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, key):
            band, c2, few = (group.column(k)[0].as_py() for k in ("band", "c2", "few"))
            got = list(_compare_block(group.to_pydict(), band, c2, few, threshold, corpus, damping))
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*got)], names=["a", "b"])

    more = (blocks.join(vectors(blocks.select("rep"), "codes"), "rep").repartition(*key).sortWithinPartitions(*key).mapInArrow(released(compare), "a long, b long"))
    return links.unionByName(materialize(more, "near-links"))


def _left_in_block(rows: pa.Table, c2: int, few: int) -> np.ndarray:
    """Which rows of a block (``codes``: of the earlier bands) ``_compare_block`` may compare with another one: of another component, in
    a chunk that it meets here, and equal in no earlier band."""
    component, owns = (rows.column(c).to_numpy() for c in ("component", "own"))
    codes = np.array(rows.column("codes").to_pylist(), np.int64).reshape(len(owns), -1)
    left = np.zeros(len(owns), bool)
    for i in np.flatnonzero(owns < few).tolist():
        meets = (component != component[i]) & ((owns != owns[i]) | (c2 == few)) & ~(codes == codes[i]).any(axis=1)
        if meets.any():
            left |= meets
            left[i] = True
    return left


def _compare_block(rows: dict, band: int, c2: int, few: int, threshold: float, corpus: int, damping: float) -> Iterator[tuple]:
    """Links between components of a block, each found pair joining its two; pairs whose codes agree in an
    earlier band are left to that band.

    Chunks below ``few`` hold the classes beside the largest component, the others those of that one. A chunk's
    own classes meet in its block with chunk ``few``."""
    component, owns, codes = rows["component"], rows["own"], rows["codes"]
    head = {c: c for c in component}
    vectors: dict[int, tuple] = {}

    def top(c: int) -> int:
        while head[c] != c:
            head[c] = head[head[c]]
            c = head[c]
        return c

    def vector(i: int) -> tuple:
        if i not in vectors:
            vectors[i] = _vector(rows["n"][i], rows["whole"][i], rows["body"][i], corpus, damping)
        return vectors[i]

    beside = [i for i, own in enumerate(owns) if own < few]
    main = [i for i, own in enumerate(owns) if own >= few]
    for at, i in enumerate(beside):
        for j in main + beside[:at]:
            if (owns[i] == owns[j] and c2 != few) or top(component[i]) == top(component[j]):
                continue
            if any(x == y for x, y in zip(codes[i][:band], codes[j][:band])):
                continue
            if weighted_jaccard(vector(i), vector(j)) >= threshold:
                head[top(component[i])] = top(component[j])
                yield rows["rep"][i], rows["rep"][j]


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 1_000_000,
                         **options) -> DataFrame:
    """The documents without those that have a smaller near duplicate. Rows that repeat an id and a text
    are one document and stay once; rows with one id and different texts are documents of their own, in the order of their texts'
    hashes. Null, empty and wordless texts and rows with a null id stay. The columns stay as they are; an empty table stays empty."""
    if (split := one_text_ids(docs, id_col, text_col, "_one")) is not None:
        return drop_near_duplicates(split[0], "_one", text_col, broadcast_rows, **options).drop("_one")
    links = near_links(docs, id_col=id_col, text_col=text_col, **options)
    gone = materialize(components(links).where("node <> component").select("node"), "near-gone")
    twice = (docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("node")).agg(F.count(F.lit(1)).alias("m"))
             .where("m > 1").select("node"))
    if gone.count() <= broadcast_rows:
        gone = F.broadcast(gone)
    kept = docs.join(gone, docs[id_col].eqNullSafe(F.col("node")), "left_anti")
    twice = materialize(twice, "near-twice")
    number = twice.count()
    if not number:
        return kept
    twice = F.broadcast(twice) if number <= broadcast_rows else twice
    once = kept.join(twice, kept[id_col] == F.col("node"), "left_anti")
    return once.unionByName(kept.join(twice, kept[id_col] == F.col("node"), "left_semi").dropDuplicates([id_col, text_col]))
