"""Spelling variants: words that differ by one inserted, deleted or replaced code point, by pairs of trie nodes.

The words, sorted, make a trie, and the words read backwards another one. The nodes of both get numbers: a sorted range numbers
the nodes that its words add, and the ranges are put in a row by the path that the last word of a range hands on to the next. A place in a
word is then a pair of integers (node of what is before it, node of what is behind it). Words that differ by a replaced code point
have the same pair around the skipped one; a word that lacks a code point has that pair at one of its cuts. So one
sort by pairs finds exactly the near words, without a comparison of texts. A pair has at most one word cut there and one word for each
letter of the alphabet skipped there, so its rows are few whatever the data.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sqltext
from .common import clean_text, materialize, released, sliced

#: different words that a task counts before it hands them on
HELD = 300_000


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3,
                slip: int | None = 97) -> DataFrame:
    """``word, n``. A run of letters whose crc32 with its document's id is divisible by ``slip`` loses one code point."""
    letters = re.compile("[a-zÀ-ÿ]{%d,}" % max(1, least_length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in sliced(batches, "text", 1 << 20):
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                found = Counter(letters.findall(text.encode().lower().decode()))  # bytes: lowers A-Z alone
                if slip:
                    seed = zlib.crc32(f"{key}:".encode())
                    for word in [w for w in found if zlib.crc32(w.encode(), seed) % slip == 0]:
                        n, at = found.pop(word), zlib.crc32(word.encode(), seed) % len(word)
                        if len(word) > least_length:
                            held[word[:at] + word[at + 1:]] += n
                held.update(found)
            if len(held) >= HELD:
                yield told()
                held.clear()
        if held:
            yield told()

    rows = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("key"), clean_text(text_col).alias("text"))
    return (rows.mapInArrow(released(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least_count))


def common(a: str, b: str) -> int:
    """Code points that two words have in common at their beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def number_nodes(words: DataFrame, col: str, name: str) -> DataFrame:
    """``words`` (distinct in ``col``) with ``path``: the numbers of the trie's nodes below the root (0) on the
    way of the word, from 1 in sorted order; so a word's last node ascends with the word."""
    fields = words.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, path, top = TaskContext.get().partitionId(), "", [], 0
        for batch in batches:
            paths, ends = [], [0]
            for word in batch.column(col).to_pylist():
                keep = common(last, word)
                path = path[:keep] + list(range(top + 1, top + 1 + len(word) - keep))
                top += len(word) - keep
                last = word
                paths += path
                ends.append(len(paths))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(paths, pa.int64()))], names=[*fields, "_part", "path"])

    local = materialize(words.repartitionByRange(F.col(col)).sortWithinPartitions(col)
                        .mapInArrow(run, f"{kinds}, _part int, path array<long>"), name)
    # one row a range: its first and last word and the last one's path
    ranges = (local.groupBy("_part").agg(F.min(col).alias("first"), F.max(col).alias("last"), F.max_by("path", col).alias("path"),
                                         F.max(F.array_max("path")).alias("top")).orderBy("_part").collect())
    last, path, total, rows = "", [], 0, []
    for r in ranges:
        given = path[:common(last, r["first"])]  # nodes that earlier ranges have numbered
        base = total - len(given)
        rows.append((r["_part"], given, base))
        path = [given[x - 1] if x <= len(given) else base + x for x in r["path"]]
        last, total = r["last"], base + r["top"]
    carried = local.sparkSession.createDataFrame(rows, "_part int, given array<long>, base long")
    return (local.join(F.broadcast(carried), "_part")
            .withColumn("path", F.expr("transform(path, x -> if(x <= size(given), element_at(given, int(x)), base + x))"))
            .drop("_part", "given", "base"))


CUT, SKIP, SKIP_AGAIN = 0, 1, 2
PLACES = "p long, s long, id long, n long, kind tinyint"


def places(words: DataFrame) -> DataFrame:
    """The pairs of nodes around each cut and each skipped code point of every word (id, n, word, path, back).
    A skip that repeats the code point before it (kind 2) gives the same shorter word again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            text = np.frombuffer("".join(batch.column("word").to_pylist()).encode("utf-32-le"), np.uint32)
            ahead, back = (batch.column(c).flatten().to_numpy() for c in ("path", "back"))
            size = batch.column("path").value_lengths().to_numpy()
            at = np.cumsum(size) - size
            ids, counts = batch.column("id").to_numpy(), batch.column("n").to_numpy()
            for skip in (1, 0):
                each = size + 1 - skip
                word = np.repeat(np.arange(len(size)), each)
                i = np.arange(len(word)) - np.repeat(np.cumsum(each) - each, each)
                behind = size[word] - i - skip  # code points behind the place
                p = np.where(i > 0, ahead[at[word] + i - 1], 0)
                s = np.where(behind > 0, back[at[word] + behind - 1], 0)
                kind = np.zeros(len(word), np.int8)
                if skip:
                    kind[:] = SKIP
                    again = i > 0
                    again[1:] &= text[1:] == text[:-1]
                    kind[again] = SKIP_AGAIN
                for lo in range(0, len(word), 1 << 16):
                    part = slice(lo, lo + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(x[part]) for x in (p, s, ids[word], counts[word], kind)],
                                                     names=["p", "s", "id", "n", "kind"])

    return words.select("id", "n", "word", "path", "back").mapInArrow(run, PLACES)


MET = "id long, near long, best_n long, best long"


def _meet(p, s, ids, n, kind) -> pa.RecordBatch:
    """What the rows of whole pairs tell: for each word how many near words it meets, and the best of them."""
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (s[1:] != s[:-1])
    group = np.cumsum(new) - 1
    groups = int(group[-1]) + 1
    cut = np.full(groups, -1)
    cut[group[kind == CUT]] = np.flatnonzero(kind == CUT)

    def tops(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of ``rows`` in each group, and its best and second best row (-1: none)."""
        ranked = rows[np.lexsort((ids[rows], -n[rows], group[rows]))]
        count = np.bincount(group[ranked], minlength=groups)
        start = np.cumsum(count) - count
        best, second = np.full(groups, -1), np.full(groups, -1)
        best[count > 0] = ranked[start[count > 0]]
        second[count > 1] = ranked[start[count > 1] + 1]
        return count, best, second

    skips = np.flatnonzero(kind != CUT)
    count, best, second = tops(skips)
    once, longer, _ = tops(np.flatnonzero(kind == SKIP))
    near, found = np.zeros(len(p), np.int64), np.full(len(p), -1)
    own = group[skips]
    near[skips] = count[own] - 1
    found[skips] = np.where(best[own] == skips, second[own], best[own])
    shorter = np.where(kind == SKIP, cut[group], -1)
    near += shorter >= 0
    better = (shorter >= 0) & ((found < 0) | (n[shorter] > n[found]) | ((n[shorter] == n[found]) & (ids[shorter] < ids[found])))
    found = np.where(better, shorter, found)
    at = cut[cut >= 0]
    near[at], found[at] = once[cut >= 0], longer[cut >= 0]
    rows = np.flatnonzero(near > 0)
    return pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(near[rows]), pa.array(n[found[rows]]), pa.array(ids[found[rows]])],
                                      names=["id", "near", "best_n", "best"])


def meet(sorted_places: DataFrame) -> DataFrame:
    """``_meet`` over rows that are sorted by pair; the last pair of a batch waits for the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = [c.to_numpy() for c in batch.columns]
            if not len(rows[0]):
                continue
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            same = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
            done = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if done:
                yield _meet(*(x[:done] for x in rows))
            held = [x[done:] for x in rows]
        if held is not None:
            yield _meet(*held)

    return sorted_places.mapInArrow(run, MET)


def last_forms(links: DataFrame, most: int) -> DataFrame:
    """``id, to`` with each link followed to its end, of at most ``most`` steps, by doubling."""
    steps = 1
    while steps < most:
        onward = links.select(F.col("id").alias("to"), F.col("to").alias("_next"))
        links = materialize(links.join(onward, "to", "left").select("id", F.coalesce("_next", "to").alias("to")), "spelling-roots")
        steps *= 2
    return links


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3,
                      slip: int | None = 97) -> DataFrame:
    """One row per word: ``word, n`` (occurrences), ``n_near`` (near words), ``form`` and ``form_n`` (the near word of largest n, if that is
    at least twice the word's; else null) and ``root`` (the last form on the way; the word itself without one).

    Words are the runs of letters (A-Z lowered) of at least ``least_length`` code points with at least ``least_count``
    occurrences in all rows. With ``slip``, one run in so many, told by its document's id, loses a code point before it is counted (a
    null id counts as empty text). Null and empty texts have no words, repeated rows count again, ties of n go to the smaller word in
    code-point order. Words of any length are taken; their cost is their length. Other columns are ignored; an empty table gives an empty result."""
    counted = materialize(count_words(docs, id_col, text_col, least_length, least_count, slip), "spelling-words")
    ahead = number_nodes(counted, "word", "spelling-ahead").withColumn("id", F.element_at("path", -1))
    ahead = materialize(ahead, "spelling-numbered")
    back = number_nodes(ahead.select("id", F.reverse("word").alias("reversed")), "reversed", "spelling-back")
    both = ahead.join(back.select("id", F.col("path").alias("back")), "id")
    met = meet(places(both).repartition("p", "s").sortWithinPartitions("p", "s"))
    near = met.groupBy("id").agg(F.sum("near").alias("n_near"), F.max(F.struct("best_n", (-F.col("best")).alias("less"))).alias("b"))
    words = ahead.select("id", "word", "n")
    known = materialize(
        words.join(near, "id", "left")
        .withColumn("to", F.when(F.col("b.best_n") >= 2 * F.col("n"), -F.col("b.less")))
        .select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "to"), "spelling-near")
    links = known.filter("to is not null").select("id", "to")
    most = int(known.agg(F.max("n")).first()[0] or 1).bit_length()  # n doubles with every step
    roots = last_forms(links, most)
    forms = words.select(F.col("id").alias("to"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    ends = words.select(F.col("id").alias("_end"), F.col("word").alias("_root"))
    return (known.join(forms, "to", "left").join(roots.withColumnRenamed("to", "_end").join(ends, "_end"), "id", "left")
            .select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n"))


def variants_sql(least_length: int = 5, least_count: int = 3, slip: int = 97) -> str:
    """DuckDB text for the same result."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""WITH RECURSIVE runs AS (SELECT doc_id, translate(r, '{upper}', '{upper.lower()}') AS w, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents) GROUP BY ALL),
hashed AS (SELECT w, c, {sqltext.crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w")} AS h FROM runs WHERE length(w) >= {least_length}),
slipped AS (SELECT CASE WHEN h % {slip} = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w, c FROM hashed),
words AS MATERIALIZED (SELECT w, CAST(sum(c) AS BIGINT) AS n FROM slipped WHERE length(w) >= {least_length} GROUP BY w HAVING sum(c) >= {least_count}),
skip AS MATERIALIZED (SELECT w, left(w, i) AS p, substr(w, i + 2) AS s FROM (SELECT w, unnest(range(length(w))) AS i FROM words)),
shorter AS (SELECT DISTINCT skip.w, words.w AS v FROM skip JOIN words ON words.w = p || s),
near AS (SELECT a.w, b.w AS v FROM skip a JOIN skip b ON a.p = b.p AND a.s = b.s AND a.w <> b.w
  UNION ALL SELECT w, v FROM shorter UNION ALL SELECT v, w FROM shorter),
best AS (SELECT near.w, v, x.n AS vn, count(*) OVER (PARTITION BY near.w) AS n_near, row_number() OVER (PARTITION BY near.w ORDER BY x.n DESC, v) AS k
  FROM near JOIN words x ON x.w = v),
known AS MATERIALIZED (SELECT words.w, n, coalesce(n_near, 0) AS n_near, CASE WHEN vn >= 2 * n THEN v END AS form, CASE WHEN vn >= 2 * n THEN vn END AS form_n
  FROM words LEFT JOIN best ON best.w = words.w AND k = 1),
way AS (SELECT w, w AS here FROM known UNION ALL SELECT way.w, form FROM way JOIN known ON known.w = way.here WHERE form IS NOT NULL),
ends AS (SELECT way.w, here FROM way JOIN known ON known.w = way.here WHERE form IS NULL)
SELECT known.w AS word, form, ends.here AS root, n, n_near, form_n FROM known JOIN ends ON ends.w = known.w"""
