"""Merkle fingerprints of documents.

A text is a tree: root, sections, paragraphs, sentences. Every node's hash covers its children's
hashes in order (a leaf's covers its characters), so equal roots mean equal texts. Two trees
are compared from the top: equal branches count whole without being opened, and the first and
the last branch that differ are followed down, which locates the edit.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_text, released, sliced

#: a leaf: at most 128 characters up to the end of a sentence
LEAVES = re.compile(r"[^.!?]{1,128}[.!?]*|[.!?]+", re.S)
PARAGRAPHS = re.compile(r"[^\n]*\n+|[^\n]+")


@dataclass(slots=True)
class Node:
    digest: bytes
    size: int  # code points
    children: list[Node] = field(default_factory=list)


def parent(children: list[Node]) -> Node:
    joined = b"".join(c.digest for c in children)
    return Node(hashlib.blake2b(joined, digest_size=16, person=b"node").digest(), sum(c.size for c in children), children)


def leaf(text: str) -> Node:
    own = text.encode("utf-8", "surrogatepass")
    return Node(hashlib.blake2b(own, digest_size=16, person=b"leaf").digest(), len(text))


def paragraph(text: str) -> Node:
    return parent([leaf(x) for x in LEAVES.findall(text)])


def tree(text: str, known: dict[str, Node] | None = None) -> Node:
    """The text's tree. A section ends at an empty line, before a heading (#), or after a
    paragraph whose hash says so (one in eight), so that an edit moves no section but its own.
    ``known`` keeps paragraphs over several calls."""
    known = {} if known is None else known
    sections: list[Node] = []
    own: list[Node] = []
    for part in PARAGRAPHS.findall(text):
        if own and part.startswith("#"):
            sections.append(parent(own))
            own = []
        node = known.get(part)
        if node is None:
            node = known[part] = paragraph(part)
        own.append(node)
        if part.endswith("\n\n") or node.digest[0] < 32:
            sections.append(parent(own))
            own = []
    if own:
        sections.append(parent(own))
    return parent(sections)


def fingerprint(node: Node) -> str:
    return node.digest.hex()


def _unmatched(a: list[Node], b: list[Node]) -> tuple[int, list[Node], list[Node]]:
    """Code points in equal branches of two levels, and the children of those left over."""
    left = Counter(x.digest for x in b)
    same, rest_a = 0, []
    for x in a:
        if left[x.digest] > 0:
            left[x.digest] -= 1
            same += x.size
        else:
            rest_a += x.children
    rest_b: list[Node] = []
    for x in b:
        if left[x.digest] > 0:
            left[x.digest] -= 1
            rest_b += x.children
    return same, rest_a, rest_b


def likeness(a: Node, b: Node) -> float:
    """Code points in branches that both trees have, over those in either; 1 for equal roots."""
    if a.digest == b.digest:
        return 1.0
    same, level_a, level_b = 0, a.children, b.children
    while level_a and level_b:
        more, level_a, level_b = _unmatched(level_a, level_b)
        same += more
    either = a.size + b.size - same
    return same / either if either else 0.0


def edit_span(a: Node, b: Node) -> tuple[int, int] | None:
    """Code points [from, to) of ``a`` that hold all leaves that differ from ``b``; None for equal roots."""
    if a.digest == b.digest:
        return None

    def skipped(x: list[Node], y: list[Node], step: int) -> int:
        size = 0
        while x and y:
            n = 0
            while n < len(x) and n < len(y) and x[::step][n].digest == y[::step][n].digest:
                size += x[::step][n].size
                n += 1
            if n >= len(x) or n >= len(y):
                break
            x, y = x[::step][n].children[::step][::step], y[::step][n].children[::step][::step]
        return size

    start = skipped(a.children, b.children, 1)
    return start, max(start, a.size - skipped(a.children, b.children, -1))


def merkle_nodes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 slice_bytes: int = 1 << 21) -> DataFrame:
    """The trees as rows: ``doc_id, level`` (0 root to 3 leaf), ``position, start, size, digest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in sliced(iter([pa.RecordBatch.from_pandas(batch)]), "text", slice_bytes):
                rows = []
                for key, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    level = [tree(text)]
                    for depth in range(4):
                        at = 0
                        for k, node in enumerate(level):
                            rows.append((key, depth, k, at, node.size, node.digest.hex()))
                            at += node.size
                        level = [c for node in level for c in node.children]
                yield pd.DataFrame(rows, columns=["doc_id", "level", "position", "start", "size", "digest"])

    rows = docs.select(docs[id_col].alias("doc_id"), clean_text(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, level int, position int, start long, size long, digest string")


def followed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Rows ``_bucket, _after, doc_id, text`` such that each bucket, ordered by (_after, doc_id, text),
    holds consecutive documents and then, with _after = 1, the first document of what follows.

    Buckets are ranges of the id cut at quantiles, so no range of ids is crowded, and the bounds are
    ids of the table. One shuffle moves each text once; only the first id of each bucket goes
    to the driver (``buckets`` numbers)."""
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), clean_text(text_col).alias("text"))
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    fractions = F.array(*(F.lit(k / n) for k in range(n)))
    got = rows.agg(F.percentile_approx("doc_id", fractions, F.lit(100 * n)).alias("q"), F.min("doc_id").alias("least"),
                   F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    least = -(1 << 63)
    bounds = sorted({*(got["q"] or []), *([] if got["least"] is None else [got["least"]])})
    if got["nulls"]:  # null ids come first, in a bucket of their own
        bounds = [least, *bounds]
    at = np.asarray(bounds, dtype=np.int64)
    last = len(bounds) - 1

    @F.pandas_udf("array<struct<bucket:int,after:int>>")
    def places(ids: pd.Series) -> pd.Series:
        key = ids.fillna(least).astype("int64").to_numpy() if ids.dtype != "int64" else ids.to_numpy()
        bucket = np.searchsorted(at, key, side="right") - 1
        first = at[bucket] == key
        return pd.Series([[(int(b), 0), (int(b) - 1 if b else last, 1)] if f else [(int(b), 0)]
                          for b, f in zip(bucket, first)])

    return (rows.withColumn("_p", F.explode(places("doc_id")))
            .select(F.col("_p.bucket").alias("_bucket"), F.col("_p.after").alias("_after"), "doc_id", "text"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None,
                      slice_bytes: int = 1 << 21) -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next document, with their likeness.

    Documents follow each other by id (null ids first, rows with equal ids by text); the first
    follows the last, and a single document follows itself. The edited text is the text whose
    last floor(n/2) code points are replaced by the first as many (or all) of the next one's.
    Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_sections, n_paragraphs, edit_from, edit_to`` (null if the edit changes nothing). Null
    texts are empty ones; the likeness of two empty texts is 1, of an empty and another 0. An empty table
    gives an empty result; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None  # bucket, id, text, tree
        done = -1  # bucket whose following document has been seen
        for batch in sliced(batches, "text", slice_bytes):
            out: list[tuple] = []
            known: dict[str, Node] = {}
            for bucket, after, key, text in zip(*(batch.column(c).to_pylist() for c in ("_bucket", "_after", "doc_id", "text"))):
                if after and bucket == done:
                    continue  # further rows with the same first id
                own = tree(text, known)
                if before is not None and before[0] == bucket:
                    out.append(_compared(before[1], before[2], before[3], text, own, known))
                before = (bucket, key, text, own)
                if after:
                    done, before = bucket, None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TYPES)], names=NAMES)

    placed = followed(docs, id_col, text_col, buckets)
    return (placed.repartition("_bucket").sortWithinPartitions("_bucket", "_after", "doc_id", "text")
            .mapInArrow(released(run), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                             "edited_fingerprint string, near_edited double, near_next double, n_sections int, "
                             "n_paragraphs int, edit_from long, edit_to long"))


TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(),
         pa.int32(), pa.int64(), pa.int64()]
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
         "n_sections", "n_paragraphs", "edit_from", "edit_to"]


def _compared(key, text: str, own: Node, after: str, other: Node, known: dict[str, Node]) -> tuple:
    half = len(text) // 2
    edited = text[:len(text) - half] + after[:half]
    changed = tree(edited, known)
    span = edit_span(own, changed) or (None, None)
    return (key, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(own),
            fingerprint(changed), likeness(own, changed), likeness(own, other), len(own.children),
            sum(len(s.children) for s in own.children), *span)
