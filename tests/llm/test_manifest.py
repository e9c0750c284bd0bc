"""The manifest against a plain build of the same trees."""

import hashlib
import zlib

import pytest

from tessera.llm.manifest import dataset_manifest

from .cases import AWKWARD, docs_frame


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """Levels up to the single node."""
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([sha("".join(rows[-1][i:i + 3])) for i in range(0, len(rows[-1]), 3)])
    return rows


def path(rows, at):
    out = []
    for row in rows[:-1]:
        first = at - at % 3
        out.append(("".join(row[first:at]), "".join(row[at + 1:first + 3])))
        at //= 3
    return out


def brute(rows):
    by = {}
    for r in rows:
        leaf = sha("".join(field(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))
        text = r["text"]
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and text is not None:
            text = text.replace("\n", "")
        other = sha("".join(map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))
        by.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, other, r["doc_id"]))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for at, x in enumerate(sorted(by[s], key=lambda x: x[:3])):
            steps = path(trees[s], at) + path(top, k)
            node = x[3]
            for a, b in steps:
                node = sha(a + node + b)
            out.append((x[4], x[2], trees[s][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), node, node == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("depth", [1, 2, 8])
def test_equals_a_plain_build(spark, depth):
    docs = docs_frame(spark, [*AWKWARD, *(f"line {i}\nnext {i}" for i in range(40))])
    got = sorted((tuple(r) for r in dataset_manifest(docs, depth=depth).select(*COLUMNS).collect()), key=str)
    assert got == brute([r.asDict() for r in docs.collect()])
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_one_document_many_sources_and_none(spark):
    one = docs_frame(spark, ["a\nb"])
    assert [tuple(r) for r in dataset_manifest(one).select(*COLUMNS).collect()] == brute([r.asDict() for r in one.collect()])
    many = docs_frame(spark, ["x\n"] * 30).selectExpr("doc_id", "text", "lang", "concat('s', doc_id) source", "n_chars")
    got = sorted((tuple(r) for r in dataset_manifest(many, depth=1).select(*COLUMNS).collect()), key=str)
    assert got == brute([r.asDict() for r in many.collect()])
    assert dataset_manifest(one.limit(0)).count() == 0
