import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import merkle

from .cases import AWKWARD, docs_frame

TEXTS = st.text(st.sampled_from(list("ab. \n#!")), max_size=80)


def leaves(node):
    return [node] if not node.children else [x for c in node.children for x in leaves(c)]


@settings(max_examples=300, deadline=None)
@given(TEXTS, TEXTS)
def test_trees(a, b):
    x, y = merkle.tree(a), merkle.tree(b)
    assert (x.digest == y.digest) == (a == b)
    assert x.size == len(a)
    from collections import Counter
    p, q = Counter(), Counter()
    for own, node in ((p, x), (q, y)):
        for n in leaves(node):
            own[n.digest, n.size] += 1 if n.size else 0
    both = sum(s * n for (_, s), n in (p & q).items())
    either = sum(s * n for (_, s), n in (p | q).items())
    assert abs(merkle.likeness(x, y) - (1.0 if a == b else both / either if either else 0.0)) < 1e-12
    assert merkle.likeness(x, y) == merkle.likeness(y, x)
    if a != b:
        start, stop = merkle.edit_span(x, y)
        back = len(a) - stop
        assert a[:start] == b[:start] and (not back or a[-back:] == b[-back:])


def test_query_against_whole_texts(spark):
    texts = [t for t in AWKWARD if not isinstance(t, tuple)] + [f"Line one. Line two.\nPart {i}! And so on.\n\n" * (i % 7) for i in range(60)]
    docs = docs_frame(spark, texts)
    plain = [t or "" for t in texts]
    for buckets in (1, 3, 40):
        got = {r.doc_id: r for r in merkle.fingerprint_edits(docs, buckets=buckets).collect()}
        assert sorted(got) == list(range(len(texts)))
        for i, t in enumerate(plain):
            after = plain[(i + 1) % len(plain)]
            half = len(t) // 2
            edited = t[:len(t) - half] + after[:half]
            r = got[i]
            assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.fingerprint == merkle.fingerprint(merkle.tree(t))
            assert r.edited_fingerprint == merkle.fingerprint(merkle.tree(edited))
            assert r.near_edited == merkle.likeness(merkle.tree(t), merkle.tree(edited))
            assert r.near_next == merkle.likeness(merkle.tree(t), merkle.tree(after))


def test_null_and_repeated_ids(spark):
    docs = docs_frame(spark, AWKWARD)
    rows = merkle.fingerprint_edits(docs, buckets=5).collect()
    assert len(rows) == len(AWKWARD) and sum(r.doc_id is None for r in rows) == 2
    assert merkle.fingerprint_edits(docs.limit(0)).collect() == []
    one = merkle.fingerprint_edits(docs.where("doc_id = 8")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    text = "one two three four five six"
    assert one[0].edited_sha256 == hashlib.sha256((text[:14] + text[:13]).encode()).hexdigest()


def test_nodes_cover_the_text(spark):
    docs = docs_frame(spark, ["a. b.\nc\n\n# head\nd", ""])
    rows = merkle.merkle_nodes(docs).collect()
    assert {r.level for r in rows} == {0, 1, 2, 3}
    for level in range(4):
        assert sum(r.size for r in rows if r.level == level and r.doc_id == 0) == 17
