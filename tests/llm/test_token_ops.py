"""Token counts and packing against the libraries' own whole-text results."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import packing, token_counts

from .cases import AWKWARD, docs_frame

TEXTS = st.text(st.sampled_from(list(" \n\t\x1c\x85 ▁ab,.'s1²½é😀<|>endoftext")), max_size=60)


@pytest.fixture(scope="module")
def model():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=token_counts.default_model())


@pytest.fixture(scope="module")
def vocabulary():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_counts_equal_whole_encoding(model, texts):
    assert token_counts.counter(token_counts.default_model()).counts(texts) == [len(model.encode(t)) for t in texts]


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_ids_equal_whole_encoding(vocabulary, texts):
    got = packing.encoder(packing.default_vocabulary()).ids(texts)
    want = [vocabulary.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


def test_special_strings_and_blanks(vocabulary, model):
    texts = ["<|endoftext|>", "a<|endoftext|>b <|endoftext|> c", " lead", "trail ", "a\n b", "a \nb", "a\xa0 \xa0b", "\n\n a  b", "\x1c <|endoftext|>"]
    want = [vocabulary.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.encoder(packing.default_vocabulary()).ids(texts)] == want
    texts += ["<s> </s><unk>", "▁ ▁", " "]
    assert token_counts.counter(token_counts.default_model()).counts(texts) == [len(model.encode(t)) for t in texts]


def test_token_counts_query(spark, model):
    docs = docs_frame(spark, AWKWARD)
    got = sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs).collect())
    texts = [(t[1] if isinstance(t, tuple) else t) or "" for t in AWKWARD]
    want = sorted((len(t.encode()), len(model.encode(t)), len(model.encode(t)) > 4096) for t in texts)
    assert got == want
    assert token_counts.count_tokens(docs.limit(0)).collect() == []


def test_packing_query(spark, vocabulary):
    docs = docs_frame(spark, AWKWARD)
    got = packing.pack_documents(docs, keep_ids=True).collect()
    texts = [(t[1] if isinstance(t, tuple) else t) or "" for t in AWKWARD]
    want = []
    for t in texts:
        ids = [*vocabulary.encode(t, add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        want += [(k, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert all(zlib.crc32(np.asarray(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and own[0][0] == 0
        assert sum(n for _, n in own) <= 1024
    assert len(by) <= 1 + sum(r.length for r in got) / 1024 * 1.2
    assert packing.pack_documents(docs.limit(0)).collect() == []


def test_best_fit_closes_the_fullest():
    bins, offsets = packing.best_fit([6, 5, 4, 5, 7], 10, 2)
    assert bins.tolist() == [0, 1, 0, 1, 2] and offsets.tolist() == [0, 0, 6, 5, 0]
    bins, _ = packing.best_fit([6, 7, 8, 3, 4], 10, 2)  # the bin of 7 closes for 8, 8 for 3 is not possible
    assert bins.tolist() == [0, 1, 2, 0, 3]


def test_groups_pack_alike(spark):
    docs = docs_frame(spark, [f"text {i} " * (i % 50) for i in range(400)])
    rows = packing.pack_documents(docs, group_pieces=100).collect()
    assert len({r.sequence_id >> 32 for r in rows}) > 1 and len({(r.doc_id, r.piece) for r in rows}) == len(rows)
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 1024 and len(fill) <= sum(fill.values()) / 1024 * 1.1 + 5
