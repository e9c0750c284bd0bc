import math
import hashlib

from tessera.llm import mixing

from .cases import AWKWARD, docs_frame


def draw(rate, u):
    k, p = 0, math.exp(-rate)
    cdf = p
    while cdf <= u:
        k += 1
        p *= rate / k
        cdf += p
    return k


def uniform(*key):
    return int(hashlib.md5(":".join(map(str, key)).encode()).hexdigest()[:13], 16) / 2**52


def test_counts_invert_the_poisson(spark):
    docs = docs_frame(spark, [f"t{i}" for i in range(2000)])
    got = {}
    for r in mixing.mix_sources(docs, weights={"a": 3, None: 1}, seed=5).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    rate = {"a": .75 * 2000 / 500, None: .25 * 2000 / 500, "b": 0.0}
    for r in docs.collect():
        assert got.get(r.doc_id, 0) == draw(rate[r.source], uniform(5, r.doc_id, 1))
    assert abs(sum(got.values()) - 2000) < 5 * math.sqrt(2000)


def test_large_means_are_sums(spark):
    docs = docs_frame(spark, [f"t{i}" for i in range(40)])
    rows = mixing.mix_sources(docs, weights={"a": 1}, total=100).collect()
    assert {r.source for r in rows} == {"a"} and abs(len(rows) - 4000) < 350
    assert {r.mix_rate for r in rows} == {400.0}
    assert len({(r.doc_id, r.mix_copy) for r in rows}) == len(rows)


def test_awkward_rows(spark):
    docs = docs_frame(spark, AWKWARD)
    out = mixing.mix_sources(docs)
    assert out.columns == [*docs.columns, "mix_rate", "mix_copy", "mix_key"]
    for hint in (0, 10_000):
        rows = mixing.mix_sources(docs, broadcast_sources=hint).collect()
        same = sorted((r.mix_key, r.mix_copy, str(r.text)) for r in rows)
        assert same == sorted((r.mix_key, r.mix_copy, str(r.text)) for r in out.collect())
    assert mixing.mix_sources(docs.limit(0)).collect() == []
    assert mixing.mix_sources(out).columns == out.columns


def test_no_python_on_the_path(spark):
    plan = mixing.mix_sources(docs_frame(spark, AWKWARD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
