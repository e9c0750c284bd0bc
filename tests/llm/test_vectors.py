import numpy as np
from pyspark.sql import types as T

from tessera.llm import vectors
from tessera.llm.components import components

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("n", T.StringType()), T.StructField("rep", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, x, "a", "b") for i, v, x in rows], SCHEMA)


def brute(rows, threshold=0.98):
    def ok(v, x):
        return x is not None and v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)
    data = [(np.float32(v).astype(float) if ok(v, x) else None, x) for _, v, x in rows]
    links = [set() for _ in rows]
    for i, (a, x) in enumerate(data):
        for j, (b, y) in enumerate(data):
            if i != j and a is not None and b is not None and x == y and len(a) == len(b):
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold:
                    links[i].add(j)
    out = []
    for i, (key, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((key, len(links[i]), least if least is not None else None))
    return out


def made(n, seed):
    rng = np.random.default_rng(seed)
    rows = []
    base = rng.normal(size=(6, 16))
    for i in range(n):
        v = base[i % 6] + rng.normal(size=16) * (0.05 if i % 3 else 1.0)
        rows.append((i, [float(c) for c in v.astype(np.float32)], int(i % 2)))
    return rows + [(n + k, rows[k % 7][1], rows[k % 7][2]) for k in range(40)]


def test_against_brute_force(spark):
    rows = made(260, 1)
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] + [1.0] * 15, 1), (904, [None] + [1.0] * 15, 1),
             (905, rows[0][1], None), (906, [], 1), (907, [1.0, 2.0], 1), (908, [2.0, 4.0], 1), (909, [-0.0, 1.0], 1), (910, [0.0, 1.0], 1)]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.link_vectors(frame(spark, rows), recall=0.99999).collect())
    assert got == sorted(brute(rows))


def test_blocks_change_nothing(spark):
    rows = made(200, 2)
    table = frame(spark, rows)
    whole = sorted(map(tuple, vectors.link_vectors(table, recall=0.9999).collect()))
    assert whole == sorted(map(tuple, vectors.link_vectors(table, recall=0.9999, chunk=7).collect()))
    assert all(kept == (i == c) for i, _, c, kept in whole)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    bits = 10
    count = vectors.tables_for(bits, 0.98, 0.995)
    planes = vectors.hyperplanes(bits * count, 32, 1)
    a = rng.normal(size=(2000, 32))
    b = rng.normal(size=a.shape)
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    same = ((a @ planes.T > 0) == (b @ planes.T > 0)).reshape(len(a), count, bits).all(axis=2).any(axis=1)
    assert same.mean() > 0.985


def test_ties_null_ids_and_empty(spark):
    v = [1.0] * 4
    rows = [(7, v, 1), (7, v, 1), (None, v, 1), (3, v, 2)]
    got = sorted(vectors.link_vectors(frame(spark, rows)).collect(), key=str)
    assert sorted((r.vec_id is None, r.n_links, r.component_id) for r in got) == [(False, 0, 3), (False, 2, 7), (False, 2, 7), (True, 2, 7)]
    assert vectors.link_vectors(frame(spark, [])).collect() == []
    assert len(vectors.link_vectors(frame(spark, rows), label_col=None).where("n_links = 3").collect()) == 4


def test_components_of_paths_hubs_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, k) for k in range(1001, 1100)] + [(2000 + i, 2000 + (i + 1) % 9) for i in range(9)]
    links += [(5, 5), (None, 3), (41, 40), (41, 40)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(42)} | {k: 1000 for k in range(1000, 1100)} | {2000 + i: 2000 for i in range(9)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
