"""Merkle manifest of a dataset: a tree over the rows of each source, a tree over the sources.

The leaves of a source ascend by id and every three consecutive nodes become their parent, level by level.
A superblock is ``3 ** depth`` neighbouring nodes. A table of nodes climbs in rounds: each round reduces every
superblock to one node, until a source has one node left (its subroot). Subroots then climb alike to the root.
On the way back every superblock gets the nodes outside it that its proofs need: its own members and those outer
nodes are cogrouped by superblock, and one call finishes the local reduction, joins local and outer proofs and folds them.

Positions come from a sort by (source, id, leaf) into ranges, so neither a hot source nor a hot or null id is
gathered; what a range holds of a source is counted, and the counts are summed along the ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import sqltext
from .common import materialize

FAN = 3


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    """Null as ``-``; else the bytes of the value as text, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column, fields=("doc_id", "source", "lang", "n_chars")) -> Column:
    return F.sha2(F.concat(*(_field(F.col(c)) for c in fields), _field(text)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``_key`` (the source; empty for null, which sorts first), ``doc_id``, ``leaf`` and ``tampered``
    (the leaf after the line ends have been deleted from rows with an even crc32 of the id; a null id is not tampered)."""
    cut = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit("")))
    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_key"),
                       F.col("doc_id").cast("long").alias("doc_id"), F.unhex(leaf_digest(text)).alias("leaf"),
                       F.unhex(F.when(cut.isNotNull() & (cut != text), leaf_digest(cut))).alias("tampered"))


def ranked(nodes: DataFrame, order: list, name: str) -> DataFrame:
    """``nodes`` with ``_pos`` (from 0) and ``_total`` within ``_key``, in ``order``. The sorted ranges are
    written once, so the positions stay the same when a task is run again."""
    fields = nodes.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column("_key"))
            index: list[int] = []
            for key, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if key != last:
                    last, seen = key, 0
                more = end - len(index)
                index += range(seen, seen + more)
                seen += more
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in fields), pa.array([part] * batch.num_rows, pa.int32()),
                                              pa.array(index, pa.int64())], names=[*fields, "_part", "_index"])

    by = [F.col("_key"), *order]
    dealt = materialize(nodes.repartitionByRange(*by).sortWithinPartitions(*by)
                        .mapInArrow(number, f"{kinds}, _part int, _index long"), name)
    run = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("_key", "_part").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_start", F.coalesce(F.sum("_n").over(run), F.lit(0)))
              .withColumn("_total", F.sum("_n").over(Window.partitionBy("_key"))).drop("_n"))
    return (dealt.join(starts, ["_key", "_part"])
            .select(*fields, (F.col("_start") + F.col("_index")).alias("_pos"), "_total"))


def reduce_levels(own: list[str], most: int | None) -> list[list[str]]:
    """The nodes of each level from ``own`` up: ``most`` levels above it, or (None) up to a single node."""
    out = [own]
    while len(out[-1]) > 1 if most is None else len(out) <= most:
        row = out[-1]
        out.append([digest("".join(row[i:i + FAN])) for i in range(0, len(row), FAN)])
    return out


def _levels(own: list[str], total: int, depth: int) -> list[list[str]]:
    """A superblock of a longer row climbs all ``depth`` levels, one that is alone only to its single node."""
    return reduce_levels(own, depth if total > FAN ** depth else None)


def siblings(levels: list[list[str]], at: int) -> tuple[list[str], list[str]]:
    """For each level below the top: the nodes left and right of the path in its run, joined."""
    left, right = [], []
    for row in levels[:-1]:
        first = at - at % FAN
        left.append("".join(row[first:at]))
        right.append("".join(row[at + 1:first + FAN]))
        at //= FAN
    return left, right


def climb(nodes: DataFrame, depth: int) -> DataFrame:
    """One node for each superblock of ``nodes`` (_key, _pos, _total, node), as nodes of the next round."""
    size = FAN ** depth

    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_pos")
        total = int(rows["_total"].iloc[0])
        top = _levels([x.hex() for x in rows["node"]], total, depth)[-1][0]
        return pd.DataFrame([(key[0], int(key[1]), -(-total // size), bytes.fromhex(top))], columns=["_key", "_pos", "_total", "node"])

    return (nodes.select("_key", F.expr(f"_pos div {size}").alias("_block"), "_pos", "_total", "node")
            .groupBy("_key", "_block").applyInPandas(reduce, "_key string, _pos long, _total long, node binary"))


def climbed(nodes: DataFrame, depth: int, name: str) -> list[DataFrame]:
    """All rounds: ``nodes`` and the written tables above it, the last with one node a key."""
    rounds = [nodes]
    longest = nodes.agg(F.max("_total")).first()[0] or 0
    while True:
        rounds.append(materialize(climb(rounds[-1], depth), f"{name}-{len(rounds)}"))
        longest = -(-longest // FAN ** depth)
        if longest <= 1:
            return rounds


OUTER = "_key string, _pos long, lefts array<string>, rights array<string>, subroot string, root string"


def descend(nodes: DataFrame, outer: DataFrame, depth: int) -> DataFrame:
    """The outer nodes of each member of ``nodes``, from those of its superblock."""
    size = FAN ** depth

    def extend(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, up = rows.sort_values("_pos"), above.iloc[0]
        levels = _levels([x.hex() for x in rows["node"]], int(rows["_total"].iloc[0]), depth)
        out = []
        for at, (key, pos) in enumerate(zip(rows["_key"], rows["_pos"])):
            left, right = siblings(levels, at)
            out.append((key, pos, [*left, *up["lefts"]], [*right, *up["rights"]], up["subroot"], up["root"]))
        return pd.DataFrame(out, columns=["_key", "_pos", "lefts", "rights", "subroot", "root"])

    own = nodes.select("_key", F.expr(f"_pos div {size}").alias("_block"), "_pos", "_total", "node")
    return (own.groupBy("_key", "_block").cogroup(outer.withColumnRenamed("_pos", "_block").groupBy("_key", "_block"))
            .applyInPandas(extend, OUTER))


def fold(leaf: str, lefts: list[str], rights: list[str]) -> str:
    for left, right in zip(lefts, rights):
        leaf = digest(left + leaf + right)
    return leaf


def dataset_manifest(docs: DataFrame, depth: int = 8) -> DataFrame:
    """One row per document: ``doc_id, source, position, leaf, subroot, root, proof_sha256, folded_root, verified``.

    Nulls in any column are hashed as ``-`` (a null id comes first in its source, a null source first among the sources);
    rows with equal ids are ordered by their leaf, and repeated rows are leaves of their own. Empty texts are
    hashed as empty values and long ones whole, by Spark. Other columns are ignored; an empty table gives an empty result.
    ``depth`` is the levels of a superblock (3 ** depth nodes in a task's group)."""
    spark = docs.sparkSession
    size = FAN ** depth
    found = materialize(leaves(docs), "manifest-leaves")
    rows = ranked(found, [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "manifest-ranked")
    inner = climbed(rows.withColumn("node", F.col("leaf")), depth, "manifest-source")
    subroots = inner[-1].select(F.lit("").alias("_key"), F.col("_key").alias("_source"), "node")
    tops = materialize(ranked(subroots, [F.col("_source")], "manifest-sources"), "manifest-subroots")
    upper = climbed(tops, depth, "manifest-root")
    got = upper[-1].first()
    if got is None:
        return spark.createDataFrame([], "doc_id long, source string, position long, leaf string, subroot string, root string, "
                                     "proof_sha256 string, folded_root string, verified boolean")
    outer = spark.createDataFrame([("", 0, [], [], None, bytes(got["node"]).hex())], OUTER)
    for level in reversed(upper[:-1]):
        outer = descend(level, outer, depth)
    above = (tops.join(outer, ["_key", "_pos"]).withColumn("subroot", F.lower(F.hex("node")))
             .select(F.col("_source").alias("_key"), F.lit(0).cast("long").alias("_pos"), "lefts", "rights", "subroot", "root"))
    for level in reversed(inner[1:-1]):
        above = descend(level, above, depth)

    def finish(own: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        own, up = own.sort_values("_pos"), given.iloc[0]
        leaf = [x.hex() for x in own["leaf"]]
        levels = _levels(leaf, int(own["_total"].iloc[0]), depth)
        proofs, folded = [], []
        for at, (mine, other) in enumerate(zip(leaf, own["tampered"])):
            left, right = siblings(levels, at)
            left, right = [*left, *up["lefts"]], [*right, *up["rights"]]
            proofs.append(digest("".join(a + b for a, b in zip(left, right))))
            folded.append(fold(mine if other is None else other.hex(), left, right))
        return pd.DataFrame({"doc_id": own["doc_id"].astype("Int64"), "source": [k[1:] if k else None for k in own["_key"]],
                             "position": own["_pos"], "leaf": leaf, "subroot": up["subroot"], "root": up["root"],
                             "proof_sha256": proofs, "folded_root": folded, "verified": [x == up["root"] for x in folded]})

    own = rows.withColumn("_block", F.expr(f"_pos div {size}"))
    return (own.groupBy("_key", "_block").cogroup(above.withColumnRenamed("_pos", "_block").groupBy("_key", "_block"))
            .applyInPandas(finish, "doc_id long, source string, position long, leaf string, subroot string, root string, "
                                   "proof_sha256 string, folded_root string, verified boolean"))


def manifest_sql(levels: int = 12, source_levels: int = 8) -> str:
    """DuckDB text for the same result, with so many levels written out (up to 3 ** levels rows a source)."""
    def field(x: str) -> str:
        return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"

    ctes = [f"""d AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {sqltext.crc32('CAST(doc_id AS VARCHAR)')} % 2 = 0
  THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS fold0 FROM documents)""",
            "k AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM (SELECT DISTINCT source FROM d))",
            """a0 AS (SELECT s, leaf AS node, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, doc_id, leaf, fold0
  FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source)""",
            "n0 AS (SELECT s, i, node, count(*) OVER (PARTITION BY s) AS t FROM a0)",
            "p0 AS (SELECT s, i AS place, doc_id, leaf, fold0 AS f, '' AS proof FROM a0)"]

    def step(k: int) -> list[str]:
        """Level k to k + 1: the nodes, and for each leaf the proof and the folded node."""
        run = f"""(SELECT x.s, x.i, coalesce(string_agg(y.node, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS l,
  coalesce(string_agg(y.node, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS r, any_value(x.t) AS t
  FROM n{k} x JOIN n{k} y ON x.s = y.s AND x.i // {FAN} = y.i // {FAN} GROUP BY x.s, x.i)"""
        return [f"""n{k + 1} AS (SELECT s, i // {FAN} AS i, CASE WHEN any_value(t) > 1 THEN sha256(string_agg(node, '' ORDER BY i)) ELSE any_value(node) END AS node,
  any_value((t + {FAN - 1}) // {FAN}) AS t FROM n{k} GROUP BY s, i // {FAN})""",
                f"""p{k + 1} AS (SELECT p.s, place // {FAN} AS place, doc_id, leaf, CASE WHEN u.t > 1 THEN sha256(u.l || f || u.r) ELSE f END AS f,
  proof || u.l || u.r AS proof FROM p{k} p JOIN {run} u ON u.s = p.s AND u.i = p.place)"""]

    for k in range(levels):
        ctes += step(k)
    top = levels + 1
    ctes += [f"n{top} AS (SELECT 0 AS s, s AS i, node, count(*) OVER () AS t FROM n{levels})",
             f"p{top} AS (SELECT 0 AS s, p.s AS place, doc_id, leaf, f, proof, n.node AS subroot FROM p{levels} p JOIN n{levels} n USING (s))"]
    for k in range(top, top + source_levels):
        ctes += [x.replace("doc_id, leaf, CASE", "doc_id, leaf, subroot, CASE") for x in step(k)]
    last = top + source_levels
    own = "ranked AS (SELECT doc_id, leaf, source, i AS position FROM a0 JOIN k USING (s))"
    body = f"""SELECT p.doc_id, r.source, r.position, p.leaf, subroot, node AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = node AS verified
FROM p{last} p JOIN n{last} n ON true JOIN ranked r ON r.doc_id IS NOT DISTINCT FROM p.doc_id AND r.leaf = p.leaf"""
    return "WITH " + ",\n".join(x.replace(" AS (", " AS MATERIALIZED (", 1) for x in [*ctes, own]) + "\n" + body
