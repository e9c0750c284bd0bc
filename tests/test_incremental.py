"""Sources of new rows, keyed streams and snapshot rotation."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators.pages import extract_price_table
from tessera.session import table_path
from tessera.sources import captured as CP
from tessera.sources.snapshots import Snapshots
from tessera.streaming import keyed as KY


def day(i):
    return dt.date(2024, 1, i)


def fresh(spark, name):
    return table_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


def pages(spark, rows):
    return spark.createDataFrame([(d, i, f"u{i}", h) for i, (d, h) in enumerate(rows)], "captured date, page_id long, url string, html string")


def test_captured_reads_back_and_prunes_days(spark):
    path = fresh(spark, "cap")
    CP.land(pages(spark, [(day(i), f"p{i}") for i in range(1, 9)]), path)
    CP.register(spark)
    df = spark.read.format("captured").load(path)
    assert {(r["captured"], r["html"]) for r in df.collect()} == {(day(i), f"p{i}") for i in range(1, 9)}
    few = df.filter((F.col("captured") > "2024-01-05") & (F.col("captured") <= "2024-01-07") & (F.col("url") != "x"))
    assert sorted(r["html"] for r in few.collect()) == ["p6", "p7"]
    assert few.rdd.getNumPartitions() == 2 < df.rdd.getNumPartitions()  # the other days are no tasks
    assert spark.read.format("captured").option("as_of", "2024-01-03").load(path).count() == 2
    wider = spark.read.format("captured").schema("html string, captured date, more double").load(path)
    assert wider.columns == ["html", "captured", "more"] and wider.filter("more is null").count() == 8
    assert spark.read.format("captured").load(fresh(spark, "none")).count() == 0


def test_any_source_feeds_the_upsert(spark):
    def html(rows):
        return "<table><tr><th>Date<th>Close" + "".join(f"<tr><td>Jan {d}, 2024<td>{c}" for d, c in rows) + "</table>"

    path, table = fresh(spark, "cap"), fresh(spark, "tab")
    CP.land(pages(spark, [(day(2), html([(1, 1), (2, 2)])), (day(4), html([(3, "3.005"), (4, 4)])), (day(5), html([(4, "4.5"), (5, 5)]))]), path)
    old = spark.createDataFrame([(day(1), 1.0), (day(2), 2.5)], "date date, close double")
    spark.createDataFrame([(day(2), 9.0), (day(3), 7.0)], "date date, close double").write.parquet(table)
    read = lambda s: {r["date"].day: r["close"] for r in CP.update(old, s, main="close").collect()}

    def extract(p):
        return extract_price_table(p).select("date", "close")

    got = read(CP.CapturedDays(path, extract))
    assert (got[1], got[2], got[5]) == (1.0, 2.5, 5.0) and got[4] in (4.0, 4.5)
    assert sorted(read(CP.CapturedDays(path, extract, as_of=day(5)))) == [1, 2, 3, 4]
    assert read(CP.TableRows(table)) == {1: 1.0, 2: 2.5, 3: 7.0}


def test_stream_by_key(spark):
    """Two rows of a day in two batches, late rows, a day that has to wait, keys of their own, a replay."""
    src, target, chk = (fresh(spark, n) for n in ("src", "target", "chk"))
    kind = "captured date, k string, date date, price double, pos long"
    CP.register(spark)

    def arrive(captured, rows):
        CP.land(spark.createDataFrame([(captured, *r) for r in rows], kind), src)

    def go():
        stream = spark.readStream.format("captured").schema(kind).load(src)
        out = KY.ingest_days(stream, target, chk, ["k"], "date", "price", "pos", day(20))
        return {(r["k"], r["date"].day): (r["price"], r["prev_price"]) for r in out.collect()}

    KY.write_history(spark.createDataFrame([("a", day(1), 1.0), ("a", day(2), 2.0), (None, day(9), 9.0)], "k string, date date, price double"),
                     target, ["k"], "date", "price")
    arrive(day(10), [("a", day(2), 99.0, 1), ("a", day(3), 3.0, 1), ("a", day(3), 3.5, 2), ("b", day(1), 10.0, 1), (None, day(8), 1.0, 1)])
    first = go()
    assert first == {("a", 1): (1.0, None), ("a", 2): (2.0, None), ("a", 3): (3.5, 2.0), ("b", 1): (10.0, None), (None, 9): (9.0, None)}
    arrive(day(11), [("a", day(3), 77.0, 9), ("a", day(5), 5.0, 1), ("a", day(20), 20.0, 1), ("b", day(2), None, 1), (None, day(10), 10.0, 1)])
    second = go()
    assert second == first | {("a", 5): (5.0, 3.5), ("b", 2): (None, 10.0), (None, 10): (10.0, 9.0)}
    assert go() == second  # nothing new
    # an epoch that is written again is there once
    last = max(int(p.split("=")[1]) for p in (r[0].rsplit("/", 2)[1] for r in spark.read.parquet(target).select(F.input_file_name()).distinct().collect()))
    again = spark.read.parquet(f"{target}/epoch={last}").checkpoint()
    KY._write_epoch(again, target, last)
    assert KY.read_target(spark, target, again.schema).count() == len(second)
    # a day captured late for an older folder than the newest one taken is not read
    arrive(day(9), [("b", day(3), 3.0, 1)])
    assert go() == second


def test_daily_scores_keep_the_newest(spark):
    src, target, chk = (fresh(spark, n) for n in ("src", "target", "chk"))
    kind = "captured date, ts timestamp, score double"
    CP.register(spark)

    def go():
        got = KY.daily_scores(spark.readStream.format("captured").schema(kind).load(src), target, chk, watermark="3 days")
        return {r["date"].day: (r["mean_score"], r["n"]) for r in got.collect()}

    def arrive(captured, rows):
        CP.land(spark.createDataFrame([(captured, dt.datetime(2024, 1, d, 12), s) for d, s in rows], kind), src)

    arrive(day(10), [(1, 1.0), (1, 3.0), (2, 5.0)])
    assert go() == {1: (2.0, 2), 2: (5.0, 1)}
    arrive(day(11), [(2, 7.0), (2, None), (3, 1.0)])
    assert go() == {1: (2.0, 2), 2: (6.0, 2), 3: (1.0, 1)}


def test_rotation_by_manifest(spark):
    base = fresh(spark, "snap")
    s = Snapshots(spark, base)
    value = lambda p: Snapshots(spark, base).read(p).first()[0]
    for i, part in enumerate(("ref", "previous", "new"), 1):
        s.put(spark.range(i, i + 1), part)
    folders = s.current()
    s.rotate()
    assert [value(p) for p in ("ref", "previous", "new")] == [2, 3, 3]
    assert s.current()["previous"] == folders["new"]  # nothing was copied
    s.put(spark.range(4, 5))
    assert [value(p) for p in ("ref", "previous", "new")] == [2, 3, 4]
    with pytest.raises(ValueError, match="unknown part"):
        s.put(spark.range(1), "other")
    with pytest.raises(ValueError, match="no version"):
        Snapshots(spark, fresh(spark, "empty")).read("new")
    assert s.vacuum() == [folders["ref"]] and [value(p) for p in ("ref", "previous", "new")] == [2, 3, 4]


@pytest.mark.parametrize("crash", ["write", "rename"])
def test_a_crash_leaves_three_versions(spark, monkeypatch, crash):
    base = fresh(spark, "snap")
    s = Snapshots(spark, base)
    for i, part in enumerate(("ref", "previous", "new"), 1):
        s.put(spark.range(i, i + 1), part)
    before = s.current()

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == {"write": "create", "rename": "rename"}[crash]:
                def fail(*_):
                    raise OSError("lost")
                return fail
            return getattr(self.fs, name)

    monkeypatch.setattr(s, "_fs", Broken(s._fs))
    with pytest.raises(OSError):
        s.rotate()
    with pytest.raises(OSError):
        s.put(spark.range(9, 10))
    again = Snapshots(spark, base)
    assert again.current() == before
    assert [again.read(p).first()[0] for p in ("ref", "previous", "new")] == [1, 2, 3]
    assert again.rotate()["ref"] == before["previous"]
