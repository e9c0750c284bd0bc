"""Incremental ingest: late rows ignored, last row per date wins, replays add nothing."""

import datetime as dt
import uuid

from tessera.session import table_path
from tessera.streaming import ingest as ST


def test_merge_batch_rules(spark):
    target = table_path(spark, f"t-{uuid.uuid4().hex[:8]}")
    d = lambda i: dt.date(2024, 1, i)
    hist = spark.createDataFrame([(d(1), 1.0), (d(2), 2.0)], "date date, price double")
    ST.write_history(hist, target)
    batch = spark.createDataFrame([(d(2), 99.0), (d(3), 3.0), (d(3), 3.5), (d(31), 31.0)], "date date, price double")
    ST.merge_batch(spark, batch, target, as_of="2024-01-10")
    ST.merge_batch(spark, batch, target, as_of="2024-01-10")  # replay
    got = {r["date"]: r["price"] for r in spark.read.parquet(target).collect()}
    assert got[d(2)] == 2.0                  # late row (<= mark) ignored
    assert got[d(3)] in (3.0, 3.5) and len([k for k in got if k == d(3)]) == 1
    assert d(31) not in got                  # after as_of - 1 day: waits
    assert spark.read.parquet(target).count() == 3
