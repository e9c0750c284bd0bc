"""Sources and sinks: CSV with a written index, list text, key/value upsert."""

import uuid

from pyspark.sql import functions as F

from tessera.session import table_path
from tessera.sources import files as IO


def test_csv_roundtrip_drops_index_and_nan(spark):
    path = table_path(spark, f"csv-{uuid.uuid4().hex[:8]}")
    df = spark.createDataFrame([(0, "2025-06-13", 1.5), (1, "2025-06-14", float("nan"))], "i long, date string, v double")
    IO.sink_csv(df, path, index="i")
    back = IO.scan_csv(spark, path, "i long, date string, v double")
    rows = sorted(back.collect(), key=lambda r: r["date"])
    assert back.columns == ["date", "v"]
    assert rows[0]["v"] == 1.5 and rows[1]["v"] is None


def test_list_text_and_kv_upsert(spark):
    df = spark.createDataFrame([("['it is', \"don't\"]",)], "s string")
    assert IO.decode_list_columns(df, {"s": "string"}).first()["s"] == ["it is", "don't"]
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "name string, value double")
    new = spark.createDataFrame([("b", 3.0), ("c", 4.0)], "name string, value double")
    got = {r["name"]: r["value"] for r in IO.kv_upsert(old, new).collect()}
    assert got == {"a": 1.0, "b": 3.0, "c": 4.0}
    enc = IO.encode_list_columns(spark.createDataFrame([(["x", "y"],)], "a array<string>"))
    assert enc.select(F.col("a")).first()[0] == '["x","y"]'
