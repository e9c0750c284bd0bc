"""Sources of new rows: one contract for batch and stream, and a Python data source over captured days.

A capture is a table in folders ``captured=<day>/*.parquet`` below a folder that driver and executors share (a local
mount, or an address that Arrow's file systems open). ``spark.read.format("captured")`` reads it with the day filter
pushed: folders outside are neither listed into tasks nor opened. ``spark.readStream.format("captured")`` takes days as
they appear, each once; its offset is the newest day taken, so what comes later for an older day is late and not read.
A day is visible before ``as_of`` only (option; default: all days).

A source strategy is anything with ``rows(spark, after)``: the rows of days behind ``after`` as a DataFrame. Swap one for another and
hand its rows to ``panel.incremental_upsert``.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual)
from pyspark.sql.types import StructType

DAY = "captured"
DEFAULT_SCHEMA = "captured date, page_id bigint, url string, html string"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"^file:/", path):
        path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _day(text: str) -> dt.date | None:
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        return None


class CapturedFile(InputPartition):
    def __init__(self, path: str, day: str):
        self.path, self.day = path, day


class _Days:
    """Lists and reads the day folders; shared by the batch and the stream reader."""

    def __init__(self, schema: StructType, options: dict):
        self.names = schema.names
        self.kinds = {f.name: f.dataType for f in schema.fields}
        if "path" not in options:
            raise ValueError("the captured source needs a path")
        self.path = options["path"]
        self.as_of = dt.date.fromisoformat(options["as_of"]) if "as_of" in options else None

    def days(self) -> list[dt.date]:
        store, path = _open(self.path)
        found = (f.base_name for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.type == fs.FileType.Directory)
        days = sorted(d for x in found if x.startswith(f"{DAY}=") and (d := _day(x[len(DAY) + 1:])))
        return [d for d in days if self.as_of is None or d < self.as_of]

    def files(self, days: list[dt.date]) -> list[CapturedFile]:
        store, path = _open(self.path)
        out = []
        for d in days:
            infos = store.get_file_info(fs.FileSelector(f"{path}/{DAY}={d}", recursive=True))
            out += [CapturedFile(f.path, str(d)) for f in sorted(infos, key=lambda f: f.path) if f.path.endswith(".parquet")]
        return out

    def read(self, partition: CapturedFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark reads where there is no file
            return
        from pyspark.sql.pandas.types import to_arrow_type
        store, _ = _open(self.path)
        kinds = pa.schema([(n, to_arrow_type(self.kinds[n])) for n in self.names])
        day = dt.date.fromisoformat(partition.day)
        with store.open_input_file(partition.path) as raw:
            file = pq.ParquetFile(raw)
            have = [n for n in self.names if n in file.schema_arrow.names and n != DAY]
            for batch in file.iter_batches(columns=have, batch_size=1024, use_threads=False):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([day] * batch.num_rows, pa.date32()) if n == DAY else
                     pc.cast(batch.column(n), kinds.field(n).type) if n in have else pa.nulls(batch.num_rows, kinds.field(n).type)
                     for n in self.names], schema=kinds)


class CapturedReader(_Days, DataSourceReader):
    """Batch reader: filters on the day alone are taken over."""

    def __init__(self, schema: StructType, options: dict):
        super().__init__(schema, options)
        self.tests: list[Callable[[dt.date], bool]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        signs = {EqualTo: lambda v: lambda d: d == v, GreaterThan: lambda v: lambda d: d > v, GreaterThanOrEqual: lambda v: lambda d: d >= v,
                 LessThan: lambda v: lambda d: d < v, LessThanOrEqual: lambda v: lambda d: d <= v, In: lambda v: lambda d: d in v}
        for f in filters:
            if type(f) in signs and getattr(f, "attribute", None) == (DAY,):
                self.tests.append(signs[type(f)](f.value))
            else:
                yield f

    def partitions(self) -> list[CapturedFile]:
        return self.files([d for d in self.days() if all(t(d) for t in self.tests)])


class CapturedStream(_Days, DataSourceStreamReader):
    """Stream reader: the offset is the newest day taken."""

    def initialOffset(self) -> dict:
        return {"day": ""}

    def latestOffset(self) -> dict:
        days = self.days()
        return {"day": str(days[-1]) if days else ""}

    def partitions(self, start: dict, end: dict) -> list[CapturedFile]:
        return self.files([d for d in self.days() if start["day"] < str(d) <= end["day"]])


class CapturedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "captured"

    def schema(self) -> str:
        return DEFAULT_SCHEMA

    def reader(self, schema: StructType) -> CapturedReader:
        return CapturedReader(schema, dict(self.options))

    def streamReader(self, schema: StructType) -> CapturedStream:
        return CapturedStream(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    """Makes the format ``captured`` known to the session, with filters pushed."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CapturedSource)


def land(rows: DataFrame, path: str, mode: str = "append") -> str:
    """Writes ``rows`` (with a date column ``captured``) as day folders."""
    rows.write.mode(mode).partitionBy(DAY).parquet(path)
    return path


# -------------------------------------------------------------------- strategies

class Source(Protocol):
    """New rows behind a day, whatever they come from."""

    def rows(self, spark: SparkSession, after: dt.date | None) -> DataFrame: ...


def _behind(df: DataFrame, column: str, after: dt.date | None) -> DataFrame:
    return df if after is None else df.filter(F.col(column) > F.lit(after))


@dataclass(frozen=True)
class CapturedDays:
    """The days of a capture, each page turned into rows by ``extract``."""

    path: str
    extract: Callable[[DataFrame], DataFrame]
    schema: str = DEFAULT_SCHEMA
    as_of: dt.date | None = None

    def rows(self, spark: SparkSession, after: dt.date | None) -> DataFrame:
        register(spark)
        reader = spark.read.format("captured").schema(self.schema).option("path", self.path)
        if self.as_of is not None:
            reader = reader.option("as_of", str(self.as_of))
        return self.extract(_behind(reader.load(), DAY, after))


@dataclass(frozen=True)
class TableRows:
    """The rows of a stored table by their own date."""

    path: str
    date: str = "date"
    format: str = "parquet"

    def rows(self, spark: SparkSession, after: dt.date | None) -> DataFrame:
        return _behind(spark.read.format(self.format).load(self.path), self.date, after)


def update(existing: DataFrame, source: Source, date: str = "date", main: str = "nsei", digits: int = 2) -> DataFrame:
    """SET-03 from any source: rows behind the newest stored date are fetched and merged."""
    from ..operators.panel import high_water_mark, incremental_upsert
    mark = high_water_mark(existing, date).first()[0]
    stamped = [d.withColumns({"__batch": F.lit(b), "__pos_in": F.unix_date(F.to_date(date)).cast("long")})
               for b, d in enumerate((existing, source.rows(existing.sparkSession, mark)))]
    out = incremental_upsert(*stamped, date=date, main=main, digits=digits)
    return out.drop("__batch", "__pos_in")
