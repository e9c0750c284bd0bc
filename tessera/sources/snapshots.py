"""Three versions of a table (``ref``, ``previous``, ``new``) by a pointer file.

Versions are folders that never change. Which folder plays which part is told by numbered manifests, small JSON files that are written
aside and renamed, so a manifest is there whole or not at all; the one with the largest number counts. Rotation
writes a manifest and moves no data: ``previous`` becomes ``ref``, ``new`` becomes ``previous``. A crash at any step
leaves the manifest before it, with three readable versions. All goes through the Hadoop file system.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

PARTS = ("ref", "previous", "new")
MANIFEST = "manifest-"


class Snapshots:
    def __init__(self, spark: SparkSession, base: str, fmt: str = "parquet"):
        self.spark, self.base, self.fmt = spark, base.rstrip("/"), fmt
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.base}/{name}")

    def _numbers(self) -> list[int]:
        if not self._fs.exists(self._path("")):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(self._path("")))
        return sorted(int(n[len(MANIFEST):]) for n in names if n.startswith(MANIFEST) and n[len(MANIFEST):].isdigit())

    def _read(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{MANIFEST}{number}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def current(self) -> dict[str, str]:
        """Folder of each part that has one."""
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else {}

    def _switch(self, change: Callable[[dict], dict]) -> dict[str, str]:
        """Writes the next manifest. Two writers at a time: the rename of the second fails, and it reads anew."""
        for _ in range(100):
            numbers = self._numbers()
            parts = change(self._read(numbers[-1]) if numbers else {})
            aside = self._path(f".aside-{uuid.uuid4().hex}")
            out = self._fs.create(aside)
            try:
                out.write(json.dumps(parts, sort_keys=True).encode())
            finally:
                out.close()
            number = (numbers[-1] if numbers else 0) + 1
            goal = self._path(f"{MANIFEST}{number}")
            if not self._fs.exists(goal) and self._fs.rename(aside, goal):
                return parts
            self._fs.delete(aside, False)
        raise RuntimeError("the manifest was changed by others a hundred times in a row")

    def put(self, df: DataFrame, part: str = "new") -> None:
        """Writes ``df`` as a folder of its own, then points ``part`` to it."""
        if part not in PARTS:
            raise ValueError(f"unknown part {part!r} (known: {', '.join(PARTS)})")
        folder = f"data-{uuid.uuid4().hex}"
        df.write.format(self.fmt).save(f"{self.base}/{folder}")
        self._switch(lambda parts: parts | {part: folder})

    def rotate(self) -> dict[str, str]:
        """previous -> ref, new -> previous; ``new`` stays where it is until the next ``put``. A part that is missing is not moved."""
        return self._switch(lambda p: p | {dst: p[src] for src, dst in (("previous", "ref"), ("new", "previous")) if src in p})

    def read(self, part: str) -> DataFrame:
        parts = self.current()
        if part not in parts:
            raise ValueError(f"no version {part!r} below {self.base}")
        return self.spark.read.format(self.fmt).load(f"{self.base}/{parts[part]}")

    def vacuum(self) -> list[str]:
        """Deletes the folders and manifests that the newest manifest does not need; returns the folders. For times without readers and writers."""
        numbers, keep = self._numbers(), set(self.current().values())
        gone = []
        for s in self._fs.listStatus(self._path("")) if numbers else []:
            name = s.getPath().getName()
            if name.startswith("data-") and name not in keep:
                self._fs.delete(s.getPath(), True)
                gone.append(name)
        for n in numbers[:-1]:
            self._fs.delete(self._path(f"{MANIFEST}{n}"), False)
        return gone
