"""Versioned tables in a folder: a version is written whole, then a numbered pointer file is added; readers follow the greatest.

A pointer is written under another name and renamed, and no pointer is ever removed or changed, so a crash at any time leaves
the store as it was before or after the commit. One writer at a time: a rename onto an existing number fails."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _pointers(self) -> list[int]:
        if not self._fs.exists(self._path(self.base)):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.base))]
        return sorted(int(n.removeprefix("CURRENT-").removesuffix(".json")) for n in names if n.startswith("CURRENT-") and n.endswith(".json"))

    def _pointer(self) -> dict[str, int]:
        found = self._pointers()
        if not found:
            return {}
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.base}/CURRENT-{found[-1]:09d}.json").collect()))

    def exists(self, table: str) -> bool:
        return table in self._pointer()

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{table}/v{self._pointer()[table]}")

    def commit(self, tables: dict[str, DataFrame], partition: dict[str, str] | None = None) -> dict[str, int]:
        """Write new versions of all the tables, then switch to them together."""
        now = self._pointer()
        new = {t: now.get(t, 0) + 1 for t in tables}
        for t, df in tables.items():
            w = df.write.mode("overwrite")
            if partition and t in partition:
                w = w.partitionBy(partition[t])
            w.parquet(f"{self.base}/{t}/v{new[t]}")
        n = (self._pointers() or [0])[-1] + 1
        temp, final = self._path(f"{self.base}/NEXT.json"), self._path(f"{self.base}/CURRENT-{n:09d}.json")
        out = self._fs.create(temp, True)
        out.write(bytearray(json.dumps(now | new).encode()))
        out.close()
        if not self._fs.rename(temp, final):
            raise RuntimeError(f"another writer has committed {final}")
        return new
