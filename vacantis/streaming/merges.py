"""Exactly-once merges of a stream into a stored table: each batch writes a new version, named by the batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.keyed import upsert


class MergeSink:
    """A table of parquet versions under one folder; the highest version is the table.

    A batch that is run again after a failure finds its own version and overwrites it from the version before, so it
    is merged once.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, keep: list[str], seq: str) -> None:
        self.spark, self.path, self.key, self.keep, self.seq = spark, path.rstrip("/"), key, keep, seq

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        root, fs = self._fs()
        if not fs.exists(root):
            return []
        names = [s.getPath() for s in fs.listStatus(root)]
        jvm = self.spark.sparkContext._jvm
        done = [p.getName() for p in names if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(n[1:]) for n in done if n[0] == "v" and n[1:].isdigit())

    def read(self, before: int | None = None) -> DataFrame | None:
        known = [v for v in self.versions() if before is None or v < before]
        return self.spark.read.parquet(f"{self.path}/v{known[-1]}") if known else None

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        stored = self.read(before=batch_id)
        if stored is None:
            stored = batch.drop(self.seq).limit(0)
        upsert(stored, batch, self.key, self.keep, self.seq).drop("action").write.mode("overwrite").parquet(f"{self.path}/v{batch_id}")

    def writer(self) -> Callable[[DataFrame, int], None]:
        return self.merge
