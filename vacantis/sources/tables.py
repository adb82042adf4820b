"""Stored tables under a folder: read what is there, overwrite, append, widen, drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class TableStore:
    """Parquet tables by name. Stored columns beyond the declared ones stay; declared ones that are missing are added."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def exists(self, name: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def read(self, name: str, schema: StructType) -> DataFrame:
        """The table with at least the declared columns; an empty one where there is none."""
        if not self.exists(name):
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.option("mergeSchema", "true").parquet(self.path(name))
        return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns})

    def overwrite(self, name: str, df: DataFrame, columns: list[str] | None = None) -> None:
        """Exactly the given columns, in their order. The table may be read by ``df``: the new one is complete before it takes its place."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        final, fresh, gone = (jvm.org.apache.hadoop.fs.Path(self.path(name) + s) for s in ("", ".new", ".old"))
        (df.select(*columns) if columns else df).write.mode("overwrite").parquet(self.path(name) + ".new")
        fs = final.getFileSystem(conf)
        fs.delete(gone, True)
        if fs.exists(final):
            fs.rename(final, gone)
        fs.rename(fresh, final)
        fs.delete(gone, True)

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(name))

    def drop(self, names: list[str], keep: tuple[str, ...] = ()) -> list[str]:
        """Drop the named tables, but never those to keep; returns what was there."""
        dropped = [n for n in names if n not in keep and self.exists(n)]
        for n in dropped:
            p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(n))
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        return dropped
