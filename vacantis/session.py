"""Session, table loading and stage materialisation shared by every plan."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: str | None = None


def build_session(app: str = "vacantis", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the engine expects; on a cluster the session comes from spark-submit."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def load(spark: SparkSession, root: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{root}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir where it is set, else one of our own (local runs and tests)."""
    global _OWN_DIR
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if _OWN_DIR is None:
        _OWN_DIR = tempfile.mkdtemp(prefix="vacantis-")
    return f"file://{_OWN_DIR}"


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass


def materialize(df: DataFrame, label: str, partitions: int | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and read it back.

    Cuts the lineage with a copy that outlives any executor, gives the optimiser true sizes, and costs one
    compressed write. The files go at exit; ``drop_materialized`` removes them as soon as a later stage replaced them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/vacantis/{label}-{uuid.uuid4().hex}"
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    atexit.register(_delete, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._vacantis_path = path
    return out


def drop_materialized(df: DataFrame) -> None:
    path = getattr(df, "_vacantis_path", None)
    if path:
        _delete(df.sparkSession, path)


def collect_bounded(df: DataFrame, limit: int) -> list | None:
    """The rows of ``df`` if there are at most ``limit``, else None: the caller then keeps the data distributed."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a cluster (a no-op where it is installed)."""
    if getattr(spark.sparkContext, "_vacantis_shipped", False):
        return
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    where = tempfile.mkdtemp(prefix="vacantis-zip-")
    archive = shutil.make_archive(f"{where}/vacantis", "zip", root, "vacantis")
    spark.sparkContext.addPyFile(archive)
    spark.sparkContext._vacantis_shipped = True
