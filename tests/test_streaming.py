import datetime as dt

from pyspark.sql import functions as F

from vacantis.streaming import health, merges, slots


def run(frame, mode, name):
    q = frame.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.processAllAvailable()
    q.stop()


def test_slots(spark, root, tmp_path):
    spark.read.parquet(f"{root}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "e"))
    batch = spark.read.parquet(str(tmp_path / "e"))
    run(slots.slot_counts(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "e")), "ts", ["event_type"]), "append", "slot_counts")
    want = {(r["begins"], r["event_type"], r["n"]) for r in slots.slot_counts(batch, "ts", ["event_type"]).collect()}
    got = {(r["begins"], r["event_type"], r["n"]) for r in spark.table("slot_counts").collect()}
    last = max(b for b, _, _ in want)
    assert got <= want and {w for w in want if w[0] < last - dt.timedelta(hours=3)} <= got


def test_health(spark, tmp_path):
    rows = [("a", 1, False), ("a", 2, False), ("b", 1, True), ("c", 3, False), ("c", 1, True)] + [("d", i, False) for i in range(8)]
    df = spark.createDataFrame(rows, "source string, n int, ok boolean").select("source", F.timestamp_seconds("n").alias("ts"), "ok")
    df.coalesce(1).write.parquet(str(tmp_path / "c"))
    run(health.source_health(spark.readStream.schema(df.schema).parquet(str(tmp_path / "c"))), "update", "health")
    got = {r["source"]: (r["open_failures"], r["status"]) for r in spark.table("health").collect()}
    assert got == {"a": (2, "Warning"), "b": (0, "Active"), "c": (1, "Warning"), "d": (8, "Inactive")}


def test_merge_runs_a_batch_twice(spark, tmp_path):
    sink = merges.MergeSink(spark, str(tmp_path / "t"), "id", ["seen"], "seq")
    one = spark.createDataFrame([("a", "1", "x", 1)], "id string, seen string, v string, seq int")
    two = spark.createDataFrame([("a", "2", "y", 1), ("b", "2", "z", 1)], "id string, seen string, v string, seq int")
    sink.merge(one, 0)
    sink.merge(two, 1)
    sink.merge(two, 1)
    assert {tuple(r[c] for c in ("id", "seen", "v")) for r in sink.read().collect()} == {("a", "1", "y"), ("b", "2", "z")}
    assert sink.versions() == [0, 1]
