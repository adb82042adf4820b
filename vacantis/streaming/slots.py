"""Counts per slot of time over a stream, with late rows admitted up to the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def slot_counts(stream: DataFrame, ts: str, keys: list[str], slot: str = "3 hours", late: str = "1 hour") -> DataFrame:
    """(begins, keys, n) for each closed slot. Works on a batch as well, where every slot counts as closed."""
    windowed = stream.withWatermark(ts, late).groupBy(F.window(ts, slot), *keys).agg(F.count("*").alias("n"))
    return windowed.select(F.col("window.start").alias("begins"), *keys, "n")


def first_and_last_seen(stream: DataFrame, key: str, ts: str) -> DataFrame:
    """(key, first_seen, last_seen, n), for output mode 'update' or 'complete'."""
    return stream.groupBy(key).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count("*").alias("n"))


def deduplicated(stream: DataFrame, keys: list[str], ts: str, within: str = "7 days") -> DataFrame:
    """The first row of each key; state older than the watermark is dropped."""
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark(keys)
