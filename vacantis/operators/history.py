"""Operators over what happened in time: due batches, streaks, and rotating slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def due_batch(sources: DataFrame, checked: str, weight: str, tie: str, most: int, ceiling: int = 500) -> DataFrame:
    """The rows that wait longest for a check: never checked first, then the heavier, then by ``tie``; a bounded top.

    A batch has one row at least and ``ceiling`` at most, whatever is asked for, as its pages are fetched in one run.
    """
    return sources.orderBy(F.coalesce(F.col(checked), F.timestamp_seconds(F.lit(0)).cast(dict(sources.dtypes)[checked])), F.desc(weight), tie).limit(max(1, min(most, ceiling)))


def streaks(events: DataFrame, key: str, ts: str, seq: str, failed: Column) -> DataFrame:
    """(key, checks, failures, open_failures, last_success, last_check): a key's history in aggregates only.

    The failures since the last success are counted by comparing with its time, not by walking the rows.
    """
    marked = events.select(F.col(key).alias("key"), F.struct(ts, seq).alias("at"), failed.alias("failed"))
    last = marked.groupBy("key").agg(F.max(F.when(~F.col("failed"), F.col("at"))).alias("success"), F.count("*").alias("checks"), F.sum(F.col("failed").cast("int")).alias("failures"), F.max("at").alias("last"))
    since = marked.where("failed").join(last.select("key", "success"), "key").where("success is null or at > success").groupBy("key").agg(F.count("*").alias("open_failures"))
    out = last.join(since, "key", "left")
    return out.select(F.col("key").alias(key), "checks", "failures", F.coalesce("open_failures", F.lit(0)).alias("open_failures"), F.col(f"success.{ts}").alias("last_success"), F.col(f"last.{ts}").alias("last_check"))


def islands(events: DataFrame, key: str, ts: str, seq: str, state: Column) -> DataFrame:
    """(key, island, state, begins, ends, n): runs of rows of one state, in order of time.

    Rows are compared within their day and the days of a key with each other, so a key of any number of rows is spread
    over its days.
    """
    marked = events.withColumn("__state", state).withColumn("__day", F.to_date(ts))
    own = Window.partitionBy(key, "__day").orderBy(ts, seq)
    first = F.row_number().over(own) == 1
    changed = marked.withColumn("__new", F.when(first | F.lag("__state").over(own).eqNullSafe(F.col("__state")), 0).otherwise(1))
    at = F.struct(ts, seq)
    days = changed.groupBy(key, "__day").agg(F.sum("__new").alias("changes"), F.min_by("__state", at).alias("first"), F.max_by("__state", at).alias("last"))
    turn = Window.partitionBy(key).orderBy("__day")
    goes_on = (F.row_number().over(turn) > 1) & F.lag("last").over(turn).eqNullSafe(F.col("first"))
    days = days.withColumn("starts", F.when(goes_on, 0).otherwise(1))
    before = F.coalesce(F.sum(F.col("starts") + F.col("changes")).over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = days.select(F.col(key).alias("__key"), F.col("__day").alias("__of"), (before + F.col("starts")).alias("__base"))
    numbered = changed.withColumn("__local", F.sum("__new").over(own)).join(base, F.col(key).eqNullSafe(F.col("__key")) & F.col("__day").eqNullSafe(F.col("__of")))
    return numbered.groupBy(key, (F.col("__base") + F.col("__local")).alias("island")).agg(F.first("__state").alias("state"), F.min(ts).alias("begins"), F.max(ts).alias("ends"), F.count("*").alias("n"))


def slot(ts: Column, hours: int) -> Column:
    """The number of the slot of so many hours, counted from 1970."""
    return F.floor(F.unix_timestamp(ts) / (hours * 3600))


def rotation(items: DataFrame, place: str, turn: int, size: int) -> DataFrame:
    """The items whose turn it is: a window of ``size`` places that moves on by its own width each turn and wraps around."""
    n = items.agg(F.count("*").alias("__n"))
    rotated = items.join(F.broadcast(n))
    return rotated.where(F.pmod(F.col(place) - F.pmod(F.lit(turn) * size, F.greatest(F.col("__n"), F.lit(1))), F.greatest(F.col("__n"), F.lit(1))) < size).drop("__n")
