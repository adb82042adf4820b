"""Keyed operators: who wins a key, merges into stored tables, caps and targets.

All of them aggregate with map-side combining or take a bounded top, so one hot key costs no more than its rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _winner(df: DataFrame, keys: list[str], order: list[Column], last: bool) -> DataFrame:
    pick = F.max_by if last else F.min_by
    rest = [c for c in df.columns if c not in keys]
    won = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("__row"))
    return won.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def first_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in the given order. Null keys form a group of their own."""
    return _winner(df, keys, order, last=False)


def last_wins(layers: Iterable[DataFrame], keys: list[str], order: str) -> DataFrame:
    """Layers laid over each other: of each key the row of the last layer that has it, and of that the last in order.

    The result also has ``layer``, the number of the layer that won, and ``first_layer``, the first that held the key.
    """
    stacked = None
    for n, layer in enumerate(layers):
        part = layer.withColumn("layer", F.lit(n))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    rest = [c for c in stacked.columns if c not in keys]
    won = stacked.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("layer", order)).alias("__row"), F.min("layer").alias("first_layer"))
    return won.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest], "first_layer")


def fold_duplicates(df: DataFrame, key: str, seq: str, base: Column, fields: dict[str, Column]) -> DataFrame:
    """Fold the rows of a key in order of ``seq`` into one: the row of the higher score leads, the earlier on ties, and
    takes over what it lacks from the other, which counts in its score from then on.

    ``base`` scores a row without its fields, ``fields`` maps each field that can be taken over to the score of its
    value. A row of the same base and the same scores of the same filled fields as an earlier one of its key changes nothing when its turn
    comes, as its fields are filled and its score is reached by then. Only the first of such rows goes into the fold,
    so a key of any number of rows brings a bounded number of them together. Null and empty fields count as lacking.

    Returns (key, leader, score, fields): the leading row's seq, the final score and the merged fields.
    """
    names = list(fields)
    filled = [F.when(F.coalesce(F.col(n).cast("string"), F.lit("")) != "", F.col(n).cast("string")) for n in names]
    worth = [F.when(v.isNotNull(), fields[n].cast("double")).otherwise(0.0) for n, v in zip(names, filled, strict=True)]
    cells = F.array(*[F.struct(v.alias("value"), w.alias("worth")) for v, w in zip(filled, worth, strict=True)])
    rows = df.select(F.col(key).alias("key"), F.col(seq).alias("seq"), base.cast("double").alias("base"), cells.alias("cells")).where("key is not null")
    same = F.struct("base", F.transform("cells", lambda c: c["worth"]).alias("worths"), F.transform("cells", lambda c: c["value"].isNotNull()).alias("has"))
    distinct = rows.groupBy("key", same.alias("same")).agg(F.min_by(F.struct("seq", "base", "cells"), "seq").alias("row"))
    total = lambda r: r["base"] + F.aggregate(r["cells"], F.lit(0.0), lambda a, c: a + c["worth"])

    def merged(lead: Column, other: Column) -> Column:
        cells = F.zip_with(lead["cells"], other["cells"], lambda a, b: F.when(a["value"].isNotNull(), a).otherwise(b))
        return F.struct(lead["seq"].alias("seq"), lead["base"].alias("base"), cells.alias("cells"))

    step = lambda state, row: F.when(total(row) > total(state), merged(row, state)).otherwise(merged(state, row))
    ordered = distinct.groupBy("key").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    folded = ordered.select("key", F.aggregate(F.slice("rows", 2, 1_000_000_000), F.get("rows", F.lit(0)), step).alias("won"))
    return folded.select(F.col("key").alias(key), F.col("won.seq").alias("leader"), total(F.col("won")).alias("score"), *[F.get("won.cells", F.lit(i))["value"].alias(n) for i, n in enumerate(names)])


def upsert(stored: DataFrame, incoming: DataFrame, key: str, keep: list[str], seq: str) -> DataFrame:
    """Merge by key: a stored row takes the values of the last incoming one, but for ``keep``, where its own stay if it
    has any; columns that the incoming rows lack stay too. ``action`` says insert, update or keep.

    Incoming rows of a null or empty key are left out; stored ones stay.
    """
    fresh = last_wins([incoming.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")], [key], seq).drop("layer", "first_layer", seq)
    mine = [c for c in stored.columns if c != key]
    new = [c for c in fresh.columns if c != key]
    left = stored.select(key, F.struct(*mine).alias("__old"))
    right = fresh.select(key, F.struct(*new).alias("__new"))
    both = left.join(right, key, "full_outer")
    cells = []
    for c in dict.fromkeys(mine + new):
        old, fresh_value = (F.col(f"__old.{c}") if c in mine else F.lit(None)), (F.col(f"__new.{c}") if c in new else F.lit(None))
        if c in keep:
            cells.append(F.coalesce(F.when(old.cast("string") != "", old), fresh_value).alias(c))
        else:
            cells.append(F.when(F.col("__new").isNotNull() & F.lit(c in new), fresh_value).otherwise(old).alias(c))
    action = F.when(F.col("__old").isNull(), "insert").when(F.col("__new").isNull(), "keep").otherwise("update")
    return both.select(key, *cells, action.alias("action"))


def append_new(stored: DataFrame, incoming: DataFrame, key: Column, seq: str) -> DataFrame:
    """The incoming rows whose key is neither stored nor held by an earlier incoming row; empty keys are left out."""
    known = stored.select(key.alias("__key")).distinct()
    fresh = incoming.withColumn("__key", key).where("__key <> ''")
    return first_wins(fresh.join(known, "__key", "left_anti"), ["__key"], [F.col(seq)]).drop("__key")


def cap(df: DataFrame, keys: list[str], order: list[Column], most: int) -> DataFrame:
    """At most ``most`` rows of each key, in order; row_number with a limit keeps only so many rows of a partition of the input before the exchange."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__n") <= most).drop("__n")


def until_target(df: DataFrame, accepted: Column, order: str, target: int) -> DataFrame:
    """The rows up to the one with which ``target`` accepted ones are reached. ``order`` must be unique.

    The place of that row is found by a bounded top, so no running total over all rows in one task is needed.
    """
    last = df.where(accepted).orderBy(order).limit(target).agg(F.count("*").alias("n"), F.max(order).alias("last"))
    bound = last.select(F.when(F.col("n") >= target, F.col("last")).alias("last"))
    return df.join(F.broadcast(bound), F.col("last").isNull() | (F.col(order) <= F.col("last")), "inner").drop("last")


def top_counts(df: DataFrame, value: Column, seq: str, most: int) -> DataFrame:
    """The commonest values, blanks as 'Blank'; of equal counts the one seen first. (value, n, place)"""
    named = F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit("Blank"))
    counted = df.groupBy(named.alias("value")).agg(F.count("*").alias("n"), F.min(seq).alias("first"))
    top = counted.orderBy(F.desc("n"), "first").limit(most)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "first"))).select("value", "n", "place")


def first_provider(hits: DataFrame, query: str, rank: str) -> DataFrame:
    """Of each query only the hits of the first provider that has any."""
    best = hits.groupBy(query).agg(F.min(rank).alias("__best"))
    return hits.join(best, query).where(F.col(rank) == F.col("__best")).drop("__best")


def match_in_turn(stored: DataFrame, incoming: DataFrame, ident: str, seq: str, keys: list[str], prefer: Column) -> DataFrame:
    """Match incoming rows to stored ones by the first key, else by the next, and say what becomes of every row.

    Of several stored rows with a key the preferred ones win, then the lesser ``ident``. Returns (ident, seq, action):
    'update' for a stored row and its incoming one, 'insert' for an incoming row without a match, 'close' for a further
    preferred stored row of the last key of a matched one, 'keep' for the rest. Null and empty keys match nothing.
    """
    old = stored.select(F.col(ident).alias("ident"), F.struct(F.when(F.coalesce(prefer, F.lit(False)), 0).otherwise(1).alias("late"), F.col(ident).alias("ident")).alias("rank"), *keys)
    found = incoming.select(F.col(seq).alias("seq"), *keys)
    for n, k in enumerate(keys):
        held = old.where(F.coalesce(F.col(k), F.lit("")) != "").groupBy(k).agg(F.min("rank").alias("best")).select(F.col(k), F.col("best.ident").alias(f"__m{n}"))
        found = found.join(held, k, "left")
    found = found.withColumn("ident", F.coalesce(*[F.col(f"__m{n}") for n in range(len(keys))])).select("ident", "seq", F.col(keys[-1]).alias("key"))
    one = found.where("ident is not null").groupBy("ident").agg(F.min("seq").alias("seq"), F.min("key").alias("key"))
    closed = old.where("rank.late = 0").select("ident", F.col(keys[-1]).alias("key")).where("key is not null and key <> ''").join(one.select("key").distinct(), "key", "left_semi").join(one.select("ident"), "ident", "left_anti")
    kept = old.select("ident").join(one.select("ident"), "ident", "left_anti").join(closed.select("ident"), "ident", "left_anti")
    none = F.lit(None).cast(dict(found.dtypes)["seq"])
    return (
        one.select("ident", "seq", F.lit("update").alias("action"))
        .unionByName(found.where("ident is null").select("ident", "seq", F.lit("insert").alias("action")))
        .unionByName(closed.select("ident", none.alias("seq"), F.lit("close").alias("action")))
        .unionByName(kept.select("ident", none.alias("seq"), F.lit("keep").alias("action")))
    )
