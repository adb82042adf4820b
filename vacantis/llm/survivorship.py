"""One surviving record for each set of rows that describe the same thing, field by field, by currency reasoning.

Rows belong together through shared keys, also through third rows (connected components). Of each field, the latest
usable value survives. Where timestamps are missing, the order of values is learned: transitions between values of
timestamped rows give a precedence, the values of a set form a partial order under it, and a topologically latest value
survives.

Cases: null, blank and stand-in keys join nothing; rows repeated whole fall into one set; of equal timestamps the
smallest row id wins; a set without a usable value of a field has 0 there; rows without any timestamp are ordered by
precedence alone, and by row id where that says nothing; values in a cycle of precedence count as unordered; empty
tables give no sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.standins import bare, says_nothing
from ..operators.components import connected_components
from ..session import materialize
from . import encoding, residue

#: The share of the steps between two values that must go one way for one to precede the other.
MAJORITY = 0.75
# fixed values: legal forms that end a firm's name as a whole word; short forms of trades are told by their counts
WHOLE_WORDS = "ltd pvt llp inc co corp".split()


def id_key(value: Column) -> Column:
    """An identifier without case, separators and stray characters; null where it says nothing."""
    return F.when(~says_nothing(value), bare(value))


def url_key(value: Column) -> Column:
    """An address without scheme, www., query, fragment, closing slashes and case; null where it says nothing."""
    u = F.lower(F.regexp_replace(value, r"\s+", ""))
    u = F.regexp_replace(u, r"^[a-z][a-z0-9+.\-]*:/*|^//", "")
    u = F.regexp_replace(F.regexp_replace(u, r"[?#].*$", ""), r"^www\.|[/.,;]+$", "")
    return F.when(~says_nothing(value) & u.contains("."), u)


def same_thing(df: DataFrame, row: str, keys: list[Column]) -> DataFrame:
    """(row, group): the sets of two or more rows linked by an equal key; ``group`` is the smallest row of the set.

    A key held by many rows gives each of them one edge to the least of them, never all pairs.
    """
    held = df.select(F.col(row).alias("row"), F.explode(F.array(*[F.when(k.isNotNull(), F.concat(F.lit(f"{i}:"), k)) for i, k in enumerate(keys)])).alias("key")).where("key is not null")
    held = materialize(held.select("row", F.xxhash64("key").alias("key"), F.xxhash64(F.reverse("key")).alias("again")), "keys")
    first = held.groupBy("key", "again").agg(F.min("row").alias("first"))
    edges = held.join(first, ["key", "again"]).where("row <> first").select(F.col("row").alias("a"), F.col("first").alias("b"))
    return connected_components(edges).select(F.col("node").alias("row"), F.col("component").alias("group"))


def cut_short(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(field, value) of the values that were broken off.

    ``values``: (field, value, n), with the rows that hold each value. A value is cut if it ends in an ellipsis or an
    open bracket, if a commoner value goes on where it ends inside a word, or if its last word only begins a far
    commoner word. Words in ``known`` (word) are whole.
    """
    v = values.select("field", "value", "n", F.trim(F.regexp_replace(F.lower("value"), r"\s+", " ")).alias("low"))
    opened = F.length(F.regexp_replace("low", r"[^(]", "")) > F.length(F.regexp_replace("low", r"[^)]", ""))
    marked = v.where(F.col("low").rlike(r"(?:…|\.\.\.)$") | opened).select("field", "value")
    last = F.regexp_extract("low", r"([\p{L}\p{N}]+)$", 1)
    pair = F.regexp_replace(F.regexp_extract("low", r"([\p{L}\p{N}]+[^\p{L}\p{N}]+[\p{L}\p{N}]+)$", 1), r"[^\p{L}\p{N}]+", "")
    ended = v.withColumn("last", last).withColumn("pair", pair).where("last <> ''")

    words = v.select("field", "n", F.explode(F.array_distinct(F.regexp_extract_all("low", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))).alias("word"))
    common = words.groupBy("field", "word").agg(F.sum("n").alias("n"))
    begun = common.where(F.length("word") > 1).select("field", "n", F.expr("explode(transform(sequence(1, length(word) - 1), i -> struct(substring(word, 1, i) as last, substring(word, i + 1) as rest)))").alias("x"))
    # a word is the singular of another only if that plural is what it goes on to most often
    begun = begun.select("field", "x.last", F.when(F.col("x.rest") == "s", 0).otherwise(F.col("n")).alias("n"), F.struct("n", (F.col("x.rest") == "s").alias("plural")).alias("top"))
    begun = begun.groupBy("field", "last").agg(F.max("n").alias("more"), F.max("top")["plural"].alias("plural"))
    compared = common.withColumnRenamed("word", "last").join(begun, ["field", "last"]).where("last rlike '^\\\\p{L}+$' and not (plural and length(last) >= 5) and n < more")

    forms = v.groupBy("field", "low").agg(F.sum("n").alias("n"))
    places = F.filter(F.sequence(F.lit(3), F.length("low") - 1), lambda i: F.substring("low", i, F.lit(2)).rlike(r"^[\p{L}\p{N}]\p{L}$"))
    starts = forms.where(F.length("low") > 3).select("field", "low", "n", F.explode(places).alias("at"))
    goes_on = starts.select("field", F.expr("substring(low, 1, at)").alias("low"), "n").groupBy("field", "low").agg(F.sum("n").alias("more"))
    inside = forms.join(goes_on, ["field", "low"]).where("2 * n <= more").select("field", "low")
    inside = ended.join(inside, ["field", "low"]).join(compared.select("field", "last"), ["field", "last"], "left_semi").select("field", "value", "last")

    whole = common.select("field", F.col("word").alias("pair"), F.col("n").alias("whole"))
    broken = compared.where("n * 20 <= more").select("field", "last", F.col("n").alias("seen"))
    by_word = ended.where(F.col("low").rlike(r"(?:^|[ |,(/])[\p{L}\p{N}]+$")).join(broken, ["field", "last"]).join(whole, ["field", "pair"], "left").where("whole is null or whole < seen").select("field", "value", "last")

    judged = inside.unionByName(by_word).where(~F.col("last").isin(WHOLE_WORDS))
    if known is not None:
        judged = judged.join(known.select(F.col("word").alias("last")), "last", "left_anti")
    return marked.unionByName(judged.select("field", "value")).distinct()


def unusable(df: DataFrame, row: str, fields: list[str], titles: list[str], known: DataFrame | None = None) -> DataFrame:
    """(field, value) of the values that may not survive: blank, stand-in, cut short, garbled, and residue in ``titles``. Each distinct value is judged once."""
    per = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])
    values = df.select(F.explode(per).alias("x")).select("x.*").where("value is not null").groupBy("field", "value").agg(F.count("*").alias("n"))
    values = materialize(values, "values")
    empty = values.where(says_nothing(F.col("value"))).select("field", "value")
    said = values.where(~says_nothing(F.col("value")))
    garbled = encoding.garbled_fields(said.select("field", "value", F.struct("field", "value").alias("row")), "row", ["value"]).select("row.field", "row.value")
    # each part on its own: one plan of all would grow with every stage that ends
    parts = [empty, materialize(cut_short(said, known), "cut"), materialize(garbled, "garbled")]
    if titles:
        some = said.where(F.col("field").isin(titles)).select(F.struct("field", "value").alias("row"), "value")
        parts.append(materialize(residue.residue_fields(some, "row", ["value"]).select("row.field", "row.value"), "residue"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return materialize(out.distinct(), "unusable")


def precedence(observed: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(field, before, after, seen): which value follows which, learned from timestamped rows of one group.

    Rows are put in order by day and then within the day, and consecutive values are counted; a pair counts in the
    direction that MAJORITY of its steps take, as values that merely alternate say nothing of what is newer. A group of any size is spread over its days. Steps are followed to their end: a
    before b before c makes a before c, as often seen as its rarest step, by the chain where that is most. With
    ``wanted`` (field, value) only pairs of these values are given, and only they are followed.
    """
    dated = observed.where("ts is not null").withColumn("day", F.to_date("ts"))
    within = Window.partitionBy("group", "field", "day").orderBy("ts", "row")
    steps = dated.withColumn("before", F.lag("value").over(within)).where("before is not null and before <> value").select("field", "before", F.col("value").alias("after"))
    ends = dated.groupBy("group", "field", "day").agg(F.min_by("value", F.struct("ts", "row")).alias("first"), F.max_by("value", F.struct("ts", "row")).alias("last"))
    across = Window.partitionBy("group", "field").orderBy("day")
    joins = ends.withColumn("before", F.lag("last").over(across)).where("before is not null and before <> first").select("field", "before", F.col("first").alias("after"))
    counted = steps.unionByName(joins).groupBy("field", F.least("before", "after").alias("low"), F.greatest("before", "after").alias("high")).agg(F.sum(F.when(F.col("before") < F.col("after"), 1).otherwise(-1)).alias("net"), F.count("*").alias("steps"))
    one = counted.where(F.abs("net") >= (2 * MAJORITY - 1) * F.col("steps")).select("field", F.when(F.col("net") > 0, F.col("low")).otherwise(F.col("high")).alias("before"), F.when(F.col("net") > 0, F.col("high")).otherwise(F.col("low")).alias("after"), F.abs("net").alias("seen"))
    one = materialize(one, "steps")
    onward = one.select("field", F.col("before").alias("via"), "after", F.col("seen").alias("then"))
    out = one if wanted is None else materialize(one.join(wanted.select("field", F.col("value").alias("before")), ["field", "before"], "left_semi"), "order")
    fresh = out
    while fresh.take(1):
        longer = fresh.select("field", "before", F.col("after").alias("via"), "seen").join(onward, ["field", "via"]).where("before <> after").groupBy("field", "before", "after").agg(F.max(F.least("seen", "then")).alias("seen"))
        fresh = materialize(longer.join(out.withColumnRenamed("seen", "known"), ["field", "before", "after"], "left").where("known is null or seen > known").drop("known"), "order")
        out = materialize(out.unionByName(fresh).groupBy("field", "before", "after").agg(F.max("seen").alias("seen")), "order")
    if wanted is not None:
        out = out.join(wanted.select("field", F.col("value").alias("after")), ["field", "after"], "left_semi").select("field", "before", "after", "seen")
    back = out.select("field", F.col("after").alias("before"), F.col("before").alias("after"))
    return out.join(back, ["field", "before", "after"], "left_anti")


def survivors(observed: DataFrame) -> DataFrame:
    """(group, field, row): the row whose value survives. ``observed``: (group, field, row, value, ts), usable values only."""
    newest = F.struct("ts", F.expr("-row"))
    dated = observed.where("ts is not null").groupBy("group", "field").agg(F.max_by("row", newest).alias("row"), F.max_by("value", newest).alias("value"))
    undated = observed.where("ts is null").groupBy("group", "field", "value").agg(F.min("row").alias("row"))
    if not undated.take(1):
        return dated.select("group", "field", "row")
    # only sets with an undated value need the order
    open_sets = undated.select("group", "field").distinct()
    candidates = undated.withColumn("dated", F.lit(0)).unionByName(dated.join(open_sets, ["group", "field"], "left_semi").withColumn("dated", F.lit(1)))
    candidates = candidates.groupBy("group", "field", "value").agg(F.max("dated").alias("dated"), F.max_by("row", F.struct("dated", F.expr("-row"))).alias("row"))
    candidates = materialize(candidates, "candidates")
    several = candidates.groupBy("group", "field").agg(F.count("*").alias("k")).where("k > 1")
    wanted = materialize(candidates.join(several, ["group", "field"], "left_semi").select("field", "value").distinct(), "wanted")
    order = materialize(precedence(observed, wanted), "order")
    pairs = candidates.join(order.withColumnRenamed("before", "value"), ["field", "value"]).select("group", "field", "value", "after", "seen")
    standing = pairs.join(candidates.select("group", "field", F.col("value").alias("after")), ["group", "field", "after"])
    beaten = standing.select("group", "field", "value").distinct().withColumn("beaten", F.lit(1))
    backed = standing.groupBy("group", "field", F.col("after").alias("value")).agg(F.sum("seen").alias("backing"))
    ranked = candidates.join(beaten, ["group", "field", "value"], "left").join(backed, ["group", "field", "value"], "left")
    rank = F.struct(F.when(F.col("beaten").isNull(), 1).otherwise(0), F.coalesce("backing", F.lit(0)), F.col("dated"), F.expr("-row"))
    chosen = ranked.groupBy("group", "field").agg(F.max_by("row", rank).alias("row"))
    settled = dated.join(open_sets, ["group", "field"], "left_anti").select("group", "field", "row")
    return settled.unionByName(chosen.select("group", "field", "row"))


def observations(df: DataFrame, row: str, groups: DataFrame, fields: list[str], ts: str, bad: DataFrame) -> DataFrame:
    """(group, field, row, value, ts): the usable values of every set."""
    per = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])
    rows = df.select(F.col(row).alias("row"), F.col(ts).alias("ts"), per.alias("cells")).join(groups, "row")
    long = rows.select("group", "row", "ts", F.explode("cells").alias("x")).select("group", "row", "ts", "x.field", "x.value").where("value is not null")
    return long.join(bad, ["field", "value"], "left_anti").select("group", "field", "row", "value", "ts")


def surviving_rows(groups: DataFrame, chosen: DataFrame, fields: list[str]) -> DataFrame:
    """(group, one column a field): the row each field survives from, 0 where none is usable."""
    picked = chosen.groupBy("group").agg(*[F.max(F.when(F.col("field") == f, F.col("row"))).alias(f) for f in fields])
    return groups.select("group").distinct().join(picked, "group", "left").select("group", *[F.coalesce(f, F.lit(0)).cast("long").alias(f) for f in fields])
