"""The queries of the training-data operators, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.standins import STAND_INS
from ..session import load, materialize
from . import boilerplate, canonical, encoding, languages, leakage, mixing, name_variants, near_duplicates, residue, survivorship

FIELDS_OF_SET = ["title", "employer_name", "location"]
TEXT_FIELDS = ["title", "description", "employer_name"]


def _groups(web: DataFrame) -> DataFrame:
    return materialize(survivorship.same_thing(web, "row_id", [survivorship.id_key(F.col("external_id")), survivorship.url_key(F.col("apply_url"))]), "sets")


def _usable(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    web = load(spark, root, "website")
    groups = _groups(web)
    places = load(spark, root, "ref_places")
    known = places.select(F.explode(F.split(F.lower(F.concat_ws(" ", "city", "state", "country", F.translate("aliases", "|", " "))), r"\s+")).alias("word")).distinct()
    bad = survivorship.unusable(web, "row_id", FIELDS_OF_SET, ["title"], known)
    return web, groups, survivorship.observations(web, "row_id", groups, FIELDS_OF_SET, "last_seen", bad)


def _sets(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    web, groups, observed = _usable(spark, root)
    return web, groups, survivorship.survivors(observed)


def p1_sets(spark: SparkSession, root: str) -> DataFrame:
    """Every row of a set of two or more, with the set it belongs to."""
    return _groups(load(spark, root, "website")).select(F.col("row").alias("row_id"), F.col("group").alias("group_row_id"))


def p1_undated(spark: SparkSession, root: str) -> DataFrame:
    """How the learned order does without timestamps: those of every tenth row are blanked, and the survivors of the sets that lost one are held against the survivors by true times.

    One row for each field: the sets that lost a timestamp and hold two usable values or more, how many of them keep
    their surviving value, and how many would by the latest of the timestamps left.
    """
    observed = materialize(_usable(spark, root)[2], "observed")
    blank = F.pmod(F.xxhash64("row"), F.lit(10)) == 0
    some = materialize(observed.withColumn("ts", F.when(~blank, F.col("ts"))), "blanked")
    lost = some.groupBy("group", "field").agg(F.max(F.col("ts").isNull()).alias("lost"), F.countDistinct("value").alias("values")).where("lost and values > 1").select("group", "field")
    value = observed.select("group", "field", "row", "value")
    of = lambda chosen, name: chosen.join(value, ["group", "field", "row"]).select("group", "field", F.col("value").alias(name))
    both = lost.join(of(survivorship.survivors(observed), "true"), ["group", "field"]).join(of(survivorship.survivors(some), "learned"), ["group", "field"])
    dated = of(survivorship.survivors(some.where("ts is not null")), "latest_left")
    both = both.join(dated, ["group", "field"], "left")
    return both.groupBy("field").agg(F.count("*").alias("sets"), F.sum((F.col("true") == F.col("learned")).cast("int")).alias("kept"), F.sum(F.col("true").eqNullSafe(F.col("latest_left")).cast("int")).alias("kept_by_latest_left"))


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    _, groups, chosen = _sets(spark, root)
    names = {"group": "group_row_id", "title": "title_row_id", "employer_name": "employer_row_id", "location": "location_row_id"}
    return survivorship.surviving_rows(groups, chosen, FIELDS_OF_SET).withColumnsRenamed(names)


def p1_records(spark: SparkSession, root: str) -> DataFrame:
    """The surviving record of each set: identifier and the surviving values; null where no row is usable."""
    web, groups, chosen = _sets(spark, root)
    per = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in FIELDS_OF_SET])
    values = web.select(F.col("row_id").alias("row"), F.explode(per).alias("x")).select("row", "x.field", "x.value")
    picked = chosen.join(values, ["row", "field"]).groupBy("group").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in FIELDS_OF_SET])
    ids = web.select(F.col("row_id").alias("row"), survivorship.id_key(F.col("external_id")).alias("external_id"), "last_seen").join(groups, "row")
    first = ids.groupBy("group").agg(F.max_by("external_id", F.when(F.col("external_id").isNotNull(), F.struct("last_seen", F.expr("-row")))).alias("external_id"), F.count("*").alias("rows"))
    return first.join(picked, "group", "left").withColumnRenamed("group", "group_row_id")


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return name_variants.variant_pairs([(load(spark, root, "website"), "employer_name"), (load(spark, root, "candidates"), "company")])


def _links(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    web = load(spark, root, "website").select("row_id", "title", "description").where("description is not null")
    text = F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.col("description"))
    return near_duplicates.class_links(web, "row_id", text, F.col("description"), least_words=40, shingle=3, similarity=0.6, certain=0.7)


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return near_duplicates.expand(*_links(spark, root))


def p3_classes(spark: SparkSession, root: str) -> DataFrame:
    """One row for each compared row: the class of rows with equal words, and how many other classes are linked to it."""
    links, members = _links(spark, root)
    both = links.select(F.col("a").alias("class")).unionByName(links.select(F.col("b").alias("class"))).groupBy("class").agg(F.count("*").alias("links"))
    return members.join(both, "class", "left").select(F.col("row").alias("row_id"), F.col("class").alias("class_row_id"), F.coalesce("links", F.lit(0)).alias("links"))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return residue.residue_fields(load(spark, root, "website"), "row_id", ["title", "description"]).withColumnRenamed("row", "row_id")


def p4_groups(spark: SparkSession, root: str) -> DataFrame:
    return residue.residue_groups(load(spark, root, "website"), "row_id", ["title", "description"]).select(F.col("row").alias("row_id"), "field", F.col("group").alias("group_id"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return boilerplate.boilerplate_lines(load(spark, root, "website"), "row_id", "description").withColumnRenamed("row", "row_id")


def p5_main_text(spark: SparkSession, root: str) -> DataFrame:
    return boilerplate.main_text(load(spark, root, "website"), "row_id", "description").select(F.col("row").alias("row_id"), F.col("main").alias("main_text"))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return encoding.garbled_fields(load(spark, root, "website"), "row_id", TEXT_FIELDS).withColumnRenamed("row", "row_id")


def p6_repaired(spark: SparkSession, root: str) -> DataFrame:
    return encoding.repaired_fields(load(spark, root, "website"), "row_id", TEXT_FIELDS).withColumnsRenamed({"row": "row_id", "unknown": "words_unknown"})


def _mapped(spark: SparkSession, root: str) -> DataFrame:
    web = load(spark, root, "website")
    places = canonical.map_values(web, "row_id", "location", load(spark, root, "ref_places"), "place_id", ["city", "aliases"], "concat(city, '|', country)", ["state", "country"])
    categories = canonical.map_values(web, "row_id", "category", load(spark, root, "ref_categories"), "category_id", ["category", "aliases"], "category")
    return places.withColumn("field", F.lit("location")).unionByName(categories.withColumn("field", F.lit("category")))


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return _mapped(spark, root).select(F.col("row").alias("row_id"), "field", "entry_id")


def p7_unmatched(spark: SparkSession, root: str) -> DataFrame:
    """Values without an entry, with the rows that hold them and the best score that was not enough."""
    return _mapped(spark, root).where("entry_id = ''").groupBy("field", "value").agg(F.count("*").alias("rows"), F.max("score").alias("best_score"))


def _leaks(spark: SparkSession, root: str) -> DataFrame:
    return leakage.leaks(load(spark, root, "documents"), "doc_id", "text", load(spark, root, "eval_items"), "item_id", "text")


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    return _leaks(spark, root).where("run_share >= 0.5").select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p8_edited(spark: SparkSession, root: str) -> DataFrame:
    """Items that stand in a document with words replaced: too few whole runs, but most of their words are covered."""
    return _leaks(spark, root).where("run_share < 0.5").select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "run_share", "word_share")


def p8_items(spark: SparkSession, root: str) -> DataFrame:
    """Every item, with the documents that hold it and the largest share of its runs in one of them."""
    return leakage.leaked_items(_leaks(spark, root), load(spark, root, "eval_items"), "item_id").withColumnRenamed("item", "item_id")


REPORT = "source string, target_share double, documents long, size long, budget long, capacity long, passes int, reached long, reached_share double, falls_short boolean"


def _counted(spark: SparkSession, root: str) -> DataFrame:
    return mixing.counted_once(load(spark, root, "documents"), "doc_id", "source", "text")


def _report(spark: SparkSession, root: str) -> DataFrame:
    reports, _ = mixing.plan(_counted(spark, root), load(spark, root, "mix_targets"))
    columns = [c.split(" ")[0] for c in REPORT.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in reports], REPORT)


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    return _report(spark, root).where("falls_short").select("source")


def p9_shares(spark: SparkSession, root: str) -> DataFrame:
    return _report(spark, root)


def p9_mix(spark: SparkSession, root: str) -> DataFrame:
    counted = _counted(spark, root)
    reports, draws = mixing.plan(counted, load(spark, root, "mix_targets"))
    return mixing.mix(counted, reports, draws).withColumnRenamed("doc", "doc_id")


def _segments(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    docs = load(spark, root, "documents")
    model = languages.fit(docs, "text", "lang", load(spark, root, "lang_samples"), "text", "lang")
    return docs, languages.segments(docs, "doc_id", "text", model)


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    docs, found = _segments(spark, root)
    return languages.wrong_labels(docs, "doc_id", "lang", found).withColumnRenamed("doc", "doc_id")


def p10_segments(spark: SparkSession, root: str) -> DataFrame:
    return _segments(spark, root)[1].withColumnRenamed("doc", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {k: v for k, v in globals().items() if k.startswith("p") and k[1:2].isdigit() and callable(v)}
    return dict(sorted(own.items(), key=lambda x: (int(x[0][1:].split("_")[0]), x[0])))


WORDS = "regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')"


def _runs(table: str, key: str, text: str, k: int, where: str = "true") -> str:
    """SQL for the different runs of k words of each text."""
    return f"SELECT {key}, unnest(list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i+{k - 1}], ' ')))) AS r FROM (SELECT {key}, {WORDS.format(text=text)} AS w FROM {table} WHERE {where}) WHERE len(w) >= {k}"


SOURCE = "nullif(regexp_replace(lower(trim({c})), '[\\s_\\-]+', '_', 'g'), '')"


def oracle_sql() -> dict[str, str]:
    """SQL where the result can be stated by comparing everything with everything, or by another measure of size."""
    long_enough = f"description IS NOT NULL AND len({WORDS.format(text='description')}) >= 40"
    texts = _runs("website", "row_id", "coalesce(title, '') || chr(10) || description", 3, long_enough)
    items, docs = _runs("eval_items", "item_id", "coalesce(text, '')", 4), _runs("documents", "doc_id", "coalesce(text, '')", 4)
    said = lambda c: f"regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+', '', 'g')"
    blank = "('', " + ", ".join(f"'{w}'" for w in STAND_INS) + ")"
    ident = f"CASE WHEN {said('external_id')} NOT IN {blank} THEN 'i:' || {said('external_id')} END"
    address = r"regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(apply_url, '\s+', '', 'g')), '^[a-z][a-z0-9+.\-]*:/*|^//', ''), '[?#].*$', ''), '^www\.|[/.,;]+$', '', 'g')"
    place = f"CASE WHEN {said('apply_url')} NOT IN {blank} AND contains({address}, '.') THEN 'u:' || {address} END"
    sets = f"WITH RECURSIVE k AS (SELECT row_id, {ident} AS key FROM website UNION SELECT row_id, {place} FROM website), e AS (SELECT DISTINCT a.row_id AS a, b.row_id AS b FROM k a JOIN k b ON a.key = b.key AND a.row_id <> b.row_id), r AS (SELECT a AS row_id, a AS other FROM e UNION SELECT r.row_id, e.b FROM r JOIN e ON e.a = r.other)"
    return {
        "p1_sets": f"{sets} SELECT row_id, min(other) AS group_row_id FROM r GROUP BY row_id",
        "p3_found": f"WITH t AS ({texts}), n AS (SELECT row_id, count(*) AS n FROM t GROUP BY row_id), c AS (SELECT a.row_id AS row_id_a, b.row_id AS row_id_b, count(*) AS shared FROM t a JOIN t b ON a.r = b.r AND a.row_id < b.row_id GROUP BY 1, 2) SELECT row_id_a, row_id_b FROM c JOIN n x ON x.row_id = row_id_a JOIN n y ON y.row_id = row_id_b WHERE shared >= 0.6 * (x.n + y.n - shared)",
        "p3_classes": f"WITH w AS (SELECT row_id, array_to_string({WORDS.format(text="coalesce(title, '') || chr(10) || description")}, ' ') AS words FROM website WHERE {long_enough}), m AS (SELECT row_id, min(row_id) OVER (PARTITION BY words) AS class_row_id FROM w), t AS ({texts}), h AS (SELECT t.* FROM t JOIN m USING (row_id) WHERE row_id = class_row_id), n AS (SELECT row_id, count(*) AS n FROM h GROUP BY row_id), c AS (SELECT a.row_id AS x, b.row_id AS y, count(*) AS shared FROM h a JOIN h b ON a.r = b.r AND a.row_id <> b.row_id GROUP BY 1, 2), l AS (SELECT x, count(*) AS links FROM c JOIN n p ON p.row_id = x JOIN n q ON q.row_id = y WHERE shared >= 0.6 * (p.n + q.n - shared) GROUP BY 1) SELECT m.row_id, class_row_id, coalesce(links, 0) AS links FROM m LEFT JOIN l ON x = class_row_id",
        "p8_found": f"WITH i AS ({items}), n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id), d AS ({docs}), c AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN i ON d.r = i.r GROUP BY 1, 2) SELECT doc_id, c.item_id FROM c JOIN n ON n.item_id = c.item_id WHERE 2 * shared >= n",
        "p8_items": f"WITH i AS ({items}), n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id), d AS ({docs}), c AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN i ON d.r = i.r GROUP BY 1, 2), f AS (SELECT c.item_id, count(*) AS documents, max(shared / n::DOUBLE) AS best FROM c JOIN n ON n.item_id = c.item_id WHERE 2 * shared >= n GROUP BY 1) SELECT e.item_id, coalesce(documents, 0) AS documents, coalesce(best, 0.0) AS best_share FROM eval_items e LEFT JOIN f ON f.item_id = e.item_id",
        "p9_found": f"SELECT m.source FROM mix_targets m LEFT JOIN (SELECT {SOURCE.format(c='source')} AS k, sum(n_chars) AS s FROM documents GROUP BY 1) d ON d.k = {SOURCE.format(c='m.source')} WHERE coalesce(s, 0) * max_repeats < target_share * (SELECT sum(n_chars) FROM documents)",
    }
