"""Queries that keep tables: what wins a key, merges, registries of sources, and histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, statements, text, urls
from ..functions.contacts import email_rank
from ..operators import history, keyed
from ..session import load
from .addresses import CANON, PATH
from .registry import query
from .texts import KEY

WEBSITE = "external_id title description status employer_author employer_email employer_name expiry_date application_deadline_date featured urgent filled apply_type apply_url apply_email phone salary max_salary salary_type address location category type tag experience gender industry qualification career_level video_url logo_url".split()


def _keyed(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website").withColumn("natural_key", text.natural_key(F.col("employer_name"), F.col("title"), F.col("location"))).where("natural_key <> '||'")


@query(
    f"WITH k AS (SELECT *, {KEY} AS natural_key FROM website), f AS (SELECT *, row_number() OVER (PARTITION BY natural_key ORDER BY row_id DESC) AS n FROM k WHERE natural_key <> '||' AND status = 'publish' AND filled <> 'yes') SELECT natural_key, row_id, "
    + ", ".join(f"'' AS {c}" if c == "external_id" else f"coalesce({c}, '') AS {c}" for c in WEBSITE)
    + " FROM f WHERE n = 1"
)
def website_publishable(spark: SparkSession, root: str) -> DataFrame:
    """The rows fit to publish: open ones, the last of each natural key, in the columns of the site and with blank ids."""
    rows = _keyed(spark, root).where("status = 'publish' and filled <> 'yes'").select("natural_key", "row_id", *WEBSITE)
    won = keyed.last_wins([rows], ["natural_key"], "row_id")
    return won.select("natural_key", "row_id", *[F.lit("").alias(c) if c == "external_id" else F.coalesce(c, F.lit("")).alias(c) for c in WEBSITE])


@query(
    f"WITH k AS (SELECT row_id, {KEY} AS natural_key, CASE WHEN source_id IS NULL THEN 0 WHEN last_seen < TIMESTAMP '2026-03-01' THEN 1 ELSE 2 END AS layer FROM website), r AS (SELECT natural_key, row_id, layer, row_number() OVER (PARTITION BY natural_key ORDER BY layer DESC, row_id DESC) AS n, min(layer) OVER (PARTITION BY natural_key) AS first_layer FROM k WHERE natural_key <> '||') SELECT natural_key, row_id, layer, first_layer FROM r WHERE n = 1"
)
def publish_last_wins(spark: SparkSession, root: str) -> DataFrame:
    """Three layers over each other: rows without a source, older ones, newer ones."""
    rows = _keyed(spark, root).select("natural_key", "row_id", "source_id", "last_seen")
    cut = F.lit("2026-03-01").cast("timestamp_ntz")
    layers = [rows.where("source_id is null"), rows.where(F.col("source_id").isNotNull() & (F.col("last_seen") < cut)), rows.where(F.col("source_id").isNotNull() & (F.col("last_seen") >= cut))]
    return keyed.last_wins(layers, ["natural_key"], "row_id").select("natural_key", "row_id", "layer", "first_layer")


FOLDED = ("experience", "tag", "application_deadline_date", "logo_url", "apply_email", "salary", "phone", "apply_url", "address")
RANK = "CASE WHEN regexp_matches(l, 'career|jobs|recruit|talent|hiring') THEN 0 WHEN l IN ('hr', 'humanresources', 'human.resources') OR l LIKE 'hr.%' OR l LIKE 'hr-%' THEN 1 WHEN regexp_matches(l, 'people|team') THEN 2 WHEN regexp_matches(l, 'hello|contact|info|office') THEN 5 WHEN regexp_matches(l, 'press|media|exec|admin') THEN 9 ELSE 6 END"
WORTH = {"experience": "3", "tag": "2", "application_deadline_date": "3", "logo_url": "CASE WHEN contains(lower(logo_url), 'logo') THEN 3 ELSE 0 END", "apply_email": f"greatest(0, 4 - ({RANK}))"}
BASE = f"(CASE WHEN len(list_filter(string_split({PATH.format(c='apply_url')}, '/'), lambda x: x <> '')) > 1 THEN 8 ELSE 0 END + least(floor(length(coalesce(description, '')) / 350), 5))::DOUBLE"
VALS = "[" + ", ".join(f"nullif({c}, '')" for c in FOLDED) + "]"
WORTHS = "[" + ", ".join(f"CASE WHEN coalesce({c}, '') <> '' THEN ({WORTH.get(c, '0')})::DOUBLE ELSE 0.0 END" for c in FOLDED) + "]"
PICK = "list_transform(range(1, 10), lambda i: CASE WHEN r.total > s.base + list_sum(s.worths) THEN (CASE WHEN r.vals[i] IS NOT NULL THEN r.{x}[i] ELSE s.{x}[i] END) ELSE (CASE WHEN s.vals[i] IS NOT NULL THEN s.{x}[i] ELSE r.{x}[i] END) END)"
LEADS = "CASE WHEN r.total > s.base + list_sum(s.worths) THEN r.{x} ELSE s.{x} END AS {x}"


@query(
    f"WITH RECURSIVE w AS (SELECT *, {KEY} AS natural_key, lower(split_part(coalesce(apply_email, ''), '@', 1)) AS l FROM website), "
    f"r AS (SELECT natural_key, row_id, row_number() OVER (PARTITION BY natural_key ORDER BY row_id) AS n, {BASE} AS base, {VALS} AS vals, {WORTHS} AS worths, {BASE} + list_sum({WORTHS}) AS total FROM w WHERE natural_key <> '||'), "
    f"s AS (SELECT natural_key, n, row_id, base, vals, worths FROM r WHERE n = 1 UNION ALL SELECT s.natural_key, r.n, {LEADS.format(x='row_id')}, {LEADS.format(x='base')}, {PICK.format(x='vals')} AS vals, {PICK.format(x='worths')} AS worths FROM s JOIN r ON r.natural_key = s.natural_key AND r.n = s.n + 1) "
    + "SELECT natural_key, row_id AS leader, base + list_sum(worths) AS score, " + ", ".join(f"vals[{i}] AS {c}" for i, c in enumerate(FOLDED, 1)) + " FROM (SELECT *, max(n) OVER (PARTITION BY natural_key) AS last FROM s) WHERE n = last"
)
def dedupe_fold(spark: SparkSession, root: str) -> DataFrame:
    """Rows of one natural key folded into one, in order; the SQL folds them row by row."""
    rows = _keyed(spark, root)
    base = F.when(F.size(urls.path_parts(F.col("apply_url"))) > 1, 8).otherwise(0) + F.least(F.floor(F.length(F.coalesce("description", F.lit(""))) / 350), F.lit(5))
    fields = {"experience": F.lit(3), "tag": F.lit(2), "application_deadline_date": F.lit(3), "logo_url": F.when(F.lower("logo_url").contains("logo"), 3).otherwise(0), "apply_email": F.greatest(F.lit(0), 4 - email_rank(F.col("apply_email"))), "salary": F.lit(0), "phone": F.lit(0), "apply_url": F.lit(0), "address": F.lit(0)}
    return keyed.fold_duplicates(rows, "natural_key", "row_id", base, fields)


@query(
    "WITH i AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY last_checked DESC, candidate_id DESC) AS n FROM candidates WHERE coalesce(company, '') <> ''), new AS (SELECT company, last_checked, discovered_at, decision FROM i WHERE n = 1), s AS (SELECT * FROM (SELECT company, rejected_at AS discovered_at, reject_reason AS note, row_number() OVER (PARTITION BY company ORDER BY rejected_at, rejected_id) AS n FROM rejected WHERE coalesce(company, '') <> '') WHERE n = 1) "
    "SELECT coalesce(s.company, new.company) AS company, coalesce(s.discovered_at, new.discovered_at) AS discovered_at, s.note AS note, new.last_checked AS last_checked, new.decision AS decision, CASE WHEN s.company IS NULL THEN 'insert' WHEN new.company IS NULL THEN 'keep' ELSE 'update' END AS action FROM s FULL OUTER JOIN new ON s.company = new.company"
)
def upsert_keeps_first_seen(spark: SparkSession, root: str) -> DataFrame:
    """Firms seen as rejected are the stored table, candidates come in; the time of discovery stays with the stored row."""
    stored = keyed.first_wins(load(spark, root, "rejected").where("coalesce(company, '') <> ''"), ["company"], [F.col("rejected_at"), F.col("rejected_id")]).select("company", F.col("rejected_at").alias("discovered_at"), F.col("reject_reason").alias("note"))
    incoming = load(spark, root, "candidates").select("company", "last_checked", "discovered_at", "decision", F.struct("last_checked", "candidate_id").alias("seq"))
    return keyed.upsert(stored, incoming, "company", ["discovered_at"], "seq")


@query(f"WITH known AS (SELECT DISTINCT {CANON.format(c='company_website')} AS u FROM sources), i AS (SELECT candidate_id, {CANON.format(c='official_url')} AS u FROM candidates), f AS (SELECT candidate_id, u, row_number() OVER (PARTITION BY u ORDER BY candidate_id) AS n FROM i WHERE u <> '' AND u NOT IN (SELECT u FROM known)) SELECT candidate_id, u AS website FROM f WHERE n = 1")
def new_sources(spark: SparkSession, root: str) -> DataFrame:
    """Sites of candidates that no source has, each once."""
    stored = load(spark, root, "sources").select(F.col("company_website").alias("website"))
    incoming = load(spark, root, "candidates").select("candidate_id", F.col("official_url").alias("website"))
    return keyed.append_new(stored, incoming, urls.canonical_url(F.col("website")), "candidate_id").select("candidate_id", urls.canonical_url(F.col("website")).alias("website"))


@query("SELECT source_id, career_url FROM sources WHERE status IN ('Active', 'Warning', 'New') ORDER BY coalesce(last_checked, TIMESTAMP '1970-01-01'), jobs_found DESC, career_url LIMIT 30")
def due_sources(spark: SparkSession, root: str) -> DataFrame:
    live = load(spark, root, "sources").where(F.col("status").isin("Active", "Warning", "New")).select("source_id", "career_url", "last_checked", "jobs_found")
    return history.due_batch(live, "last_checked", "jobs_found", "career_url", 30).select("source_id", "career_url")


@query("SELECT row_id, source_id FROM website w WHERE source_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sources s WHERE s.source_id = w.source_id)")
def rows_without_source(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website").where("source_id is not null").select("row_id", "source_id").join(load(spark, root, "sources").select("source_id"), "source_id", "left_anti").select("row_id", "source_id")


@query("SELECT source_id, row_id FROM (SELECT source_id, row_id, row_number() OVER (PARTITION BY source_id ORDER BY last_seen DESC, row_id) AS n FROM website WHERE source_id IS NOT NULL) WHERE n <= 8")
def cap_per_source(spark: SparkSession, root: str) -> DataFrame:
    rows = load(spark, root, "website").where("source_id is not null").select("source_id", "row_id", "last_seen")
    return keyed.cap(rows, ["source_id"], [F.desc("last_seen"), F.col("row_id")], 8).select("source_id", "row_id")


@query("WITH a AS (SELECT row_id, sum(CASE WHEN coalesce(apply_email, '') <> '' THEN 1 ELSE 0 END) OVER (ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM website) SELECT row_id FROM a WHERE coalesce(before, 0) < 120")
def until_target(spark: SparkSession, root: str) -> DataFrame:
    """Rows in order until 120 with an address for applying are reached."""
    rows = load(spark, root, "website").select("row_id", "apply_email")
    return keyed.until_target(rows, F.coalesce("apply_email", F.lit("")) != "", "row_id", 120).select("row_id")


@query(
    "WITH s AS (SELECT user_id, max(CASE WHEN event_type <> 'error' THEN (ts, event_id) END) AS ok, count(*) AS checks, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS failures, max(ts) AS last_check, max(CASE WHEN event_type <> 'error' THEN ts END) AS last_success FROM events GROUP BY user_id), o AS (SELECT e.user_id, count(*) AS n FROM events e JOIN s ON s.user_id = e.user_id WHERE e.event_type = 'error' AND (s.ok IS NULL OR (e.ts, e.event_id) > s.ok) GROUP BY e.user_id) SELECT s.user_id, checks, CAST(failures AS BIGINT) AS failures, coalesce(o.n, 0) AS open_failures, last_success, last_check, CASE WHEN coalesce(o.n, 0) >= 8 THEN 'Inactive' WHEN coalesce(o.n, 0) > 0 THEN 'Warning' ELSE 'Active' END AS status FROM s LEFT JOIN o ON o.user_id = s.user_id"
)
def source_health(spark: SparkSession, root: str) -> DataFrame:
    """Events stand for checks of sources, errors for failed ones: failures since the last success and what they mean."""
    s = history.streaks(load(spark, root, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id", F.col("event_type") == "error")
    return s.withColumn("status", F.when(F.col("open_failures") >= 8, "Inactive").when(F.col("open_failures") > 0, "Warning").otherwise("Active"))


@query(
    "WITH m AS (SELECT user_id, ts, event_id, event_type = 'error' AS failed FROM events), c AS (SELECT *, CASE WHEN lag(failed) OVER w IS NOT DISTINCT FROM failed THEN 0 ELSE 1 END AS new FROM m WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM c) SELECT user_id, CAST(island AS BIGINT) AS island, failed AS state, min(ts) AS begins, max(ts) AS ends, count(*) AS n FROM i GROUP BY user_id, island, failed"
)
def health_islands(spark: SparkSession, root: str) -> DataFrame:
    return history.islands(load(spark, root, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id", F.col("event_type") == "error")


@query("SELECT row_id, CASE WHEN last_seen < TIMESTAMP '2026-01-01' THEN 'Stale' WHEN try_strptime(expiry_date, '%d-%m-%Y') < TIMESTAMP '2026-06-01' THEN 'Closed' ELSE 'Fresh' END AS freshness, date_diff('day', CAST(last_seen AS DATE), CAST(ingested_at AS DATE)) AS days_late FROM website")
def freshness(spark: SparkSession, root: str) -> DataFrame:
    cut, today = F.lit("2026-01-01").cast("timestamp_ntz"), F.lit("2026-06-01").cast("date")
    label = F.when(F.col("last_seen") < cut, "Stale").when(dates.parse_date(F.col("expiry_date")) < today, "Closed").otherwise("Fresh")
    return load(spark, root, "website").select("row_id", label.alias("freshness"), F.datediff(F.to_date("ingested_at"), F.to_date("last_seen")).cast("long").alias("days_late"))


@query("SELECT CAST(floor(epoch(ts) / 10800) AS BIGINT) AS slot, event_type, count(*) AS n, min(event_id) AS first_event FROM events GROUP BY 1, 2")
def slots(spark: SparkSession, root: str) -> DataFrame:
    e = load(spark, root, "events").withColumn("slot", history.slot(F.col("ts").cast("timestamp"), 3))
    return e.groupBy("slot", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS INT) >= 50")
def json_props(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k")).where("k >= 50")
