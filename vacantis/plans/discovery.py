"""Queries that find and keep sources: reports on them, boards of known firms, searches, and the quality of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import sources as registry
from ..operators.reasons import first_reason
from ..session import load
from .addresses import CANON, DOMAIN
from .registry import query

AS_OF = "2026-06-01"
OK, REFUSED = "coalesce(company_name, '') <> ''", "coalesce(status, '') = 'Inactive'"


@query(
    f"WITH r AS (SELECT source_id, {OK} AND NOT {REFUSED} AS ok, {REFUSED} AS refused, coalesce(status, '') AS why FROM sources) "
    "SELECT s.source_id, CASE WHEN ok THEN 'Active' WHEN refused THEN 'Rejected' WHEN coalesce(consecutive_failures, 0) + 1 >= 8 THEN 'Inactive' ELSE 'Warning' END AS status, CASE WHEN ok THEN 3 WHEN refused THEN 0 ELSE jobs_found END AS jobs_found, CASE WHEN ok OR refused THEN 0 ELSE coalesce(consecutive_failures, 0) + 1 END AS consecutive_failures, CASE WHEN ok THEN coalesce(nullif(trim(quality_reason), ''), 'Checked successfully') ELSE coalesce(nullif(why, ''), nullif(trim(quality_reason), ''), 'Temporary source check failure') END AS quality_reason "
    "FROM sources s JOIN r ON r.source_id = s.source_id"
)
def sources_with_reports(spark: SparkSession, root: str) -> DataFrame:
    """A report on every source: named ones were read, inactive ones refused, the rest not reached."""
    s = load(spark, root, "sources").withColumn("career_url", F.concat(F.lit("https://source.example/"), "source_id"))
    ok, refused = F.expr(OK), F.expr(REFUSED)
    reports = s.select(F.col("career_url").alias("url"), (ok & ~refused).alias("ok"), refused.alias("refused"), F.coalesce("status", F.lit("")).alias("reason"), F.lit(3).alias("jobs"))
    kept = s.select("source_id", "career_url", "status", "jobs_found", "consecutive_failures", "last_checked", "last_success", "quality_reason")
    return registry.with_reports(kept, reports, F.lit("2026-06-01").cast("timestamp_ntz")).select("source_id", "status", "jobs_found", "consecutive_failures", "quality_reason")


REASON = f"CASE WHEN trim(coalesce(career_url, '')) = '' THEN 'no address' WHEN {DOMAIN.format(c='career_url')} = '' THEN 'no host' WHEN regexp_matches(lower(career_url), '/login|/signin|/sign-in') THEN 'login' ELSE '' END"


@query(f"SELECT source_id, CASE WHEN w <> '' THEN 'Rejected' ELSE status END AS status, CASE WHEN w <> '' THEN w ELSE quality_reason END AS quality_reason FROM (SELECT *, {REASON} AS w FROM sources)")
def rejected_sources(spark: SparkSession, root: str) -> DataFrame:
    s, u = load(spark, root, "sources"), F.col("career_url")
    reason = first_reason([("no address", F.trim(F.coalesce(u, F.lit(""))) == ""), ("no host", urls.domain(u) == ""), ("login", urls.login_gated(u))])
    return registry.reject(s, s.select("source_id", reason.alias("reason")), "source_id").select("source_id", "status", "quality_reason")


PROVIDERS = {name: hosts[0] for name, hosts in urls.ATS_HOSTS.items()}
BOARD_SQL = {
    "Lever": "'https://jobs.lever.co/' || k", "Greenhouse": "'https://job-boards.greenhouse.io/' || k", "Ashby": "'https://jobs.ashbyhq.com/' || k", "SmartRecruiters": "'https://careers.smartrecruiters.com/' || k",
    "Workable": "'https://apply.workable.com/' || k", "Freshteam": "'https://freshteam.com/jobs'",
}
IDENT_SQL = {"Workday": "'myworkdayjobs.com'", "Freshteam": "'freshteam.com'"}


def _boards() -> str:
    rows = []
    for name, host in PROVIDERS.items():
        address = f"'https://{host}/' || k || '/7'"
        rows.append(f"SELECT source_id, '{name}' AS provider, {IDENT_SQL.get(name, 'k')} AS identifier, {BOARD_SQL.get(name, address)} AS board FROM (SELECT source_id, lower(replace(source_id, '-', '')) AS k FROM sources)")
    return " UNION ALL ".join(rows)


@query(_boards())
def board_addresses(spark: SparkSession, root: str) -> DataFrame:
    """The addresses that a firm's vacancy would have at every system, taken apart again."""
    made = F.array(*[F.concat(F.lit(f"https://{h}/"), F.lower(F.replace("source_id", F.lit("-"), F.lit(""))), F.lit("/7")) for h in PROVIDERS.values()])
    s = load(spark, root, "sources").select("source_id", F.explode(made).alias("u"))
    u = F.col("u")
    return s.select("source_id", urls.ats_provider(u).alias("provider"), urls.ats_identifier(u).alias("identifier"), urls.ats_board_root(u).alias("board"))


@query(
    "SELECT DISTINCT company AS query, 'Lever' AS provider, 'https://jobs.lever.co/' || k AS board, k AS identifier FROM (SELECT company, signal_title, signal_snippet, regexp_replace(lower(company), '[^a-z0-9]', '', 'g') AS k FROM candidates WHERE coalesce(company, '') <> '') "
    "WHERE k <> '' AND trim(company) <> '' AND (contains(lower(concat_ws(' ', signal_title, signal_snippet, 'https://jobs.lever.co/' || k || '/1')), lower(trim(company))) OR (length(k) >= 5 AND contains(regexp_replace(lower(concat_ws(' ', signal_title, signal_snippet, 'https://jobs.lever.co/' || k || '/1')), '[^a-z0-9]', '', 'g'), k)))"
)
def boards_behind_firms(spark: SparkSession, root: str) -> DataFrame:
    """Results that lead to a board named after the firm: those whose text or address holds its name."""
    c = load(spark, root, "candidates").where("coalesce(company, '') <> ''").withColumn("k", F.regexp_replace(F.lower("company"), r"[^a-z0-9]", "")).where("k <> ''")
    results = c.select(F.col("company").alias("query"), F.concat(F.lit("https://jobs.lever.co/"), "k", F.lit("/1")).alias("url"), F.col("signal_title").alias("title"), F.col("signal_snippet").alias("snippet"))
    firms = c.select(F.col("company").alias("query"), "company", F.lit("").alias("website")).distinct()
    return registry.boards_of_firms(results, firms, "query").select("query", "provider", "board", "identifier")


RESOLVE = (('"{company}" "{role}" careers India', ("company", "role")), ('"{company}" "{role}" jobs India', ("company", "role")), ('"{company}" careers India', ("company",)), ('"{signal_title}" official careers India', ("signal_title",)))


@query(
    "SELECT candidate_id, i - 1 AS place, q[i] AS query FROM (SELECT candidate_id, q, unnest(range(1, len(q) + 1)) AS i FROM (SELECT candidate_id, list_filter(["
    + ", ".join("CASE WHEN " + " AND ".join(f"trim(coalesce({c}, '')) <> ''" for c in cs) + " THEN " + " || ".join(f"'{p}'" if i % 2 == 0 else p for i, p in enumerate(t.replace("{", "\0").replace("}", "\0").split("\0"))) + " END" for t, cs in RESOLVE)
    + "], lambda x: x IS NOT NULL)[1:3] AS q FROM candidates))"
)
def resolution_queries(spark: SparkSession, root: str) -> DataFrame:
    """What to search for to find the official page of a signal, at most three each."""
    return registry.queries_of(load(spark, root, "candidates"), "candidate_id", RESOLVE, 3).select("candidate_id", F.col("place").cast("long").alias("place"), "query")


@query(
    f"WITH h AS (SELECT company, candidate_id, {CANON.format(c='signal_url')} AS u FROM candidates WHERE coalesce(company, '') <> ''), f AS (SELECT company, u, min(candidate_id) AS pos FROM h WHERE u <> '' AND regexp_matches(u, '^https?://[^/]+/(?:careers|jobs|vacancy|openings|join-us)/[^?#/._]+$') GROUP BY company, u), n AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY pos) AS n FROM f) SELECT company, pos, u AS url FROM n WHERE n <= 2"
)
def official_careers_pages(spark: SparkSession, root: str) -> DataFrame:
    """Of each firm's signals the first two addresses on a careers path, in the order of ids."""
    hits = load(spark, root, "candidates").where("coalesce(company, '') <> ''").where(urls.canonical_url(F.col("signal_url")).rlike("^https?://[^/]+/(?:careers|jobs|vacancy|openings|join-us)/[^?#/._]+$"))
    return registry.official_pages(hits.select("company", F.col("candidate_id").alias("pos"), F.col("signal_url").alias("url")), "company", (), 2)


PLACES = {"india": 3, "talvagarh": 2, "anjurli": 2, "zorawadi": 2}
TRADE = {"architects?": 2, "interior design": 2, "landscape": 1, "studio": 1, "marketing": -5}


def _weights(words: dict[str, int]) -> str:
    return " + ".join(rf"{n} * CAST(regexp_matches(t, '(^|[^\p{{L}}\p{{N}}]){w}($|[^\p{{L}}\p{{N}}])') AS INT)" for w, n in words.items())


@query(
    f"SELECT row_id, place_score, trade_score, CASE WHEN {DOMAIN.format(c='apply_url')} = '' THEN 'no host' WHEN place_score < 2 THEN 'place below 2' WHEN trade_score < 1 THEN 'trade below 1' ELSE '' END AS reason FROM (SELECT row_id, apply_url, {_weights(PLACES)} AS place_score, {_weights(TRADE)} AS trade_score FROM (SELECT row_id, apply_url, lower(concat_ws(' ', employer_name, location, description)) AS t FROM website))"
)
def page_quality(spark: SparkSession, root: str) -> DataFrame:
    """Texts scored by tables of words for a place and a trade, with the first reason against each."""
    t = F.concat_ws(" ", "employer_name", "location", "description")
    scores = {"place": registry.weighted(t, PLACES), "trade": registry.weighted(t, TRADE)}
    q = registry.quality([("no host", urls.domain(F.col("apply_url")) == "")], scores, {"place": 2, "trade": 1})
    return load(spark, root, "website").select("row_id", q.alias("q")).select("row_id", F.col("q.place").alias("place_score"), F.col("q.trade").alias("trade_score"), "q.reason")


@query("SELECT reason, count(*) AS rows, sum(CASE WHEN regexp_matches(reason, 'place|trade') THEN 1 ELSE 0 END) AS weak FROM (" + "SELECT CASE WHEN coalesce(title, '') = '' THEN 'no title' WHEN coalesce(location, '') = '' THEN 'no place' WHEN coalesce(category, '') = '' THEN 'no trade' ELSE '' END AS reason FROM website) GROUP BY reason")
def counts_by_reason(spark: SparkSession, root: str) -> DataFrame:
    """Rows by the reason against them, and how many of those reasons speak of place or trade."""
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    reason = first_reason([("no title", empty("title")), ("no place", empty("location")), ("no trade", empty("category"))])
    r = load(spark, root, "website").select(reason.alias("reason"))
    return r.groupBy("reason").agg(F.count("*").alias("rows"), F.sum(F.col("reason").rlike("place|trade").cast("int")).alias("weak"))
