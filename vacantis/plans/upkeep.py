"""Queries that keep records: from jobs to records, checks against their pages, searches and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, urls
from ..operators import upkeep
from ..session import load, materialize
from ..sources import html
from .addresses import CANON, DOMAIN
from .pages import DAY, escaped
from .registry import query
from .texts import KEY, SQUASH, sql_text

AS_OF, CUTOFF = "2026-06-01", "2026-01-15"


def _day(value: str) -> Column:
    return F.lit(value).cast("date")


def _web(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website")


@query(
    f'SELECT row_id, substr(sha256({KEY}), 1, 24) AS fingerprint, coalesce(title, \'\') AS title, substr(coalesce(description, \'\'), 1, 500) AS short, \'JOB-\' || upper(substr(sha1(substr(sha256({KEY}), 1, 24)), 1, 16)) AS outside FROM website'
)
def stored_records(spark: SparkSession, root: str) -> DataFrame:
    """Rows as jobs, stored as records; the row's id goes along as the phone."""
    jobs = _web(spark, root).select("title", F.col("employer_name").alias("company"), "location", F.col("type").alias("job_type"), "description", F.col("row_id").cast("string").alias("phone"), F.to_date("last_seen").alias("posted"))
    r = upkeep.records_of_jobs(jobs, F.lit(AS_OF))
    return r.select(F.col("Public Contact Phone").cast("long").alias("row_id"), F.col("Fingerprint").alias("fingerprint"), F.col("Job Title").alias("title"), F.col("Short Description").alias("short"), upkeep.external_id(F.col("Job ID"), F.col("Fingerprint")).alias("outside"))


HIT = "https://hit.example/senior-architect-of-schools-in-town-acme-works-pune-"


@query(
    f"SELECT candidate_id, CASE WHEN m = 0 THEN 'Meta ' || candidate_id WHEN m = 1 THEN 'Page ' || candidate_id WHEN {sql_text(SQUASH, 'signal_title')} <> '' THEN {sql_text(SQUASH, 'signal_title')} ELSE 'Senior Architect Of Schools In at Town Acme Works' END AS title, CASE WHEN m = 0 THEN 'About ' || candidate_id WHEN m = 1 THEN 'Page ' || candidate_id || ' Body' ELSE {sql_text(SQUASH, 'signal_snippet')} END AS snippet FROM (SELECT *, length(coalesce(company, '')) % 4 AS m FROM candidates)"
)
def detailed_hits(spark: SparkSession, root: str) -> DataFrame:
    """Hits whose pages have metadata, have none, or were not fetched, by the length of a name."""
    c = load(spark, root, "candidates").withColumn("m", F.length(F.coalesce("company", F.lit(""))) % 4).withColumn("url", F.concat(F.lit(HIT), F.regexp_replace("candidate_id", "[^0-9]", ""), F.lit("0000?"), "candidate_id"))
    meta = F.concat(F.lit('<meta property="og:title" content="Meta '), "candidate_id", F.lit('"><meta name="description" content="About '), "candidate_id", F.lit('">'))
    body = F.concat(F.lit("<html><head><title>Page "), "candidate_id", F.lit("</title>"), F.when(F.col("m") == 0, meta).otherwise(F.lit("")), F.lit("</head><body>Body</body></html>"))
    facts = materialize(html.page_facts(c.where("m < 2").select("url", body.alias("html")), "url", "html"), "facts")
    hits = c.select(F.col("candidate_id").alias("query"), "url", F.col("signal_title").alias("title"), F.col("signal_snippet").alias("snippet"))
    return upkeep.hit_details(hits, facts).select(F.col("query").alias("candidate_id"), "title", "snippet")


PAGE_SQL = "CASE WHEN row_id % 5 = 1 THEN 'Position filled' ELSE 'We are hiring.' END"


@query(
    f"SELECT row_id, CASE WHEN CAST(last_seen AS DATE) < DATE '{CUTOFF}' THEN 'Posted before cutoff {CUTOFF}' WHEN e < DATE '{AS_OF}' THEN 'Application deadline passed: ' || strftime(e, '%Y-%m-%d') WHEN row_id % 3 = 0 THEN 'Application page is no longer publicly reachable' WHEN row_id % 5 = 1 THEN 'Closed signal: position filled' WHEN row_id % 7 = 2 THEN 'Role title is no longer visible on the source page' ELSE '' END AS reason FROM (SELECT row_id, last_seen, {DAY} AS e FROM website)"
)
def revalidations(spark: SparkSession, root: str) -> DataFrame:
    """Every row against a page made for it: some cannot be reached, some are closed, some no longer name the role."""
    web = _web(spark, root).withColumn("page", F.concat(F.lit("https://site.example/job/"), "row_id"))
    said = F.when(F.col("row_id") % 5 == 1, "Position filled").otherwise("We are hiring.")
    named = F.when(F.col("row_id") % 7 == 2, "Another vacancy").otherwise("Landscape Designer")
    body = F.concat(F.lit("<html><body><main><h1>"), escaped(named), F.lit("</h1><p>"), said, F.lit("</p></main></body></html>"))
    facts = materialize(html.page_facts(web.where("row_id % 3 <> 0").select(F.col("page").alias("url"), body.alias("html")), "url", "html"), "facts")
    records = web.select(
        F.col("row_id").alias("id"), F.lit("Landscape Designer").alias("title"), "description", "experience", F.col("tag").alias("skills"), F.lit("HTML").alias("source_type"), F.col("page").alias("source_url"), F.col("page").alias("apply_url"),
        F.lit("Apply Link").alias("method"), F.to_date("last_seen").alias("posted"), dates.parse_date(F.col("application_deadline_date")).alias("deadline"),
    )
    return upkeep.revalidated(records, facts, _day(AS_OF), _day(CUTOFF)).select(F.col("id").alias("row_id"), "reason")


WEAK = "CASE WHEN coalesce(title, '') = '' THEN 'no title' WHEN length(coalesce(description, '')) < 40 THEN 'no description' ELSE '' END"


@query(f"SELECT row_id, CASE WHEN status = 'publish' AND w <> '' THEN 'Closed' WHEN status = 'publish' THEN 'Active' ELSE coalesce(status, '') END AS status, CASE WHEN status = 'publish' AND w <> '' THEN w ELSE '' END AS reason FROM (SELECT *, {WEAK} AS w FROM website)")
def closed_rows(spark: SparkSession, root: str) -> DataFrame:
    rows = _web(spark, root).select("row_id", "title", "description", F.when(F.col("status") == "publish", "Active").otherwise(F.coalesce("status", F.lit(""))).alias("Status"), F.lit("").alias("Closed Reason"))
    rules = [("no title", F.coalesce("title", F.lit("")) == ""), ("no description", F.length(F.coalesce("description", F.lit(""))) < 40)]
    return upkeep.close_rows(rows, rules).select("row_id", F.col("Status").alias("status"), F.col("`Closed Reason`").alias("reason"))


SEARCH_ROLES = ("Junior Architect", "BIM Coordinator", "Interior Designer")


@query(
    "WITH p AS (SELECT role, city, rp, place_id, replace(lower(role), ' ', '-') AS rh, replace(lower(city), ' ', '-') AS ch, replace(role, ' ', '%2B') AS rq, replace(city, ' ', '%2B') AS cq, replace(role, ' ', '%20') AS re, replace(city, ' ', '%20') AS ce FROM ref_places, (VALUES " + ", ".join(f"({i}, '{r}')" for i, r in enumerate(SEARCH_ROLES)) + ") AS t(rp, role)), "
    "u AS (SELECT role, city, rp, place_id, unnest([{'n': 0, 'url': 'https://www.naukri.com/' || rh || '-jobs-in-' || ch}, {'n': 1, 'url': 'https://in.indeed.com/jobs?q=' || rq || '&l=' || cq || '&fromage=14'}, {'n': 2, 'url': 'https://www.linkedin.com/jobs/search?keywords=' || re || '&location=' || ce || '%2C%20India'}, {'n': 3, 'url': 'https://www.timesjobs.com/candidate/job-search.html?searchType=personalizedSearch&txtKeywords=' || re || '&txtLocation=' || ce}], recursive := true) FROM p) "
    "SELECT role, city, url FROM u ORDER BY rp, place_id, n LIMIT 180"
)
def board_searches(spark: SparkSession, root: str) -> DataFrame:
    """The search pages of four boards for roles and places, in order, up to the budget of 180."""
    roles = F.array(*[F.struct(F.lit(i).alias("rp"), F.lit(r).alias("role")) for i, r in enumerate(SEARCH_ROLES)])
    pairs = load(spark, root, "ref_places").select("place_id", "city", F.explode(roles).alias("r")).select("place_id", "city", "r.*")
    return upkeep.board_search_pages(pairs, "role", "city", [F.col("rp"), F.col("place_id")], 180)


@query(f"SELECT candidate_id, trim(company) AS company, {CANON.format(c='official_url')} AS career_url FROM candidates WHERE trim(coalesce(company, '')) <> '' AND {CANON.format(c='official_url')} <> '' AND {DOMAIN.format(c='official_url')} <> '' AND NOT regexp_matches(lower(official_url), '/login|/signin|/sign-in')")
def verified_sources(spark: SparkSession, root: str) -> DataFrame:
    """Candidates that become sources: a firm, and an official page on a host that is no login."""
    u = F.col("official_url")
    c = load(spark, root, "candidates").where((F.trim(F.coalesce("company", F.lit(""))) != "") & (urls.canonical_url(u) != "") & (urls.domain(u) != "") & ~urls.login_gated(u))
    return c.select("candidate_id", F.trim("company").alias("company"), urls.canonical_url(u).alias("career_url"))


@query("SELECT employer_name, title, row_id, row_number() OVER (ORDER BY employer_name, title, row_id) AS place FROM (SELECT coalesce(employer_name, '') AS employer_name, coalesce(title, '') AS title, row_id FROM website WHERE status = 'publish' AND coalesce(filled, '') <> 'yes') ORDER BY 1, 2, 3 LIMIT 500")
def site_export(spark: SparkSession, root: str) -> DataFrame:
    """The head of the export in its order: open rows by firm, title and id; the export itself is written sorted by range."""
    open_rows = _web(spark, root).where((F.col("status") == "publish") & (F.coalesce("filled", F.lit("")) != "yes"))
    top = open_rows.select(F.coalesce("employer_name", F.lit("")).alias("employer_name"), F.coalesce("title", F.lit("")).alias("title"), "row_id").orderBy("employer_name", "title", "row_id").limit(500)
    from pyspark.sql.window import Window

    return top.withColumn("place", F.row_number().over(Window.orderBy("employer_name", "title", "row_id")))
