"""Queries on feeds and pages. No feed or page stands among the tables, so each is made from rows of them and read again:
what comes out must be what went in, which SQL states directly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, evidence, repair, statements, text, urls
from ..functions.titles import longest_city
from ..operators import keyed
from ..session import load, materialize
from ..sources import cards, feeds, html, jobs
from .publish import website_rows
from .registry import query
from .texts import SQUASH, sql_text

CITIES = {"talvagarh": "Madhyavan", "anjurli": "Purvan", "zorawadi": "Himadesh"}
TAG = r"'(?s)<!--.*?-->|<[A-Za-z/!][^>]*>'"


def _text(column: str) -> str:
    """SQL for the text of a fragment of HTML."""
    out = f"regexp_replace(coalesce({column}, ''), {TAG}, ' ', 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return sql_text(SQUASH, out)


def escaped(value: Column) -> Column:
    out = F.coalesce(value, F.lit(""))
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def _web(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "website")


def _shown(found: DataFrame) -> DataFrame:
    return found.select(F.col("board").alias("row_id"), "title", "location", "description", "job_type", "posted", "apply_url")


def _trim(c: str) -> str:
    return f"trim(coalesce({c}, ''))"


@query(f"SELECT row_id, {_trim('title')} AS title, {_trim('location')} AS location, {_trim('description')} AS description, {_trim('type')} AS job_type, CAST(NULL AS VARCHAR) AS posted, CASE WHEN {_trim('apply_url')} <> '' THEN {_trim('apply_url')} ELSE 'https://jobs.example/' || row_id END AS apply_url FROM website")
def lever_feeds(spark: SparkSession, root: str) -> DataFrame:
    job = F.struct(F.col("title").alias("text"), F.struct("location", F.col("type").alias("commitment")).alias("categories"), F.col("description").alias("descriptionPlain"), F.concat(F.lit("https://jobs.example/"), "row_id").alias("hostedUrl"), F.col("apply_url").alias("applyUrl"))
    return _shown(feeds.lever_jobs(_web(spark, root).select("row_id", F.to_json(F.array(job)).alias("body")), "row_id", "body"))


@query(f"SELECT row_id, {_trim('title')} AS title, {_trim('location')} AS location, {_text('description')} AS description, '' AS job_type, strftime(last_seen, '%Y-%m-%d') AS posted, {_trim('apply_url')} AS apply_url FROM website")
def greenhouse_feeds(spark: SparkSession, root: str) -> DataFrame:
    job = F.struct("title", F.struct(F.col("location").alias("name")).alias("location"), escaped(F.concat(F.lit("<p>"), escaped(F.col("description")), F.lit("</p>"))).alias("content"), F.col("apply_url").alias("absolute_url"), F.date_format("last_seen", "yyyy-MM-dd").alias("updated_at"))
    rows = _web(spark, root).withColumn("description", F.regexp_replace("description", r"(?s)<!--.*?-->|<[A-Za-z/!][^>]*>", " "))
    return _shown(feeds.greenhouse_jobs(rows.select("row_id", F.to_json(F.struct(F.array(job).alias("jobs"))).alias("body")), "row_id", "body"))


@query(f"SELECT row_id, {_trim('title')} AS title, {_trim('location')} AS location, {_trim('description')} AS description, {_trim('type')} AS job_type, strftime(last_seen, '%Y-%m-%d') AS posted, {_trim('apply_url')} AS apply_url FROM website WHERE filled IS NULL OR filled <> 'yes'")
def ashby_feeds(spark: SparkSession, root: str) -> DataFrame:
    """Filled vacancies are off the list."""
    job = F.struct("title", "location", (~F.col("filled").eqNullSafe("yes")).alias("isListed"), F.col("description").alias("descriptionPlain"), F.col("type").alias("employmentType"), F.col("apply_url").alias("jobUrl"), F.date_format("last_seen", "yyyy-MM-dd").alias("publishedAt"))
    return _shown(feeds.ashby_jobs(_web(spark, root).select("row_id", F.to_json(F.struct(F.array(job).alias("jobs"))).alias("body")), "row_id", "body"))


@query(f"SELECT row_id, {_trim('title')} AS title, concat_ws(', ', nullif(address, ''), nullif(location, '')) AS location, {_text('title')} AS description, {_trim('type')} AS job_type, strftime(last_seen, '%Y-%m-%d') AS posted, {_trim('apply_url')} AS apply_url FROM website")
def smartrecruiters_feeds(spark: SparkSession, root: str) -> DataFrame:
    """A list of each board joined to the details of its jobs."""
    web = _web(spark, root).withColumn("id", F.col("row_id").cast("string"))
    listed = F.struct("id", F.col("title").alias("name"), F.struct(F.col("address").alias("city"), F.col("location").alias("region")).alias("location"), F.date_format("last_seen", "yyyy-MM-dd").alias("releasedDate"))
    detail = F.to_json(F.struct(F.struct(F.create_map(F.lit("a"), F.struct(F.col("title").alias("text"))).alias("sections")).alias("jobAd"), F.col("apply_url").alias("ref"), F.struct(F.col("type").alias("label")).alias("typeOfEmployment")))
    listing = feeds.smart_listing(web.select("row_id", F.to_json(F.struct(F.array(listed).alias("content"))).alias("body")), "row_id", "body")
    return _shown(feeds.smart_jobs(listing, web.select(F.col("row_id").alias("board"), "id", detail.alias("body")), "body"))


@query(f"SELECT candidate_id, {_trim('signal_title')} AS title, {_trim('signal_url')} AS url, {_text('signal_snippet')} AS snippet FROM candidates WHERE coalesce(signal_url, '') <> ''")
def rss_results(spark: SparkSession, root: str) -> DataFrame:
    item = lambda name, c: F.concat(F.lit(f"<{name}>"), escaped(F.col(c)), F.lit(f"</{name}>"))
    body = F.concat(F.lit("<rss><channel><item>"), item("title", "signal_title"), item("link", "signal_url"), item("description", "signal_snippet"), F.lit("</item></channel></rss>"))
    hits = feeds.rss_hits(load(spark, root, "candidates").select("candidate_id", body.alias("body")), "candidate_id", "body", 20)
    shown = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return hits.where("coalesce(url, '') <> ''").select(F.col("query").alias("candidate_id"), shown("title"), "url", shown("snippet"))


def _cards(spark: SparkSession, root: str, site: str) -> DataFrame:
    card, link, snippet = cards.SITES[site]
    link_class, snippet_open = (f' class="{link}"' if link else ""), (f'<div class="{snippet}">' if snippet else "<div><p>")
    address = F.concat(F.lit("https://search.example/l/?uddg="), F.url_encode("signal_url")) if link else F.col("signal_url")
    body = F.concat(F.lit(f'<html><body><div class="{card}"><h2><a{link_class} href="'), escaped(address), F.lit('">'), escaped(F.col("signal_title")), F.lit(f"</a></h2>{snippet_open}"), escaped(F.col("signal_snippet")), F.lit("</p></div></div></body></html>" if not snippet else "</div></div></body></html>"))
    rows = load(spark, root, "candidates").where("signal_url like 'http%'").select("candidate_id", body.alias("body"))
    return cards.result_cards(rows, "candidate_id", "body", site).select("candidate_id", "title", "url", "snippet")


CANONICAL = r"regexp_replace(regexp_replace(trim(signal_url), '#.*$', ''), '/+$', '')"
CARDS = f"SELECT candidate_id, {sql_text(SQUASH, 'signal_title')} AS title, {CANONICAL} AS url, {sql_text(SQUASH, 'signal_snippet')} AS snippet FROM candidates WHERE signal_url LIKE 'http%'"


@query(CARDS)
def bing_cards(spark: SparkSession, root: str) -> DataFrame:
    return _cards(spark, root, "Bing")


@query(CARDS)
def duckduckgo_cards(spark: SparkSession, root: str) -> DataFrame:
    """Links go through the site's redirect."""
    return _cards(spark, root, "DuckDuckGo")


@query("SELECT DISTINCT source_id, career_url AS loc FROM sources WHERE coalesce(career_url, '') <> '' AND NOT regexp_matches(career_url, '(?i)\\.xml(?:[?#].*)?$')")
def sitemap_addresses(spark: SparkSession, root: str) -> DataFrame:
    """Each source has a sitemap that names a further one, which lists its careers page."""
    s = load(spark, root, "sources").where("coalesce(career_url, '') <> ''").select("source_id", F.trim("career_url").alias("career_url"))
    top = s.select(F.col("source_id").alias("url"), F.concat(F.lit("<sitemapindex><sitemap><loc>https://maps.example/"), "source_id", F.lit(".xml</loc></sitemap></sitemapindex>")).alias("body"))
    below = s.select(F.concat(F.lit("https://maps.example/"), "source_id", F.lit(".xml")).alias("url"), F.concat(F.lit("<urlset><url><loc>"), F.replace("career_url", F.lit("&"), F.lit("&amp;")), F.lit("</loc></url></urlset>")).alias("body"))
    return feeds.sitemap_pages(top.unionByName(below), top.select("url"), "url", "body").select(F.col("root").alias("source_id"), "loc")


def built_pages(spark: SparkSession, root: str) -> DataFrame:
    """(row_id, url, html): a careers page for every row, with the data in JSON-LD where the row has an even id."""
    ld = F.to_json(
        F.struct(
            F.lit("JobPosting").alias("@type"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("description", F.lit("")).alias("description"), F.struct(F.coalesce("employer_name", F.lit("")).alias("name")).alias("hiringOrganization"),
            F.struct(F.struct(F.coalesce("location", F.lit("")).alias("addressLocality")).alias("address")).alias("jobLocation"), F.coalesce("type", F.lit("")).alias("employmentType"), F.date_format("last_seen", "yyyy-MM-dd").alias("datePosted"), F.coalesce("apply_url", F.lit("")).alias("url"),
        )
    )
    script = F.when(F.col("row_id") % 2 == 0, F.concat(F.lit('<script type="application/ld+json">'), F.replace(ld, F.lit("</"), F.lit("<\\/")), F.lit("</script>"))).otherwise(F.lit(""))
    body = F.concat(
        F.lit('<html><head><title>Careers</title><meta property="og:site_name" content="'), escaped(F.col("employer_name")), F.lit('"><meta name="date" content="'), F.date_format("last_seen", "yyyy-MM-dd"), F.lit('">'), script,
        F.lit('</head><body><header><img src="/img/logo.svg" alt="logo"></header><main><h1>Careers</h1><h2>Senior Architect</h2><p>'), escaped(F.col("description")), F.lit('</p><h2>Site Engineer <a href="/jobs/'), F.col("row_id").cast("string"),
        F.lit('">more</a></h2><p><a href="'), escaped(F.col("apply_url")), F.lit('">Apply now</a></p></main></body></html>'),
    )
    return _web(spark, root).select("row_id", F.concat(F.lit("https://site.example/careers/"), "row_id").alias("url"), body.alias("html"))


def _facts(spark: SparkSession, root: str) -> DataFrame:
    return materialize(html.page_facts(built_pages(spark, root), "url", "html"), "facts")


@query(f"SELECT row_id, {sql_text(SQUASH, 'title')} AS title, CASE WHEN trim(coalesce(employer_name, '')) <> '' THEN trim(employer_name) ELSE 'Careers' END AS company, coalesce(location, '') AS location, coalesce(type, '') AS job_type, CAST(last_seen AS DATE) AS posted FROM website WHERE row_id % 2 = 0")
def structured_page_jobs(spark: SparkSession, root: str) -> DataFrame:
    """Jobs out of the JSON-LD of pages, which every other page has; a firm that it leaves out is taken from the page."""
    facts = _facts(spark, root)
    found = jobs.structured_jobs(facts).join(facts.select(F.col("url").alias("page"), "row_id"), "page")
    return found.select("row_id", "title", F.trim("company").alias("company"), "location", "job_type", "posted")


@query("SELECT row_id, pos, text, href, level FROM (SELECT row_id, unnest([{'pos': 0, 'text': 'Careers', 'href': '', 'level': 1}, {'pos': 1, 'text': 'Senior Architect', 'href': '', 'level': 2}, {'pos': 2, 'text': 'Site Engineer more', 'href': 'https://site.example/jobs/' || row_id, 'level': 2}], recursive := true) FROM website)")
def page_headings(spark: SparkSession, root: str) -> DataFrame:
    return _facts(spark, root).select("row_id", F.explode("headings").alias("h")).select("row_id", "h.pos", "h.text", "h.href", "h.level")


@query("SELECT row_id, 'Senior Architect' AS title, 'https://site.example/img/logo.svg' AS logo, CAST(last_seen AS DATE) AS posted FROM website")
def page_roles(spark: SparkSession, root: str) -> DataFrame:
    """The role under a heading that links nowhere else, the page's logo and date of posting."""
    facts = _facts(spark, root)
    roles = html.role_headings(facts, "url").where("href = ''")
    return roles.join(html.logos(facts, "url"), "url").join(facts.select("url", "row_id", html.posted_date(facts).alias("posted")), "url").select("row_id", "title", "logo", "posted")


APPLY = r"regexp_replace(regexp_replace(trim(apply_url), '#.*$', ''), '/+$', '')"


@query(f"SELECT row_id, {APPLY} AS route, 'Apply Link' AS method FROM website WHERE regexp_matches(apply_url, '^https?://[^\\s/?#]+/[A-Za-z0-9/_.?=&%-]*$')")
def page_routes(spark: SparkSession, root: str) -> DataFrame:
    """Where a page says to apply, for the rows whose address is written without stray characters."""
    facts = _facts(spark, root)
    clean = _web(spark, root).where(F.col("apply_url").rlike(r"^https?://[^\s/?#]+/[A-Za-z0-9/_.?=&%-]*$")).select("row_id")
    return html.apply_route(facts, "url").join(facts.select("url", "row_id"), "url").join(clean, "row_id").select("row_id", "route", "method")


@query(
    "SELECT s.source_id, CASE WHEN NOT regexp_matches(coalesce(u, ''), '(?i)^https?://[^/]+') THEN 'No address' WHEN regexp_matches(lower(u), '/login|/signin|/sign-in') THEN 'Login page' WHEN substr(source_id, -1) IN ('0', '1', '2', '3', '4') THEN 'Source unreachable' ELSE '' END AS reason, CASE WHEN regexp_matches(coalesce(u, ''), '(?i)^https?://[^/]+') AND NOT regexp_matches(lower(u), '/login|/signin|/sign-in') AND substr(source_id, -1) NOT IN ('0', '1', '2', '3', '4') THEN 1 ELSE 0 END AS jobs "
    r"FROM (SELECT source_id, regexp_replace(regexp_replace(trim(coalesce(career_url, '')), '#.*$', ''), '/+$', '') AS u FROM sources) s"
)
def scan_reports(spark: SparkSession, root: str) -> DataFrame:
    """A scan of all sources: half of them have a page, which holds one vacancy, the others cannot be reached."""
    s = load(spark, root, "sources").select("source_id", "career_url", "company_name")
    up = ~F.substring("source_id", -1, 1).isin("0", "1", "2", "3", "4") & (urls.canonical_url(F.col("career_url")) != "")
    body = F.concat(F.lit("<html><head><title>Careers</title></head><body><main><h2>Senior Architect</h2><p>Draw and build with us in the city.</p><p>"), escaped(F.col("company_name")), F.lit('</p><a href="mailto:hr@firm.example">Apply</a> We are hiring.</main></body></html>'))
    pages = s.where(up).select(urls.canonical_url(F.col("career_url")).alias("url"), body.alias("html")).groupBy("url").agg(F.min("html").alias("html"))
    _, reports = jobs.scan(s.select(F.col("source_id").alias("source"), F.col("career_url").alias("url")), html.page_facts(pages, "url", "html"), CITIES)
    return reports.select(F.col("source").alias("source_id"), "reason", "jobs")


@query("SELECT row_id, title FROM website WHERE title IS NOT NULL")
def repaired_titles(spark: SparkSession, root: str) -> DataFrame:
    """Titles read once more in Windows-1252 and repaired; what cannot be read so stays."""
    web = _web(spark, root).where("title is not null")
    wrong = F.translate(F.decode(F.encode("title", "UTF-8"), "ISO-8859-1"), repair.CONTROLS, repair.WINDOWS)
    # a title that is misread already would be repaired twice
    return web.select("row_id", F.when(repair.misread(F.col("title")), F.col("title")).otherwise(repair.repaired(wrong)).alias("title"))


OPEN_SQL = " OR ".join(f"contains(lower(coalesce(description, '')), '{p}')".replace("we're", "we''re") for p in evidence.OPEN)
CLOSED_SQL = "CASE " + " ".join(f"WHEN contains(lower(coalesce(description, '')), '{p}') THEN 'Closed signal: {p}'" for p in evidence.CLOSED) + " WHEN e < DATE '2026-06-01' THEN 'Application deadline passed: ' || strftime(e, '%Y-%m-%d') ELSE '' END"
DAY = "CAST(try_strptime(nullif(trim(application_deadline_date), ''), '%d-%m-%Y') AS DATE)"
MARKS = " + ".join(f"CAST(contains(d, '{m}') AS INT)" for m in evidence.MARKERS)
GENERIC = "(regexp_extract(src, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*([^?#]*)', 1) IN ('', '/') OR lower(regexp_extract(regexp_extract(src, '^(?:[a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*)?([^?#]*)', 1), '([^/]+)/*$', 1)) IN (" + ", ".join(f"'{p}'" for p in urls.CAREER_PATHS) + "))"


@query(
    f"WITH b AS (SELECT row_id, {sql_text(SQUASH, 'description')} AS text, {sql_text(SQUASH, 'experience')} AS x, {sql_text(SQUASH, 'tag')} AS k, {APPLY} AS route, coalesce(regexp_replace(regexp_replace(trim(c.career_url), '#.*$', ''), '/+$', ''), '') AS src, {DAY} AS e FROM website w LEFT JOIN sources c ON c.source_id = w.source_id), "
    f"m AS (SELECT *, coalesce(route, '') AS r, lower(text) AS d FROM b), n AS (SELECT *, {MARKS} AS marks, {GENERIC} AS generic FROM m), "
    "p AS (SELECT *, 4 * CAST(src <> '' AND NOT generic AS INT) + 2 * CAST(length(text) >= 120 AS INT) + CAST(length(text) >= 300 AS INT) + 2 * CAST(marks >= 1 AS INT) + CAST(marks >= 2 AS INT) + 2 * CAST(x <> '' AS INT) + CAST(k <> '' AS INT) + CAST(r <> '' AS INT) + 2 * CAST(r <> '' AND src <> '' AND r <> src AND NOT starts_with(r, 'mailto:') AS INT) + CAST(" + " OR ".join("contains(d, '{}')".format(o.replace("'", "''")) for o in evidence.OPEN) + " AS INT) AS points FROM n) "
    f"SELECT row_id, CASE WHEN r = '' THEN '{evidence.NO_ROUTE}' WHEN e >= DATE '2026-06-01' THEN '' WHEN generic AND length(text) < 100 AND x = '' AND k = '' AND marks = 0 THEN '{evidence.HEADING_ONLY}' WHEN generic AND NOT (length(text) >= 100 AND (marks >= 1 OR x <> '' OR k <> '')) THEN '{evidence.NO_DETAIL}' WHEN points < 6 THEN 'Insufficient current-vacancy evidence score ' || points ELSE '' END AS reason, CASE WHEN r = '' THEN 0 WHEN e >= DATE '2026-06-01' THEN 10 ELSE points END AS score FROM p"
)
def live_evidence(spark: SparkSession, root: str) -> DataFrame:
    """How well each row shows that its vacancy is live, beside the careers page of its source."""
    web = _web(spark, root).select("row_id", "source_id", "description", "experience", "tag", "apply_url", "application_deadline_date")
    both = web.join(load(spark, root, "sources").select("source_id", "career_url"), "source_id", "left")
    method = F.when(urls.canonical_url(F.col("apply_url")) != "", "Apply Link").otherwise("")
    found = evidence.live_evidence(F.col("description"), F.lit("HTML"), F.col("career_url"), F.col("apply_url"), method, F.col("experience"), F.col("tag"), dates.parse_date(F.col("application_deadline_date")), F.lit("2026-06-01").cast("date"))
    return both.select("row_id", found.alias("e")).select("row_id", "e.reason", "e.score")


@query(f"SELECT row_id, {CLOSED_SQL} AS closed, {OPEN_SQL} AS open FROM (SELECT row_id, description, {DAY} AS e FROM website)")
def closed_and_open(spark: SparkSession, root: str) -> DataFrame:
    d = F.col("description")
    return _web(spark, root).select("row_id", evidence.closed_reason(d, dates.parse_date(F.col("application_deadline_date")), F.lit("2026-06-01").cast("date")).alias("closed"), evidence.open_signal(d).alias("open"))


LEVEL = r"CASE WHEN regexp_matches(t, '(junior|jr\.?|fresher|entry|intern|trainee|graduate)') OR regexp_matches(d, '0\s*(?:-|to|–)\s*2\s*(?:years?|yrs?)') THEN 'Entry Level' WHEN regexp_matches(t, '(senior|sr\.?|lead|manager|head|principal|director)') OR regexp_matches(d, '(5\+|6\+|7\+|8\+|9\+|10\+)\s*(?:years?|yrs?)') THEN 'Senior Level' ELSE 'Mid Level' END"


@query(f"SELECT row_id, {LEVEL} AS level FROM (SELECT row_id, lower(coalesce(title, '')) AS t, lower(coalesce(description, '') || ' ' || coalesce(experience, '')) AS d FROM website)")
def shown_levels(spark: SparkSession, root: str) -> DataFrame:
    said = F.concat(F.coalesce("description", F.lit("")), F.lit(" "), F.coalesce("experience", F.lit("")))
    return _web(spark, root).select("row_id", statements.shown_level(F.col("title"), said).alias("level"))


SAID = "lower(" + " || '|' || ".join(f"trim(coalesce({c}, ''))" for c in ("title", "employer_name", "location", "apply_email")) + ")"


@query(f"SELECT row_id, 'text:' || sha1({SAID}) AS identity FROM website")
def identities(spark: SparkSession, root: str) -> DataFrame:
    """No board is among the hosts of the table, so identity is what a row says; numbers and boards are in the tests."""
    return _web(spark, root).select("row_id", urls.identity_key(F.col("apply_url"), F.col("title"), F.col("employer_name"), F.col("location"), F.col("apply_email")).alias("identity"))


CAREER = ", ".join(f"'{p}'" for p in urls.CAREER_PARTS)
CONTENT = ", ".join(f"'{p}'" for p in urls.CONTENT_PARTS)


@query(
    f"SELECT source_id, len(s) > 0 AND NOT list_has_any(s, [{CONTENT}]) AND NOT regexp_matches(p, 'career-growth|architect/types') AND (list_has_any(s, [{CAREER}]) OR replace(coalesce(s[-1], ''), '-', '') IN ({CAREER.replace('-', '')}) OR regexp_matches(p, '/(?:jobs?|careers?|openings?|positions?|vacanc(?:y|ies))/[^/]+')) AS careerish, regexp_matches(lower(coalesce(career_url, '')), '/login|/signin|/sign-in') AS gated "
    r"FROM (SELECT source_id, career_url, p, list_filter(string_split_regex(p, '[/_.]+'), lambda x: x <> '') AS s FROM (SELECT source_id, career_url, lower(regexp_extract(trim(coalesce(career_url, '')), '^(?:[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)?([^?#]*)', 1)) AS p FROM sources))"
)
def career_addresses(spark: SparkSession, root: str) -> DataFrame:
    u = F.col("career_url")
    return load(spark, root, "sources").select("source_id", urls.careerish(u).alias("careerish"), urls.login_gated(u).alias("gated"))


@query(r"SELECT candidate_id, list_filter([regexp_replace(regexp_replace(trim(signal_url), '#.*$', ''), '/+$', ''), CASE WHEN official_url <> signal_url THEN regexp_replace(regexp_replace(trim(official_url), '#.*$', ''), '/+$', '') END], lambda x: x IS NOT NULL)[1] AS first_url FROM candidates WHERE regexp_matches(signal_url, '^https?://[A-Za-z0-9./_?=&-]*[A-Za-z0-9/]$')")
def addresses_in_scripts(spark: SparkSession, root: str) -> DataFrame:
    """The first address in a script that writes it with escaped slashes."""
    c = load(spark, root, "candidates").where(F.col("signal_url").rlike("^https?://[A-Za-z0-9./_?=&-]*[A-Za-z0-9/]$"))
    blob = F.concat(F.lit('{"apply":"'), F.replace("signal_url", F.lit("/"), F.lit("\\/")), F.lit('","other":"'), F.coalesce("official_url", F.lit("")), F.lit('"}'))
    return c.select("candidate_id", F.get(urls.urls_in_text(blob), F.lit(0)).alias("first_url"))


@query(
    "WITH s AS (SELECT row_id, external_id, apply_url FROM website WHERE last_seen < TIMESTAMP '2026-03-01'), i AS (SELECT row_id, external_id, apply_url FROM website WHERE last_seen >= TIMESTAMP '2026-03-01'), "
    "a AS (SELECT external_id AS k, min(row_id) AS m FROM s WHERE coalesce(external_id, '') <> '' GROUP BY 1), b AS (SELECT apply_url AS k, min(row_id) AS m FROM s WHERE coalesce(apply_url, '') <> '' GROUP BY 1), "
    "f AS (SELECT i.row_id AS seq, coalesce(a.m, b.m) AS ident FROM i LEFT JOIN a ON a.k = i.external_id LEFT JOIN b ON b.k = i.apply_url) "
    "SELECT ident, min(seq) AS seq, 'update' AS action FROM f WHERE ident IS NOT NULL GROUP BY ident UNION ALL SELECT CAST(NULL AS BIGINT), seq, 'insert' FROM f WHERE ident IS NULL UNION ALL SELECT row_id, CAST(NULL AS BIGINT), 'keep' FROM s WHERE row_id NOT IN (SELECT ident FROM f WHERE ident IS NOT NULL)"
)
def merge_in_turn(spark: SparkSession, root: str) -> DataFrame:
    """Newer rows matched to older ones by their id, else by their address, and what becomes of each."""
    web, cut = _web(spark, root).select("row_id", "external_id", "apply_url", "last_seen"), F.lit("2026-03-01").cast("timestamp_ntz")
    stored, incoming = web.where(F.col("last_seen") < cut), web.where(F.col("last_seen") >= cut)
    return keyed.match_in_turn(stored, incoming, "row_id", "row_id", ["external_id", "apply_url"], F.lit(False))


@query(f"SELECT CAST(row_id AS VARCHAR) AS video_url, {sql_text(SQUASH, 'title')} AS title, {sql_text(SQUASH, 'employer_name')} AS employer_name, CASE WHEN {sql_text(SQUASH, 'location')} <> '' THEN {sql_text(SQUASH, 'location')} ELSE 'India' END AS address, {sql_text(SQUASH, 'type')} AS type, {sql_text(SQUASH, 'experience')} AS experience FROM website")
def site_rows(spark: SparkSession, root: str) -> DataFrame:
    """Collected records projected to the site; one row a record."""
    r = _web(spark, root).select(F.col("row_id"), F.col("title").alias("Job Title"), F.col("employer_name").alias("Company"), F.col("location").alias("Location"), F.col("type").alias("Job Type"), F.col("experience").alias("Experience"), F.col("description").alias("Full Description"))
    rows = website_rows(r.withColumn("Public Contact Phone", F.col("row_id").cast("string")), "2026-06-01")
    return rows.select(F.col("phone").alias("video_url"), "title", "employer_name", "address", "type", "experience")


@query("SELECT row_id, CASE " + " ".join(f"WHEN regexp_matches(t, '\\b{c}\\b') THEN '{c.title()}, {s}, India'" for c, s in sorted(CITIES.items(), key=lambda x: -len(x[0]))) + " WHEN contains(t, 'india') THEN 'India' ELSE '' END AS place FROM (SELECT row_id, lower(coalesce(location, '') || ' ' || coalesce(description, '')) AS t FROM website)")
def places_in_texts(spark: SparkSession, root: str) -> DataFrame:
    said = F.concat(F.coalesce("location", F.lit("")), F.lit(" "), F.coalesce("description", F.lit("")))
    return _web(spark, root).select("row_id", longest_city(said, CITIES).alias("place"))
