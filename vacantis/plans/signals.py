"""Queries on search results: which role and firm they name, how recent they are, and what reason speaks against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import titles, urls
from ..functions.standins import STAND_INS, says_nothing
from ..operators import keyed
from ..operators.reasons import first_reason, score
from ..session import load
from .addresses import CANON, DOMAIN, PATH
from .registry import query
from .texts import SQUASH, sql_text

ROLES = ("Architect", "Junior Architect", "Senior Architect", "Project Architect", "Interior Fit-Out Designer", "Landscape Designer", "BIM Modeller", "BIM Coordinator", "Town Planner", "Structural Engineer", "MEP Engineer", "Quantity Surveyor", "3D Visualiser")
_ORDERED = sorted(ROLES, key=lambda r: -len(r))
NOTHING = "(company IS NULL OR lower(regexp_replace(company, '[^\\p{L}\\p{N}\\p{M}]+', '', 'g')) = '' OR lower(regexp_replace(company, '[^\\p{L}\\p{N}\\p{M}]+', '', 'g')) IN (" + ", ".join(f"'{s}'" for s in STAND_INS) + "))"
ROLE_SQL = "CASE " + " ".join(f"WHEN contains(lower(coalesce(signal_title, '')), '{r.lower()}') THEN '{r}'" for r in _ORDERED) + " ELSE '' END"


@query(f"SELECT candidate_id, {ROLE_SQL} AS role FROM candidates")
def signal_roles(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "candidates").select("candidate_id", titles.longest_term(F.col("signal_title"), ROLES).alias("role"))


@query("SELECT candidate_id, regexp_matches(lower(coalesce(signal_title, '') || ' ' || coalesce(signal_snippet, '')), '" + "|".join(titles.RECENT) + "') AS recent FROM candidates")
def signal_recency(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "candidates").select("candidate_id", titles.is_recent(F.concat_ws(" ", F.coalesce("signal_title", F.lit("")), F.coalesce("signal_snippet", F.lit("")))).alias("recent"))


SITE_NAMES = "|".join(x.replace(".", r"\.") for x in titles.SITES)
BARE_TITLE = rf"trim(regexp_replace({sql_text(SQUASH, 'signal_title')}, '(?i)\s*[-|–—]\s*(?:{SITE_NAMES}).*$', ''))"


def _headline(part: str, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(t, '{titles.template_pattern(f'^{h}$', 'role')}') THEN regexp_extract(t, '{titles.template_pattern(f'^{h}$', part)}', 1)" for h in titles.HEADLINES) + f" ELSE {otherwise} END"


def _beside(template: str) -> str:
    before, after = titles.template_pattern(template, "firm", role="@").split("(?:@)")
    return f"nullif(regexp_extract(t, '{before}' || regexp_escape(r) || '{after}', 1), '')"


BESIDE = r"regexp_replace(regexp_replace(coalesce(" + ", ".join(_beside(x) for x in titles.BESIDE_ROLE) + r", ''), '(?i)\s+(?:jobs?|careers?|india|linkedin)$', ''), '^[ \-|]+|[ \-|]+$', '', 'g')"
SLUG = rf"regexp_replace(url_decode(coalesce(nullif(regexp_extract({PATH.format(c='signal_url')}, '(?i)/jobs/view/([^/?#]+)', 1), ''), list_filter(string_split({PATH.format(c='signal_url')}, '/'), lambda x: x <> '')[-1], '')), '(?i)[-_](?:\d{{7,}}|[a-f0-9]{{8,}}).*$', '')"
WORDY = "array_to_string(list_transform(string_split(replace({c}, '-', ' '), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')"
SOFT = "CASE WHEN {c} = lower({c}) OR contains({c}, '-') THEN " + WORDY + " ELSE {c} END"


def _soft(c: str) -> str:
    out = SOFT.format(c=f"trim(regexp_replace({c}, '[\\s\\x{{00a0}}]+', ' ', 'g'))")
    for p, r in ((r"\bBim\b", "BIM"), (r"\bCad\b", "CAD"), (r"\bAutocad\b", "AutoCAD"), (r"\bLlp\b", "LLP")):
        out = f"regexp_replace({out}, '{p}', '{r}', 'g')"
    return f"trim(regexp_replace({out}, '[\\s\\x{{00a0}}]+', ' ', 'g'))"


PARTS = r"list_filter(list_transform(string_split_regex(full_title, '\s+[-–—|]\s+'), lambda p: trim(regexp_replace(p, '(?i)\b(?:India|LinkedIn|Naukri|Indeed|Jobs?)\b', '', 'g'))), lambda p: length(p) >= 3 AND lower(p) NOT IN ('linkedin', 'jobs', 'job', 'naukri', 'indeed', 'glassdoor'))"


@query(
    f"SELECT candidate_id, {_headline('role', 't')} AS title, {_headline('firm', repr(''))} AS firm, {_soft('CASE WHEN two THEN regexp_extract(slug, ' + repr('^(.*?)-at-') + ', 1) ELSE slug END')} AS slug_title, CASE WHEN two THEN {_soft('regexp_extract(slug, ' + repr('-at-(.*)$') + ', 1)')} ELSE '' END AS slug_firm, "
    f"CASE WHEN r <> '' AND length({BESIDE}) BETWEEN 2 AND 120 THEN {BESIDE} ELSE '' END AS firm_beside_role, coalesce({PARTS}[-1], '') AS last_part "
    f"FROM (SELECT *, contains(slug, '-at-') AS two FROM (SELECT candidate_id, {BARE_TITLE} AS t, {sql_text(SQUASH, 'role')} AS r, {sql_text(SQUASH, 'signal_title')} AS full_title, {SLUG} AS slug FROM candidates))"
)
def signal_parts(spark: SparkSession, root: str) -> DataFrame:
    """Role and firm by the shapes of titles and slugs."""
    c = load(spark, root, "candidates")
    pair, slug = titles.title_and_firm(F.col("signal_title")), titles.slug_title_firm(F.col("signal_url"))
    return c.select("candidate_id", pair.alias("p"), slug.alias("s"), titles.firm_of_role(F.col("signal_title"), F.col("role")).alias("firm_beside_role"), titles.last_part(F.col("signal_title")).alias("last_part")).select(
        "candidate_id", F.col("p.title").alias("title"), F.col("p.firm").alias("firm"), F.col("s.title").alias("slug_title"), F.col("s.firm").alias("slug_firm"), "firm_beside_role", "last_part"
    )


@query(
    f"SELECT candidate_id, CASE WHEN {ROLE_SQL} = '' THEN 'no role' WHEN {NOTHING} THEN 'no company' WHEN {DOMAIN.format(c='signal_url')} = '' THEN 'no host' WHEN coalesce(city, '') = '' THEN 'no city' ELSE '' END AS reason, least(100, 30 * CAST({ROLE_SQL} <> '' AS INT) + 25 * CAST(NOT {NOTHING} AS INT) + 20 * CAST(coalesce(official_url, '') <> '' AS INT) + 15 * CAST(coalesce(apply_email, '') <> '' AS INT) + 10 * CAST(coalesce(city, '') <> '' AS INT)) AS score FROM candidates"
)
def signal_reasons(spark: SparkSession, root: str) -> DataFrame:
    """Each signal with the first reason against it, so that the rejected ones can be queried, and a score of what it has."""
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    role, firm = titles.longest_term(F.col("signal_title"), ROLES), ~says_nothing(F.col("company"))
    reason = first_reason([("no role", role == ""), ("no company", ~firm), ("no host", urls.domain(F.col("signal_url")) == ""), ("no city", ~filled("city"))])
    points = score([(30, role != ""), (25, firm), (20, filled("official_url")), (15, filled("apply_email")), (10, filled("city"))], most=100)
    return load(spark, root, "candidates").select("candidate_id", reason.alias("reason"), points.alias("score"))


@query(f"SELECT candidate_id, url, role FROM (SELECT candidate_id, u AS url, role, row_number() OVER (PARTITION BY u, role ORDER BY discovered_at, candidate_id) AS n FROM (SELECT candidate_id, {CANON.format(c='signal_url')} AS u, role, discovered_at FROM candidates)) WHERE n = 1")
def distinct_signals(spark: SparkSession, root: str) -> DataFrame:
    rows = load(spark, root, "candidates").select("candidate_id", urls.canonical_url(F.col("signal_url")).alias("url"), "role", "discovered_at")
    return keyed.first_wins(rows, ["url", "role"], [F.col("discovered_at"), F.col("candidate_id")]).select("candidate_id", "url", "role")


@query(f"SELECT r.rejected_id, c.candidate_id FROM rejected r JOIN candidates c ON {CANON.format(c='r.signal_url')} = {CANON.format(c='c.signal_url')} AND {CANON.format(c='r.signal_url')} <> ''")
def rejected_again(spark: SparkSession, root: str) -> DataFrame:
    """Rejected signals that came back as candidates, by address."""
    url = urls.canonical_url(F.col("signal_url"))
    r = load(spark, root, "rejected").select("rejected_id", url.alias("url")).where("url <> ''")
    return r.join(load(spark, root, "candidates").select("candidate_id", url.alias("url")), "url").select("rejected_id", "candidate_id")


@query(f"SELECT c.candidate_id, s.source_id FROM candidates c JOIN sources s ON regexp_replace({DOMAIN.format(c='c.signal_url')}, '^www\\.', '') = regexp_replace({DOMAIN.format(c='s.company_website')}, '^www\\.', '') AND {DOMAIN.format(c='s.company_website')} <> ''")
def candidates_of_sources(spark: SparkSession, root: str) -> DataFrame:
    host = lambda c: F.regexp_replace(urls.domain(F.col(c)), r"^www\.", "")
    s = load(spark, root, "sources").select("source_id", host("company_website").alias("host")).where("host <> ''")
    return load(spark, root, "candidates").select("candidate_id", host("signal_url").alias("host")).join(s, "host").select("candidate_id", "source_id")
