"""Queries on addresses: canonical forms, parts, boards, blocked hosts, and who holds an address first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import keyed
from ..operators.reasons import first_reason
from ..session import load
from .registry import query

CANON = "regexp_replace(regexp_replace(trim(coalesce({c}, '')), '#.*$', ''), '/+$', '')"
DOMAIN = "lower(regexp_extract(trim(coalesce({c}, '')), '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/?#:]*)', 1))"
PATH = "regexp_extract(trim(coalesce({c}, '')), '^(?:[a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*)?([^?#]*)', 1)"
# fixed values: the hosts that the block-list query tries, all of the test domain
BLOCKED = ("vilibhechi.example", "dunideva.example", "mejajojo.example")


@query(f"SELECT rejected_id, {CANON.format(c='signal_url')} AS url FROM rejected")
def url_canonical(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "rejected").select("rejected_id", urls.canonical_url(F.col("signal_url")).alias("url"))


@query(f"SELECT row_id, {DOMAIN.format(c='apply_url')} AS domain, regexp_extract(trim(coalesce(apply_url, '')), '^([a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]+)', 1) AS origin, {PATH.format(c='apply_url')} AS path FROM website")
def url_parts(spark: SparkSession, root: str) -> DataFrame:
    u = F.col("apply_url")
    return load(spark, root, "website").select("row_id", urls.domain(u).alias("domain"), urls.origin(u).alias("origin"), urls.path(u).alias("path"))


@query("SELECT rejected_id, coalesce(url_decode(regexp_extract(trim(coalesce(signal_url, '')), '[?&]position=([^&#]*)', 1)), '') AS position, coalesce(url_decode(regexp_extract(trim(coalesce(signal_url, '')), '[?&]ref=([^&#]*)', 1)), '') AS ref FROM rejected")
def url_query_values(spark: SparkSession, root: str) -> DataFrame:
    u = F.col("signal_url")
    return load(spark, root, "rejected").select("rejected_id", urls.query_value(u, "position").alias("position"), urls.query_value(u, "ref").alias("ref"))


@query(f"SELECT source_id, 'SRC-' || upper(substr(sha1(lower({CANON.format(c='career_url')})), 1, 12)) AS made_id FROM sources")
def source_id_hash(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "sources").select("source_id", urls.source_id(F.col("career_url")).alias("made_id"))


@query(f"SELECT url, min(row_id) AS first_row, count(*) AS n FROM (SELECT row_id, {CANON.format(c='apply_url')} AS url FROM website) WHERE url <> '' GROUP BY url")
def url_first_wins(spark: SparkSession, root: str) -> DataFrame:
    rows = load(spark, root, "website").select("row_id", urls.canonical_url(F.col("apply_url")).alias("url")).where("url <> ''")
    return rows.groupBy("url").agg(F.min("row_id").alias("first_row"), F.count("*").alias("n"))


@query(f"SELECT domain AS value, n, place FROM (SELECT domain, n, row_number() OVER (ORDER BY n DESC, first) AS place FROM (SELECT coalesce(nullif({DOMAIN.format(c='apply_url')}, ''), 'Blank') AS domain, count(*) AS n, min(row_id) AS first FROM website GROUP BY 1)) WHERE place <= 20")
def domain_top20(spark: SparkSession, root: str) -> DataFrame:
    return keyed.top_counts(load(spark, root, "website"), urls.domain(F.col("apply_url")), "row_id", 20)


@query(f"SELECT candidate_id, CASE {' '.join(f'''WHEN d = '{n}' OR d LIKE '%.{n}' THEN 'blocked domain: {n}' ''' for n in sorted(BLOCKED))} ELSE '' END AS reason FROM (SELECT candidate_id, {DOMAIN.format(c='signal_url')} AS d FROM candidates)")
def blocked_domains(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "candidates").select("candidate_id", urls.blocked_reason(F.col("signal_url"), BLOCKED).alias("reason"))


@query(f"SELECT source_id, lower(list_extract(string_split({PATH.format(c='career_url')}, '/'), -1)) AS tail, (trim({PATH.format(c='career_url')}, '/') = '' OR lower(regexp_extract({PATH.format(c='career_url')}, '([^/]+)/*$', 1)) IN ({', '.join(repr(p) for p in urls.CAREER_PATHS)})) AS generic FROM sources")
def generic_careers_pages(spark: SparkSession, root: str) -> DataFrame:
    u = F.col("career_url")
    return load(spark, root, "sources").select("source_id", F.lower(F.element_at(F.split(urls.path(u), "/"), -1)).alias("tail"), urls.is_generic_careers_url(u).alias("generic"))


@query(f"SELECT rejected_id, CASE WHEN trim(coalesce(signal_url, '')) = '' THEN 'no address' WHEN d = '' THEN 'no host' WHEN p IN ('', '/') THEN 'no page' WHEN signal_url LIKE '%?%' THEN 'tracked' ELSE '' END AS reason FROM (SELECT rejected_id, signal_url, {DOMAIN.format(c='signal_url')} AS d, {PATH.format(c='signal_url')} AS p FROM rejected)")
def address_reasons(spark: SparkSession, root: str) -> DataFrame:
    u = F.col("signal_url")
    rules = [("no address", F.trim(F.coalesce(u, F.lit(""))) == ""), ("no host", urls.domain(u) == ""), ("no page", urls.path(u).isin("", "/")), ("tracked", u.contains("?"))]
    return load(spark, root, "rejected").select("rejected_id", first_reason(rules).alias("reason"))


@query(f"SELECT row_id, {CANON.format(c='apply_url')} AS apply_url FROM website WHERE apply_url IS NOT NULL")
def clean_apply_urls(spark: SparkSession, root: str) -> DataFrame:
    """No board is among the test hosts, so cleaning leaves the canonical form; boards are checked in the tests."""
    return load(spark, root, "website").where("apply_url is not null").select("row_id", urls.clean_apply_url(F.col("apply_url")).alias("apply_url"))


def _suffixed(name: str, suffixes: tuple[str, ...]) -> str:
    for x in suffixes:
        name = f"regexp_replace({name}, '([a-z0-9]){x}$', '\\1 {x}')"
    return name


LABEL = r"regexp_replace(regexp_extract(regexp_replace({d}, '^(?:www|careers|jobs)\.', ''), '^([^.]*)', 1), '[-_]+', ' ', 'g')"
CAPITALS = "array_to_string(list_transform(string_split({c}, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')"


@query(f"SELECT source_id, '' AS provider, '' AS identifier, {CANON.format(c='career_url')} AS board, {CAPITALS.format(c='trim(' + _suffixed(LABEL.format(d=DOMAIN.format(c='career_url')), urls.NAME_PARTS) + ')')} AS company FROM sources")
def boards_of_sources(spark: SparkSession, root: str) -> DataFrame:
    """No source of the table keeps a board, so each stays its own; ``board_addresses`` has one of every system."""
    u = F.col("career_url")
    return load(spark, root, "sources").select("source_id", urls.ats_provider(u).alias("provider"), urls.ats_identifier(u).alias("identifier"), urls.ats_board_root(u).alias("board"), urls.company_from_domain(u).alias("company"))
