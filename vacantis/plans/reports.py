"""Summary reports over the stored tables, and the search queries that feed them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history, keyed
from ..session import load
from .registry import query


def _top(section: str, table: str, column: str, seq: str, where: str = "true") -> str:
    return f"SELECT '{section}' AS section, value AS metric, n AS value, place FROM (SELECT value, n, row_number() OVER (ORDER BY n DESC, first) AS place FROM (SELECT coalesce(nullif(trim({column}), ''), 'Blank') AS value, count(*) AS n, min({seq}) AS first FROM {table} WHERE {where} GROUP BY 1)) WHERE place <= 20"


OPEN = "status = 'publish' AND filled <> 'yes'"


@query(" UNION ALL ".join([_top("Jobs by employer", "website", "employer_name", "row_id", OPEN), _top("Jobs by category", "website", "category", "row_id", OPEN), _top("Reject reasons", "rejected", "reject_reason", "rejected_id")]))
def report_tops(spark: SparkSession, root: str) -> DataFrame:
    """The commonest employers and categories of open jobs, and the commonest reasons for rejecting."""
    web = load(spark, root, "website").where("status = 'publish' and filled <> 'yes'")
    parts = [("Jobs by employer", web, "employer_name", "row_id"), ("Jobs by category", web, "category", "row_id"), ("Reject reasons", load(spark, root, "rejected"), "reject_reason", "rejected_id")]
    out = None
    for name, df, column, seq in parts:
        part = keyed.top_counts(df, F.col(column), seq, 20).select(F.lit(name).alias("section"), F.col("value").alias("metric"), F.col("n").alias("value"), "place")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "SELECT 'Open jobs' AS metric, count(*) AS value FROM website WHERE " + OPEN + " UNION ALL SELECT 'Candidates', count(*) FROM candidates UNION ALL SELECT 'Pending review', count(*) FROM candidates WHERE coalesce(lower(trim(review_status)), '') IN ('pending review', '') UNION ALL SELECT 'Validated', count(*) FROM candidates WHERE validation_status = 'Validated' UNION ALL SELECT 'Rejected', count(*) FROM rejected UNION ALL SELECT 'Sources', count(*) FROM sources UNION ALL SELECT 'Active sources', count(*) FROM sources WHERE status = 'Active' UNION ALL SELECT 'Sources never checked', count(*) FROM sources WHERE last_checked IS NULL"
)
def report_overview(spark: SparkSession, root: str) -> DataFrame:
    """One pass of conditional counts over each table."""

    def counts(table: str, **metrics: Column) -> DataFrame:
        one = load(spark, root, table).agg(*[F.count_if(c).alias(n) for n, c in metrics.items()])
        return one.select(F.explode(F.array(*[F.struct(F.lit(n.replace("_", " ")).alias("metric"), F.col(n).alias("value")) for n in metrics])).alias("x")).select("x.*")

    every = F.lit(True)
    return (
        counts("website", Open_jobs=F.expr("status = 'publish' and filled <> 'yes'"))
        .unionByName(counts("candidates", Candidates=every, Pending_review=F.expr("coalesce(lower(trim(review_status)), '') in ('pending review', '')"), Validated=F.expr("validation_status = 'Validated'")))
        .unionByName(counts("rejected", Rejected=every))
        .unionByName(counts("sources", Sources=every, Active_sources=F.expr("status = 'Active'"), Sources_never_checked=F.expr("last_checked is null")))
    )


@query("SELECT role, company, verification_score, place FROM (SELECT role, coalesce(nullif(trim(company), ''), 'Unknown') AS company, verification_score, row_number() OVER (ORDER BY verification_score DESC, candidate_id) AS place FROM candidates) WHERE place <= 40")
def top_candidates(spark: SparkSession, root: str) -> DataFrame:
    from pyspark.sql.window import Window

    top = load(spark, root, "candidates").select("candidate_id", "role", F.coalesce(F.nullif(F.trim("company"), F.lit("")), F.lit("Unknown")).alias("company"), "verification_score").orderBy(F.desc("verification_score"), "candidate_id").limit(40)
    return top.select("role", "company", "verification_score", F.row_number().over(Window.orderBy(F.desc("verification_score"), "candidate_id")).alias("place"))


@query("SELECT source_type, status, count(*) AS n, CAST(sum(jobs_found) AS BIGINT) AS jobs, max(consecutive_failures) AS worst FROM sources GROUP BY source_type, status")
def source_counts(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "sources").groupBy("source_type", "status").agg(F.count("*").alias("n"), F.sum("jobs_found").alias("jobs"), F.max("consecutive_failures").alias("worst"))


ROLES = ("Architect", "Junior Architect", "Interior Designer", "BIM Modeller", "Town Planner")
TEMPLATES = ("{role} jobs {city}", "{role} vacancy {city} India", "hiring {role} {city}")


@query(
    "WITH r AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{r}')" for i, r in enumerate(ROLES)) + ") AS t(rp, role)), q AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{t}')" for i, t in enumerate(TEMPLATES)) + ") AS t(tp, template)), c AS (SELECT city, row_number() OVER (ORDER BY place_id) - 1 AS cp FROM ref_places) SELECT replace(replace(template, '{role}', role), '{city}', city) AS query, place FROM (SELECT *, row_number() OVER (ORDER BY rp, cp, tp) AS place FROM r, q, c) WHERE place <= 140"
)
def search_queries(spark: SparkSession, root: str) -> DataFrame:
    """Roles by cities by templates, in order, up to the budget. Roles and templates are settings and so a product of short lists."""
    from pyspark.sql.window import Window

    pairs = F.array(*[F.struct(F.lit(i).alias("rp"), F.lit(r).alias("role"), F.lit(j).alias("tp"), F.lit(t).alias("template")) for i, r in enumerate(ROLES) for j, t in enumerate(TEMPLATES)])
    every = load(spark, root, "ref_places").select("place_id", "city", F.explode(pairs).alias("p")).select("place_id", "city", "p.*")
    top = every.orderBy("rp", "place_id", "tp").limit(140)
    made = F.replace(F.replace("template", F.lit("{role}"), F.col("role")), F.lit("{city}"), F.col("city"))
    return top.select(made.alias("query"), F.row_number().over(Window.orderBy("rp", "place_id", "tp")).alias("place"))


@query("WITH c AS (SELECT city, row_number() OVER (ORDER BY place_id) - 1 AS p, count(*) OVER () AS n FROM ref_places) SELECT city FROM c WHERE ((p - (20605 * 6) % n) % n + n) % n < 6")
def cities_of_the_day(spark: SparkSession, root: str) -> DataFrame:
    """Six cities a day in turn; day 20605 counted from 1970."""
    from pyspark.sql.window import Window

    cities = load(spark, root, "ref_places").select("city", (F.row_number().over(Window.orderBy("place_id")) - 1).alias("p"))
    return history.rotation(cities, "p", 20605, 6).select("city")


@query("SELECT query, count(*) AS hits, count(DISTINCT reject_reason) AS reasons, min(rejected_at) AS first_hit FROM rejected WHERE query IS NOT NULL GROUP BY query")
def rejected_by_query(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "rejected").where("query is not null").groupBy("query").agg(F.count("*").alias("hits"), F.count_distinct("reject_reason").alias("reasons"), F.min("rejected_at").alias("first_hit"))
