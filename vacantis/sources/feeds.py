"""Vacancies from the feeds of job boards: JSON of four systems, JSON-LD in pages, RSS, and sitemaps.

Each feed is a column of raw text beside its board; the declared schemas make Spark parse them without inference. A
document that cannot be read gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import without_tags

LEVER = "array<struct<text:string,categories:struct<location:string,commitment:string,team:string>,descriptionPlain:string,additionalPlain:string,hostedUrl:string,applyUrl:string>>"
GREENHOUSE = "struct<jobs:array<struct<title:string,location:struct<name:string>,content:string,absolute_url:string,updated_at:string>>>"
ASHBY = "struct<jobs:array<struct<title:string,location:string,isListed:boolean,descriptionPlain:string,description:string,descriptionHtml:string,compensation:string,applyUrl:string,jobUrl:string,url:string,employmentType:string,department:string,team:string,publishedAt:string,published_at:string,createdAt:string>>>"
SMART_LIST = "struct<content:array<struct<id:string,name:string,location:struct<city:string,region:string,country:string>,releasedDate:string,ref:string,typeOfEmployment:string>>>"
SMART_DETAIL = "struct<jobAd:struct<sections:map<string,struct<text:string>>>,ref:string,typeOfEmployment:struct<label:string>,releasedDate:string,createdOn:string>"
COLUMNS = ["board", "pos", "title", "location", "description", "job_type", "posted", "apply_url", "source_url", "source_type"]


def _filled(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(v), F.lit("")) for v in values], F.lit(""))


def lever_jobs(feeds: DataFrame, board: str, body: str) -> DataFrame:
    j = feeds.select(F.col(board).alias("board"), F.posexplode(F.from_json(body, LEVER)).alias("pos", "j"))
    text = F.concat_ws(" ", _filled(F.col("j.descriptionPlain")), _filled(F.col("j.additionalPlain")))
    return j.select("board", "pos", _filled(F.col("j.text")).alias("title"), _filled(F.col("j.categories.location")).alias("location"), F.trim(text).alias("description"), _filled(F.col("j.categories.commitment")).alias("job_type"), F.lit(None).cast("string").alias("posted"), _filled(F.col("j.applyUrl"), F.col("j.hostedUrl")).alias("apply_url"), _filled(F.col("j.hostedUrl")).alias("source_url"), F.lit("Lever API").alias("source_type"))


def greenhouse_jobs(feeds: DataFrame, board: str, body: str) -> DataFrame:
    j = feeds.select(F.col(board).alias("board"), F.posexplode(F.from_json(body, GREENHOUSE)["jobs"]).alias("pos", "j"))
    unescaped = F.col("j.content")  # the content is HTML escaped once more
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        unescaped = F.replace(unescaped, F.lit(entity), F.lit(char))
    return j.select("board", "pos", _filled(F.col("j.title")).alias("title"), _filled(F.col("j.location.name")).alias("location"), without_tags(unescaped).alias("description"), F.lit("").alias("job_type"), F.col("j.updated_at").alias("posted"), _filled(F.col("j.absolute_url")).alias("apply_url"), _filled(F.col("j.absolute_url")).alias("source_url"), F.lit("Greenhouse API").alias("source_type"))


def ashby_jobs(feeds: DataFrame, board: str, body: str) -> DataFrame:
    """Jobs that are not taken off the list; each field from the first of its spellings that is filled."""
    j = feeds.select(F.col(board).alias("board"), F.posexplode(F.from_json(body, ASHBY)["jobs"]).alias("pos", "j")).where(~F.col("j.isListed").eqNullSafe(False))
    text = _filled(F.col("j.descriptionPlain"), without_tags(F.col("j.descriptionHtml")), without_tags(F.col("j.description")))
    page = _filled(F.col("j.jobUrl"), F.col("j.url"))
    return j.select("board", "pos", _filled(F.col("j.title")).alias("title"), _filled(F.col("j.location")).alias("location"), text.alias("description"), _filled(F.col("j.employmentType")).alias("job_type"), F.coalesce("j.publishedAt", "j.published_at", "j.createdAt").alias("posted"), _filled(F.col("j.applyUrl"), page).alias("apply_url"), page.alias("source_url"), F.lit("Ashby API").alias("source_type"))


def smart_listing(feeds: DataFrame, board: str, body: str, most: int | None = None) -> DataFrame:
    """(board, pos, id, title, location, posted): the list of a board, at most so many of each, before any detail is read."""
    j = feeds.select(F.col(board).alias("board"), F.posexplode(F.from_json(body, SMART_LIST)["content"]).alias("pos", "j"))
    place = F.array_join(F.filter(F.array("j.location.city", "j.location.region", "j.location.country"), lambda p: p.isNotNull() & (p != "")), ", ")
    out = j.select("board", "pos", F.col("j.id").alias("id"), _filled(F.col("j.name")).alias("title"), place.alias("location"), F.col("j.releasedDate").alias("posted"))
    return out.where(F.col("pos") < most) if most is not None else out


def smart_jobs(listing: DataFrame, details: DataFrame, body: str) -> DataFrame:
    """The listed jobs with their details, joined by board and id."""
    d = details.select("board", "id", F.from_json(body, SMART_DETAIL).alias("d"))
    sections = F.transform(F.map_values("d.jobAd.sections"), lambda s: F.coalesce(s["text"], F.lit("")))
    both = listing.join(d, ["board", "id"])
    return both.select("board", "pos", "title", "location", without_tags(F.array_join(sections, " ")).alias("description"), _filled(F.col("d.typeOfEmployment.label")).alias("job_type"), F.coalesce("d.releasedDate", "d.createdOn", "posted").alias("posted"), _filled(F.col("d.ref")).alias("apply_url"), _filled(F.col("d.ref")).alias("source_url"), F.lit("SmartRecruiters API").alias("source_type"))


def jsonld_objects(facts: DataFrame, key: str) -> DataFrame:
    """(key, script, pos, object): every object of a page's JSON-LD scripts, through lists and graphs, in the order of a stack."""
    raw = facts.select(key, F.posexplode("jsonld").alias("script", "text"))
    kind = dict(facts.dtypes)[key]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for b in batches:
            rows = []
            for k, script, text in zip(b[key], b["script"], b["text"], strict=True):
                try:
                    stack = [json.loads(text)]
                except ValueError:
                    continue
                stack = list(stack[0]) if isinstance(stack[0], list) else stack
                pos = 0
                while stack:
                    item = stack.pop()
                    if isinstance(item, list):
                        stack.extend(item)
                    elif isinstance(item, dict):
                        if isinstance(item.get("@graph"), list):
                            stack.extend(item["@graph"])
                        rows.append((k, script, pos, json.dumps(item)))
                        pos += 1
            yield pd.DataFrame(rows, columns=[key, "script", "pos", "object"])

    return raw.mapInPandas(walk, f"`{key}` {kind}, script int, pos int, object string")


def jsonld_jobs(objects: DataFrame, key: str) -> DataFrame:
    """The objects that are JobPostings, as jobs; type, place and pay come in several shapes."""
    o = F.try_parse_json("object")
    get = lambda p, t="string": F.try_variant_get(F.col("v"), p, t)
    v = objects.withColumn("v", o).where(F.col("v").isNotNull())
    types = F.coalesce(F.from_json(get('$["@type"]'), "array<string>"), F.array(get('$["@type"]')))
    jobs = v.where(F.array_contains(types, "JobPosting"))
    place = F.coalesce(F.when(get("$.jobLocation[0]", "variant").isNotNull(), get("$.jobLocation[0]", "variant")), get("$.jobLocation", "variant"))
    jobs = jobs.withColumn("place", place)
    at = lambda p: F.coalesce(F.try_variant_get("place", f"$.address.{p}", "string"), F.try_variant_get("place", f"$.{p}", "string"), F.lit(""))
    country = F.coalesce(F.try_variant_get("place", "$.address.addressCountry.name", "string"), at("addressCountry"))
    span = F.concat_ws("-", get("$.baseSalary.value.minValue"), get("$.baseSalary.value.maxValue"))
    pay = F.trim(F.concat_ws(" ", get("$.baseSalary.currency"), F.coalesce(F.nullif(span, F.lit("")), get("$.baseSalary.value.value"), F.when(~get("$.baseSalary.value").startswith("{"), get("$.baseSalary.value"))), get("$.baseSalary.value.unitText")))
    return jobs.select(
        key,
        "script",
        "pos",
        F.coalesce(get("$.title"), F.lit("")).alias("title"),
        without_tags(get("$.description")).alias("description"),
        F.coalesce(get("$.hiringOrganization.name"), F.lit("")).alias("company"),
        F.array_join(F.filter(F.array(at("addressLocality"), at("addressRegion"), country), lambda p: p != ""), ", ").alias("location"),
        at("addressLocality").alias("city"),
        at("addressRegion").alias("state"),
        country.alias("country"),
        F.coalesce(get("$.employmentType"), F.lit("")).alias("job_type"),
        pay.alias("salary"),
        get("$.datePosted").alias("posted"),
        get("$.validThrough").alias("deadline"),
        F.coalesce(get("$.url"), F.lit("")).alias("apply_url"),
    )


RSS = "struct<channel:struct<item:array<struct<title:string,link:string,description:string>>>>"


def rss_hits(feeds: DataFrame, query: str, body: str, most: int) -> DataFrame:
    """(query, pos, title, url, snippet): the items of a search's RSS, at most so many of each query."""
    doc = F.from_xml(body, "struct<channel:struct<item:array<struct<title:string,link:string,description:string>>>>", {"rowTag": "rss", "mode": "PERMISSIVE"})
    items = feeds.select(F.col(query).alias("query"), F.posexplode(doc["channel"]["item"]).alias("pos", "i")).where(F.col("pos") < most)
    return items.select("query", "pos", F.trim("i.title").alias("title"), F.trim("i.link").alias("url"), without_tags(F.col("i.description")).alias("snippet"))


def sitemap_urls(maps: DataFrame, url: str, body: str) -> DataFrame:
    """(url, pos, loc): the addresses of sitemaps, which may be further sitemaps."""
    loc = F.transform(F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(r"<(?:[a-z]+:)?loc>\s*([^<]*?)\s*</"), F.lit(1)), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&")))
    return maps.select(F.col(url).alias("url"), F.posexplode(loc).alias("pos", "loc"))


def sitemap_pages(maps: DataFrame, roots: DataFrame, url: str, body: str) -> DataFrame:
    """(root, loc): pages of the sitemaps in ``roots`` (url) and of those one level below, each page once."""
    every = sitemap_urls(maps, url, body)
    top = every.join(roots.select(F.col(url).alias("url")).distinct(), "url").select(F.col("url").alias("root"), "loc")
    nested = top.where(F.col("loc").rlike(r"(?i)\.xml(?:[?#].*)?$"))
    below = nested.join(every.select(F.col("url").alias("loc"), F.col("loc").alias("page")), "loc").select("root", F.col("page").alias("loc"))
    pages = top.join(nested, ["root", "loc"], "left_anti").unionByName(below)
    return pages.where(~F.col("loc").rlike(r"(?i)\.xml(?:[?#].*)?$")).distinct()
