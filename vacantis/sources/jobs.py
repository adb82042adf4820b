"""From pages to job rows: structured data first, then the page or its headings, in one set of columns.

Pages come parsed (``html.page_facts``); a scan joins sources to their page, to the pages it links, and says of every
source what was found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import contacts, dates, statements, text, titles, urls
from ..operators.keyed import cap, first_wins
from ..operators.reasons import first_reason
from ..session import materialize
from . import feeds, html

JOB = ["page", "pos", "title", "company", "location", "job_type", "experience", "salary", "skills", "description", "posted", "deadline", "apply_url", "method", "email", "phone", "source_type", "source_url", "website", "logo_url"]
# fixed values: words of a title or heading that speak of careers and name no firm
CAREER_TITLES = ("career", "jobs", "openings")
SKILLS = ("AutoCAD", "Revit", "SketchUp", "Lumion", "V-Ray", "Rhino", "Photoshop", "3ds Max", "Tekla", "QGIS")


def page_company(facts: DataFrame) -> Column:
    """The firm of a page: its site name, a short heading, the last part of its title that speaks of no careers, or its host."""
    h1, title = F.trim(F.coalesce(facts["h1"], F.lit(""))), text.squashed(facts["title"])
    career = lambda c: F.lower(c).rlike("|".join(CAREER_TITLES))
    parts = F.filter(F.split(title, titles.DASH), lambda p: (p != "") & ~career(p))
    last = F.when(title.rlike(titles.DASH), F.try_element_at(parts, F.lit(-1))).otherwise(F.nullif(title, F.lit("")))
    return html.first_filled(facts["metas"]["og:site_name"], F.when(F.length(h1).between(2, 100) & ~F.lower(h1).contains("career"), h1), F.substring(last, 1, 100), urls.company_from_domain(facts["url"]))


def clean_title(title: Column, company: Column) -> Column:
    return titles.role_part(titles.without_site(title), company)


def _common(company: Column, description: Column, cities: dict[str, str]) -> dict[str, Column]:
    return {
        "company": company,
        "location": titles.longest_city(description, cities),
        "job_type": statements.employment_type(description),
        "experience": statements.experience(description),
        "salary": statements.salary_text(description),
        "skills": text.terms_found(description, SKILLS),
        "deadline": dates.labelled_date(description, dates.DEADLINE_LABELS),
        "phone": contacts.phone(description),
    }


def page_jobs(facts: DataFrame, cities: dict[str, str], roles: str = html.ROLE.pattern) -> DataFrame:
    """One job for each page whose title or one of whose headings names a role: all that the page says."""
    company = page_company(facts)
    named = F.filter(F.transform("headings", lambda h: h["text"]), lambda t: F.lower(t).rlike(roles))
    title = clean_title(html.page_title(facts), F.lit(""))
    title = F.when(F.lower(title).rlike(roles), title).otherwise(clean_title(F.get(named, F.lit(0)), F.lit("")))
    body = F.col("main_text")
    routed = html.apply_route(facts, "url").withColumnRenamed("url", "page")
    cells = _common(company, body, cities) | {
        "title": title, "description": body, "posted": html.posted_date(facts), "source_type": F.lit("HTML"), "source_url": urls.canonical_url(F.col("url")), "website": urls.origin(F.col("url")), "pos": F.lit(0),
    }
    out = facts.select(F.col("url").alias("page"), *[c.alias(n) for n, c in cells.items()]).where("title <> ''")
    logo = html.logos(facts, "url").select(F.col("url").alias("page"), F.col("logo").alias("logo_url"))
    return out.join(routed.select("page", F.col("route").alias("apply_url"), "method", "email"), "page").join(logo, "page").select(*JOB)


def inline_jobs(facts: DataFrame, cities: dict[str, str], roles: str = html.ROLE.pattern) -> DataFrame:
    """The jobs that stand on a careers page under headings of their own: h2 to h6, the first of each title.

    A heading that links to another page is left to that page; one with hardly any text below it is none. The page's
    route for applying holds for all of them, and without one there is nobody to apply to.
    """
    heads = html.role_headings(facts, "url").join(facts.select("url", "headings"), "url")
    level = F.get(F.col("headings"), F.col("pos"))["level"]
    heads = heads.where((level >= 2) & F.lower("title").rlike(roles)).drop("headings")
    away = (F.col("href") != "") & (urls.canonical_url(F.col("href")) != urls.canonical_url(F.col("url")))
    heads = heads.where(~away & (F.length("section") >= F.length("title") + 8))
    page = facts.select("url", page_company(facts).alias("company"), html.posted_date(facts).alias("posted"), F.col("main_text"))
    routed = html.apply_route(facts, "url").where("route <> ''")
    both = heads.join(page, "url").join(routed, "url").join(html.logos(facts, "url"), "url")
    cells = _common(F.col("company"), F.col("section"), cities) | {"title": clean_title(F.col("title"), F.col("company")), "description": F.col("section"), "posted": F.col("posted")}
    cells["location"] = F.when(cells["location"] != "", cells["location"]).otherwise(titles.longest_city(F.col("main_text"), cities))
    cells |= {"pos": F.col("pos"), "apply_url": F.col("route"), "method": F.col("method"), "email": F.col("email"), "source_type": F.lit("HTML Inline"), "source_url": urls.canonical_url(F.col("url")), "website": urls.origin(F.col("url")), "logo_url": F.col("logo")}
    return both.select(F.col("url").alias("page"), *[cells[c].alias(c) for c in JOB[1:]]).where("title <> ''")


def structured_jobs(facts: DataFrame) -> DataFrame:
    """The jobs of the pages' JSON-LD in the common columns; what it leaves out is taken from the page."""
    found = feeds.jsonld_jobs(feeds.jsonld_objects(facts, "url"), "url")
    page = facts.select("url", page_company(facts).alias("named"), "main_text")
    routed = html.apply_route(facts, "url")
    j = found.join(page, "url").join(routed, "url").join(html.logos(facts, "url"), "url")
    filled = lambda a, b: F.coalesce(F.nullif(F.trim(a), F.lit("")), b)
    return j.select(
        F.col("url").alias("page"), "pos", text.squashed(F.col("title")).alias("title"), filled(F.col("company"), F.col("named")).alias("company"), "location", F.regexp_replace(F.col("job_type"), r'[\[\]"]', "").alias("job_type"),
        statements.experience(F.col("description")).alias("experience"), filled(F.col("salary"), statements.salary_text(F.col("description"))).alias("salary"), text.terms_found(F.col("description"), SKILLS).alias("skills"), "description",
        dates.parse_date(F.col("posted")).alias("posted"), dates.parse_date(F.col("deadline")).alias("deadline"), filled(urls.canonical_url(F.col("apply_url")), F.col("route")).alias("apply_url"), F.when(F.col("apply_url") != "", "Apply Link").otherwise(F.col("method")).alias("method"),
        "email", contacts.phone(F.col("main_text")).alias("phone"), F.lit("JSON-LD").alias("source_type"), urls.canonical_url(F.col("url")).alias("source_url"), urls.origin(F.col("url")).alias("website"), F.col("logo").alias("logo_url"),
    )


def jobs_of_pages(facts: DataFrame, cities: dict[str, str]) -> DataFrame:
    """The jobs of detail pages: the structured ones of a page, or else the one that its HTML describes."""
    structured = structured_jobs(facts)
    plain = facts.join(structured.select(F.col("page").alias("url")).distinct(), "url", "left_anti")
    return structured.unionByName(page_jobs(plain, cities))


def scan(sources: DataFrame, facts: DataFrame, cities: dict[str, str], blocked: tuple[str, ...] = (), roles: str = html.ROLE.pattern, most_links: int = 8) -> tuple[DataFrame, DataFrame]:
    """(jobs, reports) of careers pages. ``sources``: (source, url); ``facts``: parsed pages by url, those of the sources and those they link.

    A source is refused for its address (blocked, a login, no address), or is unreachable where no page of it was
    fetched. Else its jobs are those in its structured data, under its headings, and on the pages it links, at most
    ``most_links`` of a source. A report says of every source whether it was read, why not, and what was found.
    """
    u = F.col("url")
    refused = first_reason([("No address", ~u.rlike(r"(?i)^https?://[^/]+")), ("Login page", urls.login_gated(u))])
    asked = sources.select("source", urls.canonical_url(u).alias("url")).withColumn("refused", F.when(urls.blocked_reason(u, blocked) != "", urls.blocked_reason(u, blocked)).otherwise(refused))
    pages = facts.withColumn("url", urls.canonical_url(u))
    live = asked.where("refused = ''").select("source", "url")
    own = materialize(pages.join(live.select("url").distinct(), "url", "left_semi"), "own")  # parsed once, read often
    links = cap(first_wins(html.job_links(own, "url", roles, blocked), ["url", "link"], [F.col("pos")]).where("link <> url"), ["url"], [F.col("pos")], most_links).select("url", "link")
    detail = materialize(pages.join(links.select(F.col("link").alias("url")).distinct(), "url", "left_semi").join(own.select("url"), "url", "left_anti"), "detail")
    here = structured_jobs(own).unionByName(inline_jobs(own, cities, roles)).withColumn("root", F.col("page"))
    there = jobs_of_pages(detail, cities).join(links.select(F.col("link").alias("page"), F.col("url").alias("root")), "page").select(*JOB, "root")
    jobs = here.unionByName(there).join(live.select("source", F.col("url").alias("root")), "root").drop("root").select("source", *JOB)
    count = lambda d, key, name: d.groupBy(key).agg(F.count("*").alias(name))
    report = asked.join(own.select("url", F.lit(True).alias("read")), "url", "left").join(count(links, "url", "links"), "url", "left").join(count(html.board_links(own, "url"), "url", "boards"), "url", "left").join(count(jobs, "source", "jobs"), "source", "left")
    reason = F.when(F.col("refused") != "", F.col("refused")).when(F.col("read").isNull(), "Source unreachable").otherwise("")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return jobs, report.select("source", "url", (reason == "").alias("ok"), reason.alias("reason"), *[zero(c) for c in ("links", "boards", "jobs")])
