"""Keeping collected records: from jobs to records, checks against live pages, exports and searches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, evidence, text, urls
from ..functions.text import squashed
from ..sources.html import first_filled, posted_date
from .reasons import first_reason

# fixed values: columns of a stored record and the field of a job that each takes
RECORD = {
    "Job Title": "title", "Company": "company", "Location": "location", "Job Type": "job_type", "Experience": "experience", "Salary": "salary", "Skills": "skills", "Full Description": "description", "Posted Date": "posted",
    "Application Deadline": "deadline", "Application Method": "method", "Source Type": "source_type", "Source URL": "source_url", "Apply URL": "apply_url", "Company Website": "website", "Logo URL": "logo_url",
    "Public Contact Email": "email", "Public Contact Phone": "phone",
}
SHORT = 500
# fixed values: search pages of job boards; a word or place is written with hyphens, with plus signs, or encoded
BOARD_SEARCHES = (
    "https://www.naukri.com/{role-}-jobs-in-{city-}",
    "https://in.indeed.com/jobs?q={role+}&l={city+}&fromage=14",
    "https://www.linkedin.com/jobs/search?keywords={role}&location={city}%2C%20India",
    "https://www.timesjobs.com/candidate/job-search.html?searchType=personalizedSearch&txtKeywords={role}&txtLocation={city}",
)
# fixed values: words of a title that do not tell whether its page still shows it
COMMON_WORDS = ("career", "careers", "designs", "architecture")


def records_of_jobs(jobs: DataFrame, seen_at: Column, stored: DataFrame | None = None) -> DataFrame:
    """Jobs as stored records: text fields as they are, dates written out, ids from the natural key; the first time of a known fingerprint stays."""
    show = lambda c: F.date_format(c, "yyyy-MM-dd") if dict(jobs.dtypes)[c] == "date" else F.col(c)
    key = text.natural_key(F.col("company"), F.col("title"), F.col("location"))
    cells = [F.coalesce(show(field), F.lit("")).alias(name) for name, field in RECORD.items() if field in jobs.columns]
    made = jobs.select(text.fingerprint(key).alias("Fingerprint"), *cells)
    made = made.withColumn("Job ID", text.job_id(F.col("Fingerprint"))).withColumn("Short Description", F.substring("Full Description", 1, SHORT)).withColumn("Job Category", text.role_category(F.col("Job Title")))
    made = made.withColumn("Last Seen", seen_at).withColumn("Status", F.lit("Active")).withColumn("Application Status", F.lit("Open")).withColumn("Closed Reason", F.lit(""))
    if stored is None:
        return made.withColumn("First Seen", seen_at)
    known = stored.groupBy("Fingerprint").agg(F.min("First Seen").alias("__first"))
    return made.join(known, "Fingerprint", "left").withColumn("First Seen", F.coalesce("__first", F.col("Last Seen"))).drop("__first")


def external_id(job: Column, print_: Column) -> Column:
    """The id of a record outside: from its own id, else from its fingerprint."""
    return F.concat(F.lit("JOB-"), F.upper(F.coalesce(F.nullif(squashed(job), F.lit("")), text.job_id(print_))))


def hit_details(hits: DataFrame, facts: DataFrame) -> DataFrame:
    """Hits with the title and text of their page where it was fetched: what its metadata say, then the page, then the hit, then the address.

    ``hits``: (query, url, title, snippet); pages by address.
    """
    u = urls.canonical_url(F.col("url"))
    meta = lambda *names: first_filled(*[F.col("metas")[n] for n in names])
    page = facts.select(u.alias("__url"), first_filled(meta("og:title", "twitter:title"), F.col("title")).alias("__title"), first_filled(meta("og:description", "description", "twitter:description"), F.substring("all_text", 1, 700)).alias("__text"))
    page = page.groupBy("__url").agg(F.max("__title").alias("__title"), F.max("__text").alias("__text"))
    slug = urls.slug_words(F.col("url"))
    named = F.concat(slug["title"], F.when(slug["firm"] != "", F.concat(F.lit(" at "), slug["firm"])).otherwise(F.lit("")))
    both = hits.withColumn("__url", u).join(page, "__url", "left")
    return both.select("query", F.col("__url").alias("url"), first_filled(F.col("__title"), squashed(F.col("title")), named).alias("title"), first_filled(F.col("__text"), squashed(F.col("snippet"))).alias("snippet"))


def revalidated(records: DataFrame, facts: DataFrame, as_of: Column, cutoff: Column) -> DataFrame:
    """(id, open, reason) of stored records beside the page where they say to apply, or their source for those by mail.

    ``records``: (id, title, description, experience, skills, source_type, source_url, apply_url, method, posted, deadline).
    What the record says comes first, then whether its page can be read, then what that page says.
    """
    source, route = urls.canonical_url(F.col("source_url")), urls.canonical_url(F.col("apply_url"))
    mailed = F.lower(route).startswith("mailto:")
    asked = F.when(mailed, source).when(route != "", route).otherwise(source)
    f = facts.select(urls.canonical_url(F.col("url")).alias("__asked"), F.col("main_text").alias("page"), posted_date(facts).alias("page_posted"), dates.labelled_date(facts["main_text"], dates.DEADLINE_LABELS).alias("page_deadline"))
    f = f.groupBy("__asked").agg(F.max(F.struct("page", "page_posted", "page_deadline")).alias("f")).select("__asked", "f.*")
    both = records.withColumn("__asked", asked).join(f, "__asked", "left")
    until, seen = F.coalesce("page_deadline", "deadline"), F.col("page").isNotNull()
    found = evidence.live_evidence(F.col("description"), F.col("source_type"), F.col("source_url"), F.col("apply_url"), F.col("method"), F.col("experience"), F.col("skills"), until, as_of)
    both = both.withColumn("ev", found).withColumn("closed", evidence.closed_reason(F.col("page"), until, as_of))
    words = F.slice(F.filter(F.split(text.natural_title(F.col("title")), " "), lambda w: (F.length(w) >= 4) & ~w.isin(*COMMON_WORDS)), 1, 3)
    gone = (F.col("__asked") == urls.canonical_url(F.col("source_url"))) & (F.size(words) > 0) & ~F.forall(words, lambda w: F.lower("page").contains(w))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    said = lambda prefix, c: F.concat(F.lit(prefix), c)
    reason = (
        F.when(F.col("posted") < cutoff, said("Posted before cutoff ", day(cutoff)))
        .when(F.col("deadline") < as_of, said("Application deadline passed: ", day("deadline")))
        .when((route == "") & (source == ""), "No application/source URL")
        .when(mailed & (source == ""), "")
        .when(urls.login_gated(F.col("__asked")), "Blocked or login-gated application URL")
        .when(~seen, "Application page is no longer publicly reachable")
        .when(F.col("page_posted") < cutoff, said("Posted before cutoff ", day(cutoff)))
        .when(F.col("closed") != "", F.col("closed"))
        .when(F.coalesce("posted", "page_posted").isNull() & ~F.col("ev")["strong"], F.col("ev")["reason"])
        .when(gone, "Role title is no longer visible on the source page")
        .otherwise("")
    )
    return both.select("id", (reason == "").alias("open"), reason.alias("reason"))


def close_rows(records: DataFrame, rules: list[tuple[str, Column]], status: str = "Status") -> DataFrame:
    """Records of which the active ones with a reason against them are closed with it; the others stay."""
    why = F.when(F.lower(F.coalesce(F.col(status), F.lit(""))) == "active", first_reason(rules)).otherwise("")
    new = {status: F.when(why != "", "Closed").otherwise(F.col(status)), "Closed Reason": F.when(why != "", why).otherwise(F.col("Closed Reason"))}
    return records.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in records.columns])


def board_search_pages(pairs: DataFrame, role: str, city: str, order: list[Column], most: int, templates: Iterable[str] = BOARD_SEARCHES) -> DataFrame:
    """(role, city, url): the search pages of the boards for pairs of a role and a place, in order, up to the budget."""

    def filled(template: str) -> Column:
        out = F.lit(template)
        for name, c in (("role", F.col(role)), ("city", F.col(city))):
            encoded = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
            for mark, value in ((f"{{{name}-}}", F.replace(F.lower(c), F.lit(" "), F.lit("-"))), (f"{{{name}+}}", F.url_encode(F.replace(c, F.lit(" "), F.lit("+")))), (f"{{{name}}}", encoded)):
                out = F.replace(out, F.lit(mark), value)
        return out

    every = pairs.select(role, city, F.struct(*order).alias("__order"), F.posexplode(F.array(*[filled(t) for t in templates])).alias("__n", "url"))
    return every.orderBy("__order", "__n").limit(most).select(role, city, "url")
