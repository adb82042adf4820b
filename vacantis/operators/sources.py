"""The registry of sources: what scans report of them, how known firms are found behind boards, and what is searched for.

Every operator joins or projects whole tables; rules and words come in as tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from .keyed import cap, first_wins
from .reasons import score


def with_reports(sources: DataFrame, reports: DataFrame, checked_at: Column, disable_after: int = 8) -> DataFrame:
    """Sources with the health that the reports on their address give; sources without a report stay as they are.

    ``sources`` has career_url, status, jobs_found, consecutive_failures, last_checked, last_success and quality_reason;
    ``reports``: (url, ok, refused, reason, jobs), where ``refused`` says that the source is no source at all. Of several
    reports on an address the last by ok, then by reason counts; addresses compare in canonical form.
    """
    key = urls.canonical_url(F.col("career_url"))
    last = reports.select(urls.canonical_url(F.col("url")).alias("__key"), F.struct("ok", "reason", "refused", "jobs").alias("r")).where("__key <> ''").groupBy("__key").agg(F.max("r").alias("r"))
    both = sources.withColumn("__key", key).join(last, "__key", "left")
    seen, ok, refused = F.col("r").isNotNull(), F.col("r.ok"), F.col("r.refused")
    failures = F.coalesce(F.col("consecutive_failures"), F.lit(0)) + 1
    said = lambda c: F.nullif(F.trim(c), F.lit(""))
    new = {
        "last_checked": F.when(seen, checked_at).otherwise(F.col("last_checked")),
        "last_success": F.when(ok, checked_at).otherwise(F.col("last_success")),
        "jobs_found": F.when(ok, F.col("r.jobs").cast("int")).when(refused, 0).otherwise(F.col("jobs_found")),
        "consecutive_failures": F.when(ok | refused, 0).when(seen, failures).otherwise(F.col("consecutive_failures")),
        "status": F.when(ok, "Active").when(refused, "Rejected").when(seen, F.when(failures >= disable_after, "Inactive").otherwise("Warning")).otherwise(F.col("status")),
        "quality_reason": F.when(ok, F.coalesce(said(F.col("quality_reason")), F.lit("Checked successfully"))).when(seen, F.coalesce(said(F.col("r.reason")), said(F.col("quality_reason")), F.lit("Temporary source check failure"))).otherwise(F.col("quality_reason")),
    }
    return both.select(*[new.get(c, F.col(c)).alias(c) for c in sources.columns])


def reject(sources: DataFrame, reasons: DataFrame, key: str) -> DataFrame:
    """Sources with the reason against them in ``reasons`` (key, reason); those become Rejected, the others stay."""
    one = reasons.where("reason <> ''").groupBy(key).agg(F.min("reason").alias("__reason"))
    both = sources.join(one, key, "left")
    new = {"status": F.when(F.col("__reason").isNotNull(), "Rejected").otherwise(F.col("status")), "quality_reason": F.coalesce("__reason", "quality_reason")}
    return both.select(*[new.get(c, F.col(c)).alias(c) for c in sources.columns])


def firm_tokens(company: Column, website: Column) -> Column:
    """The names under which a firm may stand in a result: its own, and the one its host says; each once, blanks left out."""
    names = F.filter(F.array(F.trim(F.coalesce(company, F.lit(""))), urls.company_from_domain(website)), lambda n: n != "")
    return F.filter(names, lambda n, i: F.array_position(F.transform(names, F.lower), F.lower(n)) == i + 1)


def names_firm(text: Column, tokens: Column, least: int = 5) -> Column:
    """The text holds one of the names as typed, or run together if it has so many letters."""
    low = F.lower(F.coalesce(text, F.lit("")))
    run = lambda c: F.regexp_replace(F.lower(c), r"[^a-z0-9]", "")
    return F.exists(tokens, lambda t: low.contains(F.lower(t)) | ((F.length(run(t)) >= least) & run(low).contains(run(t))))


def boards_of_firms(results: DataFrame, firms: DataFrame, query: str) -> DataFrame:
    """(query, provider, board, identifier): the boards among the results of a query that name the firm it was asked for.

    ``results``: (query, url, title, snippet); ``firms``: (query, company, website). One row a board of a query.
    """
    u = urls.canonical_url(F.col("url"))
    found = results.select(query, u.alias("url"), F.concat_ws(" ", "title", "snippet", "url").alias("text")).withColumn("provider", urls.ats_provider(F.col("url"))).where("provider <> ''")
    both = found.join(firms.select(query, firm_tokens(F.col("company"), F.col("website")).alias("tokens")), query).where(names_firm(F.col("text"), F.col("tokens")))
    board = urls.ats_board_root(F.col("url"))
    return both.select(query, "provider", board.alias("board")).distinct().withColumn("identifier", urls.ats_identifier(F.col("board")))


def queries_of(df: DataFrame, key: str, templates: Iterable[tuple[str, tuple[str, ...]]], most: int) -> DataFrame:
    """(key, place, query): each template with its columns filled in, for the rows where none of them is blank; at most so many of a row, in order."""
    made = []
    for template, columns in templates:
        out, there = F.lit(template), F.lit(True)
        for c in columns:
            out = F.replace(out, F.lit(f"{{{c}}}"), F.coalesce(F.col(c), F.lit("")))
            there = there & (F.trim(F.coalesce(F.col(c), F.lit(""))) != "")
        made.append(F.when(there, out))
    asked = F.slice(F.array_compact(F.array(*made)), 1, most)
    return df.select(key, F.posexplode(asked).alias("place", "query"))


def official_pages(hits: DataFrame, key: str, blocked: Iterable[str], most: int = 2) -> DataFrame:
    """(key, pos, url): of each row's hits the first careers pages on no blocked host, each address once."""
    u = urls.canonical_url(F.col("url"))
    fit = hits.select(key, "pos", u.alias("url")).where((F.col("url") != "") & urls.careerish(F.col("url")) & (urls.blocked_reason(F.col("url"), blocked) == ""))
    return cap(first_wins(fit, [key, "url"], [F.col("pos")]), [key], [F.col("pos")], most)


def weighted(text: Column, words: Mapping[str, int]) -> Column:
    """The sum of the weights of the words and phrases that stand in the text as words, each once."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return score([(n, low.rlike(rf"(?<![\p{{L}}\p{{N}}]){w}(?![\p{{L}}\p{{N}}])")) for w, n in words.items()])


def quality(reasons: list[tuple[str, Column]], scores: Mapping[str, Column], least: Mapping[str, int]) -> Column:
    """(accepted, reason, scores): a reason against comes first, then the first score below its least."""
    from .reasons import first_reason

    low = [(f"{name} below {least[name]}", scores[name] < least[name]) for name in least]
    why = first_reason([*reasons, *low])
    return F.struct((why == "").alias("accepted"), why.alias("reason"), *[c.alias(n) for n, c in scores.items()])
