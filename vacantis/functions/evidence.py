"""Whether a vacancy is open: what closes it, what shows that it is live, and how fresh that makes it.

The words and points are tables; a caller may give others. Nothing is dropped here: every function adds a column that
says what was found, and plans decide what to keep.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.reasons import first_reason, score
from .text import contains_any, count_terms, squashed
from .urls import canonical_url, is_generic_careers_url, let

# fixed values: phrases of a page whose vacancy is closed, and of one that is open
CLOSED = (
    "applications closed", "application closed", "no longer accepting applications", "no longer available", "position has been filled", "position filled", "position closed", "vacancy closed",
    "job closed", "this job has expired", "job has expired", "job expired", "posting has expired", "opportunity has closed", "recruitment closed",
)
OPEN = (
    "apply now", "apply for this job", "submit application", "submit your application", "current opening", "current openings", "open position", "open positions", "we are hiring", "we're hiring",
    "join our team", "send your cv", "send cv", "send your resume",
)
# fixed values: words of a description that speak of one vacancy
MARKERS = (
    "experience", "qualification", "qualifications", "requirements", "responsibilities", "responsibility", "skills", "skill", "b.arch", "bachelor", "degree", "diploma", "portfolio",
    "proficient", "proficiency", "years", "yrs", "job type", "location", "role", "duties",
)
# fixed values: kinds of source whose records are structured
STRUCTURED = ("json", "api", "ats", "lever", "greenhouse")
# fixed values: points of evidence for a vacancy without a date, and the least that will do
POINTS = {"structured": 5, "own page": 4, "120 letters": 2, "300 letters": 1, "a marker": 2, "two markers": 1, "experience": 2, "skills": 1, "form": 2, "mail": 1, "link": 1, "other address": 2, "open": 1}
LEAST_SCORE, LEAST_LETTERS = 6, 100
NO_ROUTE = "Undated vacancy has no public application route"
HEADING_ONLY = "Insufficient evidence of current vacancy: generic careers-page heading only"
NO_DETAIL = "Insufficient role-specific details for undated careers-page vacancy"


def closed_reason(text: Column, deadline: Column, as_of: Column, phrases: Iterable[str] = CLOSED) -> Column:
    """Why a page is closed: the first phrase on the list that it has, or a deadline before ``as_of``; empty if it is not."""
    said = [(f"Closed signal: {p}", contains_any(text, (p,))) for p in phrases]
    passed = F.when(deadline < as_of, F.concat(F.lit("Application deadline passed: "), F.date_format(deadline, "yyyy-MM-dd")))
    return F.coalesce(F.nullif(first_reason(said), F.lit("")), passed, F.lit(""))


def open_signal(text: Column, phrases: Iterable[str] = OPEN) -> Column:
    return contains_any(text, phrases)


def live_evidence(description: Column, source_type: Column, source_url: Column, apply_url: Column, method: Column, experience: Column, skills: Column, deadline: Column, as_of: Column) -> Column:
    """(strong, reason, score): how well a vacancy without a date shows that it is one and live."""
    text, source, route = squashed(description), canonical_url(source_url), canonical_url(apply_url)
    # what is used more than once is computed once, as the fields of a struct that a lambda reads
    base = F.struct(
        F.length(text).alias("size"), count_terms(text, MARKERS).alias("markers"), is_generic_careers_url(source).alias("generic"), contains_any(source_type, STRUCTURED).alias("structured"),
        ((route != "") | (squashed(method) != "")).alias("routed"), (squashed(experience) != "").alias("experience"), (squashed(skills) != "").alias("skills"), open_signal(text).alias("open"),
        (source != "").alias("sourced"), ((route != "") & (source != "") & (route != source) & ~route.startswith("mailto:")).alias("other"), F.coalesce(method, F.lit("")).alias("method"), F.coalesce(deadline >= as_of, F.lit(False)).alias("future"),
    )

    def points(b: Column) -> Column:
        found = {
            "structured": b["structured"], "own page": b["sourced"] & ~b["generic"], "120 letters": b["size"] >= 120, "300 letters": b["size"] >= 300, "a marker": b["markers"] >= 1, "two markers": b["markers"] >= 2,
            "experience": b["experience"], "skills": b["skills"], "form": b["method"] == "Public Form", "mail": b["method"] == "Email", "link": b["method"] == "Apply Link", "other address": b["other"], "open": b["open"],
        }
        return F.struct(b.alias("b"), score([(POINTS[k], c) for k, c in found.items()]).alias("points"))

    def decided(p: Column) -> Column:
        b = p["b"]
        said = b["experience"] | b["skills"]
        weak = b["generic"] & (b["size"] < LEAST_LETTERS) & ~said & (b["markers"] == 0)
        bare = b["generic"] & ~b["structured"] & ~((b["size"] >= LEAST_LETTERS) & ((b["markers"] >= 1) | said))
        low = F.concat(F.lit("Insufficient current-vacancy evidence score "), p["points"].cast("string"))
        reason = F.when(~b["routed"], NO_ROUTE).when(b["future"], "").when(weak, HEADING_ONLY).when(bare, NO_DETAIL).when(p["points"] < LEAST_SCORE, low).otherwise("")
        return F.struct(reason.alias("reason"), F.when(~b["routed"], 0).when(b["future"], 10).otherwise(p["points"]).alias("score"))

    return let(let(let(base, points), decided), lambda r: F.struct((r["reason"] == "").alias("strong"), r["reason"].alias("reason"), r["score"].alias("score")))


def freshness(posted: Column, deadline: Column, page_text: Column, evidence: Column, cutoff: Column, as_of: Column) -> Column:
    """(accepted, label, reason): closed before stale, stale before fresh; a date to come is no date; without one the evidence counts."""
    closed = closed_reason(page_text, deadline, as_of)
    dated = posted.isNotNull() & (posted <= as_of)
    stale, live = dated & (posted < cutoff), evidence["strong"] & open_signal(page_text)
    label = F.when(closed != "", "Closed").when(stale, "Stale").when(dated, "Fresh").when(live, F.concat(F.lit("Live Verified (No Posted Date, Score "), evidence["score"].cast("string"), F.lit(")"))).otherwise("Unverified")
    old = F.concat(F.lit("Posted before cutoff "), F.date_format(cutoff, "yyyy-MM-dd"))
    why = F.when(closed != "", closed).when(stale, old).when(dated | live, "").when(~evidence["strong"], evidence["reason"]).otherwise("No acceptable posted date and insufficient live-opening evidence")
    return F.struct((closed == "").__and__(F.coalesce(dated & ~stale | ~dated & live, F.lit(False))).alias("accepted"), label.alias("label"), why.alias("reason"))
