"""Texts of vacancies as Column expressions: cleaning, categories, keys and tags."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: categories and the words of a title that stand for them, in the order in which they are tried
ROLE_CATEGORIES = {
    "BIM": ("bim", "revit"),
    "Landscape Architecture": ("landscape architect",),
    "Urban Design / Planning": ("urban designer", "urban planner", "urban design", "urban planning"),
    "Interior Design": ("interior architect", "interior designer", "interior design"),
    "Visualization": ("3d visualizer", "3d visualiser", "visualizer", "visualiser", "visualisation", "visualization", "3d render artist", "render artist", "rendering artist", "architectural renderer", "architectural rendering"),
    "Architecture": ("architect", "architecture", "architectural"),
}
# fixed values: categories from a whole text, another order than by title
TEXT_CATEGORIES = {
    "BIM": ("bim", "revit"),
    "Visualization": ("visualizer", "visualiser", "3d render", "3d artist", "3ds max", "lumion", "v-ray"),
    "Interior Design": ("interior",),
    "Landscape Architecture": ("landscape",),
    "Urban Design": ("urban",),
    "Drafting": ("draft", "autocad"),
}

def squashed(value: Column) -> Column:
    """Runs of blanks become one, ends are trimmed, null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), r"[\s\x{00a0}]+", " "))


def without_tags(value: Column) -> Column:
    """Text of a fragment of HTML: tags become blanks, the usual entities their characters."""
    t = F.regexp_replace(F.coalesce(value, F.lit("")), r"(?s)<!--.*?-->|<[A-Za-z/!][^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return squashed(t)


# fixed values: further entities of HTML that stand in feeds and snippets
ENTITIES = {"&apos;": "'", "&ndash;": "–", "&mdash;": "—", "&hellip;": "…", "&rsquo;": "’", "&lsquo;": "‘", "&ldquo;": "“", "&rdquo;": "”", "&bull;": "•", "&middot;": "·", "&copy;": "©", "&reg;": "®", "&euro;": "€", "&pound;": "£", "&eacute;": "é"}


def cleaned(value: Column) -> Column:
    """Text of a fragment as it was meant: a wrong encoding is repaired, tags go, entities become their characters, blanks are squashed; null becomes empty."""
    from .repair import repaired

    t = repaired(F.coalesce(value, F.lit("")))
    for entity, char in ENTITIES.items():
        t = F.replace(t, F.lit(entity), F.lit(char))
    return repaired(without_tags(t))


def cleaned_list(values: Column) -> Column:
    """The cleaned texts of an array, joined by commas; empty ones are left out."""
    return F.array_join(F.filter(F.transform(values, cleaned), lambda t: t != ""), ", ")


def contains_any(value: Column, terms: Iterable[str]) -> Column:
    """The lower-cased value contains one of the terms."""
    out = F.lit(False)
    low = F.lower(F.coalesce(value, F.lit("")))
    for t in terms:
        out = out | low.contains(t.lower())
    return out


def count_terms(value: Column, terms: Iterable[str]) -> Column:
    """How many of the terms the lower-cased value contains."""
    low = F.lower(F.coalesce(value, F.lit("")))
    return sum((low.contains(t.lower()).cast("int") for t in terms), F.lit(0))


def first_category(value: Column, rules: dict[str, tuple[str, ...]], default: str) -> Column:
    return F.coalesce(*[F.when(contains_any(value, terms), F.lit(name)) for name, terms in rules.items()], F.lit(default))


def role_category(title: Column) -> Column:
    return first_category(title, ROLE_CATEGORIES, "Architecture / Design")


def text_category(title: Column, description: Column) -> Column:
    return first_category(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit(""))), TEXT_CATEGORIES, "Architecture")


def terms_found(value: Column, terms: Iterable[str]) -> Column:
    """The terms that the value contains, in the order of the list, joined by commas."""
    low = F.lower(F.coalesce(value, F.lit("")))
    return F.array_join(F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: low.contains(F.lower(t))), ", ")


def natural_words(value: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(squashed(value)), r"[^a-z0-9]+", " "))


def natural_title(value: Column) -> Column:
    """A title without what it says of experience, so that list and detail page agree."""
    mention = r"(?:minimum\s+)?\d+\s*(?:(?:-|–|to)\s*\d+|\+)?\s*(?:years?|yrs?)"
    said = rf"\([^)]*{mention}[^)]*\)|\b{mention}\b|\bof\s+experience\b"
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(squashed(value)), said, " "), r"[^a-z0-9+]+", " "))


def natural_key(company: Column, title: Column, city: Column) -> Column:
    return F.concat_ws("|", natural_words(company), natural_title(title), natural_words(city))


def fingerprint(key: Column) -> Column:
    return F.substring(F.sha2(key, 256), 1, 24)


def job_id(print_: Column) -> Column:
    return F.substring(F.sha1(print_), 1, 16)


def stable_id(prefix: str, *parts: Column) -> Column:
    """An id from the parts in lower case; null parts are left out, empty ones are not."""
    joined = F.concat_ws("|", *[F.lower(F.trim(p)) for p in parts])
    return F.concat(F.lit(f"{prefix}-"), F.upper(F.substring(F.sha1(joined), 1, 14)))


def pipe_tags(value: Column) -> Column:
    """Tags split at commas, semicolons and bars, joined by bars; the first of each spelling stays."""
    items = F.filter(F.transform(F.split(squashed(value), r"[,;|]+"), lambda t: F.trim(t)), lambda t: t != "")
    first = F.filter(items, lambda t, i: F.array_position(F.transform(items, F.lower), F.lower(t)) == i + 1)
    return F.array_join(first, "|")


def soft_title(value: Column) -> Column:
    """Title case for what is all lower case or a slug; known abbreviations keep their form."""
    t = squashed(value)
    t = F.when((t == F.lower(t)) | t.contains("-"), F.initcap(F.replace(t, F.lit("-"), F.lit(" ")))).otherwise(t)
    for p, r in ((r"\bBim\b", "BIM"), (r"\bCad\b", "CAD"), (r"\bAutocad\b", "AutoCAD"), (r"\bLlp\b", "LLP")):
        t = F.regexp_replace(t, p, r)
    return squashed(t)
