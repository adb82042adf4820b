"""What the text of a vacancy states: years, pay, type, degree, level, and the body of its description.

A text is read by a few small grammars, for mentions of years, for amounts and for labels with their values; each fact
is then chosen among the mentions by tables of words and preferences, which stand at the top and may be replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import contains_any, squashed

# fixed values: phrases of a footer from which a description is cut, if they stand late enough
FOOTERS = ("OPEN POSITIONS", "GET IN TOUCH", "EXPLORE OUR OFFICE CULTURE", "LEARN MORE", "FOR WORK ENQUIRIES", "FOR PRESS ENQUIRIES", "TERMS DISCLAIMER")
FOOTER_FROM = 120
# fixed values: menus that precede a description
MENUS = ("Home About Services Projects Careers Contact", "Home About Projects Careers Contact", "Home About Services Careers Contact", "About Services Projects Careers Contact")
# fixed values: the phrases that make a vacancy urgent
URGENT = ("urgent hiring", "urgently hiring", "urgent requirement", "immediate requirement", "immediate joining", "join immediately", "immediate opening")
# fixed values: degrees, in the order in which they are preferred
DEGREES = (
    "Bachelor's degree in Architecture (B.Arch)", "Bachelor's degree in Architecture", "Master's degree in Architecture (M.Arch)", "Master's degree in Architecture",
    "B.Architecture", "B.Arch", "M.Architecture", "M.Arch", "Diploma or degree in Architectural Drafting", "Diploma in Architectural Drafting", "Diploma in Architecture",
    "Bachelor's degree in Civil Engineering or equivalent", "Bachelor's degree in Civil Engineering", "Bachelor Degree in Architecture", "Bachelor Degree", "Diploma Degree",
)
# fixed values: labels of a vacancy's text, and those of them that name a degree
LABELS = ("experience", "responsibilities", "responsibility", "requirements", "requirement", "skills", "skill", "application", "job type", "location", "deadline", "how to apply")
DEGREE_LABELS = ("qualification", "education requirement", "education")
# fixed values: types of employment and their words, as stated before a noun and as stated under a label, in order
STATED_TYPES = {"Full Time": ("full time",), "Part Time": ("part time",), "Contract": ("contract", "contractual", "freelance"), "Internship": ("intern", "internship")}
LABELLED_TYPES = {"Internship": ("intern", "internship"), "Part Time": ("part time",), "Contract": ("contract", "contractual", "freelance"), "Full Time": ("full time", "permanent")}
TYPE_NOUNS = ("role", "position", "job", "opening")
# fixed values: words of a level, then the years from which a level holds
LEVEL_WORDS = {"Entry Level": ("intern", "trainee", "junior", "0-2 year", "0–2 year", "1-3 year", "1–3 year"), "Senior Level": ("senior", "lead", "principal", "associate", "director", "head")}
LEVEL_YEARS = ((7, "Senior Level"), (3, "Mid Level"), (0, "Entry Level"))
# fixed values: words for the period of a payment
PERIODS = {"Monthly": ("per month", "/month", "monthly", "p.m."), "Yearly": ("per annum", "/year", "yearly", "annual", "lpa"), "Hourly": ("per hour", "/hour", "hourly")}
# fixed values: the forms of a stated salary, the first that occurs counts
SALARIES = (
    r"(?i)₹\s?[\d,.]+\s*(?:-|–|to)\s*₹?\s?[\d,.]+(?:\s*(?:per month|/month|p\.m\.|per annum|/year|lpa))?",
    r"(?i)(?:\b(?:INR|Rs\.?)|₹)\s?[\d,.]+(?:\s*(?:LPA|per month|per annum))?",
)
#: More years than this are the age of a firm and no experience.
MOST_YEARS = 35
#: How much of the text before and after a mention of years tells what it speaks of.
BESIDE = (35, 45)
#: A value under a label is no longer than this.
MOST_VALUE = 160

#: A mention of years, with the word that may introduce it.
YEARS = r"(?i)(?:\b(?:minimum|experience|exp)\s*[:\-]?\s*)?\b\d+\s*(?:(?:-|–|to)\s*\d+|\+)?\s*(?:years?|yrs?)\b"
RANGE, PLUS, LEAST, NAMED = r"\d\s*(?:-|–|to)\s*\d", r"\d\s*\+", r"(?i)^minimum\s+\d", r"(?i)^exp"


def _first(found: Column, test: str) -> Column:
    return F.get(F.filter(found, lambda m: m.rlike(test)), F.lit(0))


def _amount(mention: Column) -> Column:
    """A mention from its first digit on, without the word that introduces it."""
    return F.nullif(F.regexp_extract(mention, r"\d.*$", 0), F.lit(""))


def experience(value: Column) -> Column:
    """The mention that says most: a range, an open range, a minimum, then years under their label; empty for bare years."""
    found = F.regexp_extract_all(F.coalesce(value, F.lit("")), F.lit(YEARS), F.lit(0))
    return squashed(F.coalesce(_amount(_first(found, RANGE)), _amount(_first(found, PLUS)), _first(found, LEAST), _first(found, NAMED)))


def years(value: Column) -> Column:
    """Every number of years that a text states."""
    return F.transform(F.regexp_extract_all(F.coalesce(value, F.lit("")), F.lit(r"(?i)\b(\d{1,2})\s*\+?\s*(?:years?|yrs?)\b"), F.lit(1)), lambda x: x.cast("int"))


def plausible_experience(value: Column) -> Column:
    """Experience that is no age of a firm: at most MOST_YEARS, and not beside 'since' unless 'experience' stands there too."""
    text, mention = squashed(value), r"(?i)(?:minimum\s+)?\d+\s*(?:(?:-|–|to)\s*\d+|\+)?\s*(?:years?|yrs?)"
    found, between = F.regexp_extract_all(text, F.lit(mention), F.lit(0)), F.split(text, mention, -1)
    before, after = BESIDE

    def fits(m: Column, i: Column) -> Column:
        beside = F.lower(F.concat(F.right(F.get(between, i), F.lit(before)), m, F.left(F.get(between, i + 1), F.lit(after))))
        return (~beside.contains("since") | beside.contains("experience")) & (F.array_max(years(m)) <= MOST_YEARS)

    kept = F.filter(found, fits)
    return F.coalesce(_amount(_first(kept, RANGE)), _first(kept, LEAST), F.get(kept, F.lit(0)), F.lit(""))


def salary_text(value: Column) -> Column:
    v = F.coalesce(value, F.lit(""))
    return squashed(F.coalesce(*[F.nullif(F.regexp_extract(v, p, 0), F.lit("")) for p in SALARIES]))


def salary_parts(value: Column) -> Column:
    """(low, high, per) of a stated salary; amounts in lakhs a year are written out."""
    t = squashed(value)
    per = F.coalesce(*[F.when(contains_any(t, words), F.lit(name)) for name, words in PERIODS.items()], F.lit(""))
    scale = F.when(contains_any(t, ("lpa",)), 100000.0).otherwise(1.0)
    numbers = F.transform(F.regexp_extract_all(t, F.lit(r"(\d+(?:,\d{2,3})*(?:\.\d+)?)"), F.lit(1)), lambda n: F.replace(n, F.lit(","), F.lit("")).try_cast("double") * scale)
    show = lambda n: F.when(n.isNull() | (n == 0), "").when(n == F.floor(n), F.floor(n).cast("string")).otherwise(F.round(n, 2).cast("string"))
    return F.struct(show(F.get(numbers, F.lit(0))).alias("low"), show(F.get(numbers, F.lit(1))).alias("high"), per.alias("per"))


def any_of(words: Iterable[str]) -> str:
    """A pattern for one of the words; a blank in a word may be written as a hyphen or left out."""
    return r"\b(?:" + "|".join(w.replace(" ", r"[-\s]?") for w in sorted(words, key=len, reverse=True)) + ")"


def labelled_values(text: Column, label: str, most: int) -> Column:
    """All values under a label in a lower-cased text, each up to the end of its statement, as one text."""
    return F.array_join(F.regexp_extract_all(text, F.lit(rf"(?:{label})\s*[:\-]?\s*([^.;|]{{1,{most}}})"), F.lit(1)), " ")


def employment_type(value: Column) -> Column:
    """Types of employment that the text states as such, before a noun or under a label, in the order of the tables."""
    t = F.lower(squashed(value))
    under = labelled_values(t, r"(?:job|employment|position)\s*type", 80)
    named = [F.when(t.rlike(any_of(ws) + r"\s+(?:" + "|".join(TYPE_NOUNS) + r")\b"), F.lit(n)) for n, ws in STATED_TYPES.items()]
    listed = [F.when(under.rlike(any_of(ws) + r"\b"), F.lit(n)) for n, ws in LABELLED_TYPES.items()]
    return F.array_join(F.array_distinct(F.array_compact(F.array(*named, *listed))), ", ")


def loosely(name: str) -> str:
    """A pattern for a name as people type it: dots and apostrophes may be left out, blanks may follow a dot."""
    escaped = name.replace("(", r"\(").replace(")", r"\)")
    return "(?i)" + escaped.replace("'", "'?").replace(" ", r"\s*" if "(" in name else " ").replace(".", r"\.?\s*")


def value_after(text: Column, labels: Iterable[str], next_labels: Iterable[str] = LABELS, most: int = MOST_VALUE) -> Column:
    """What stands behind the first of the labels, up to the next label or the end; empty if it is longer than a value."""
    behind = F.regexp_extract(text, rf"(?i)(?:{'|'.join(labels)})\s*[:\-]\s*(.*)$", 1)
    value = F.regexp_replace(F.get(F.split(behind, rf"(?i)\s(?:{'|'.join(next_labels)})(?:\s*[:\-]|\s|$)"), F.lit(0)), r"^[ \-|;,]+|[ \-|;,]+$", "")
    return F.when(F.length(value).between(3, most), value).otherwise("")


def qualification(value: Column) -> Column:
    """The first degree on the list that a text names, in its usual spelling, else what stands under a label for degrees."""
    t = squashed(value)
    named = F.coalesce(*[F.nullif(F.regexp_extract(t, loosely(d), 0), F.lit("")) for d in DEGREES])
    tidy = F.trim(F.regexp_replace(named, r"(?i)\b(b|m)\.\s*(arch\b)", "$1.$2"))
    return F.coalesce(tidy, value_after(t, DEGREE_LABELS))


def gender(value: Column) -> Column:
    """Only what is stated under that label."""
    word = F.lower(F.regexp_extract(squashed(value), r"(?i)\bgender\s*[:\-]\s*(male|female|both|any)\b", 1))
    return F.when(word.isin("both", "any"), "Both").otherwise(F.initcap(word))


def urgent(value: Column) -> Column:
    return F.when(contains_any(squashed(value), URGENT), "yes").otherwise("no")


def career_level(title: Column, stated: Column, words: Mapping[str, Iterable[str]] = LEVEL_WORDS, from_years: Iterable[tuple[int, str]] = LEVEL_YEARS) -> Column:
    """The first level one of whose words stands in title or stated experience, else by the least number stated."""
    both = F.concat_ws(" ", squashed(title), squashed(stated))
    least = F.array_min(F.transform(F.regexp_extract_all(squashed(stated), F.lit(r"\b(\d+)\b"), F.lit(1)), lambda n: n.try_cast("int")))
    return F.coalesce(*[F.when(contains_any(both, ws), F.lit(n)) for n, ws in words.items()], *[F.when(least >= y, F.lit(n)) for y, n in from_years], F.lit(""))


def main_description(value: Column, title: Column, company: Column) -> Column:
    """A description without menus, without the names it begins with, and without the footer.

    What leads is found in one match: the firm's name, a line in capitals, then the title; the footer begins at the
    first of its phrases that stands late enough.
    """
    t = squashed(value)
    for menu in MENUS:
        t = F.regexp_replace(t, f"(?i){menu}", " ")
    t = squashed(t)
    literal = lambda c: F.when(squashed(c) != "", F.concat(F.lit(r"(?i:\Q"), F.replace(squashed(c), F.lit(r"\E"), F.lit("")), F.lit(r"\E)"))).otherwise(F.lit("(?!)"))
    capitals = r"(?:[A-Z][A-Z0-9&.'’+\-\s]{5,90}(?=\s+[A-Z][a-z]))?"
    leads = F.concat(F.lit("^(?:"), literal(company), F.lit(rf"\s*)*{capitals}\s*(?:"), literal(title), F.lit(r"\s*[:\-]?\s*)?"))
    begins = F.length(t) - F.length(F.regexp_replace(t, leads, F.lit("")))
    late = F.filter(F.transform(F.array(*[F.lit(f) for f in FOOTERS]), lambda f: F.instr(F.upper(t), f) - 1), lambda p: p - begins >= FOOTER_FROM)
    ends = F.coalesce(F.array_min(late), F.length(t))
    return F.regexp_replace(F.trim(F.substring(t, begins + 1, ends - begins)), r"^[ \-|]+|[ \-|]+$", "")


# fixed values: words of a title, and years of a description, that show a level; the first that fits
SHOWN_LEVELS = (
    ("Entry Level", "title", r"(junior|jr\.?|fresher|entry|intern|trainee|graduate)"),
    ("Entry Level", "text", r"0\s*(?:-|to|–)\s*2\s*(?:years?|yrs?)"),
    ("Senior Level", "title", r"(senior|sr\.?|lead|manager|head|principal|director)"),
    ("Senior Level", "text", r"(5\+|6\+|7\+|8\+|9\+|10\+)\s*(?:years?|yrs?)"),
)
OTHER_LEVEL = "Mid Level"


def shown_level(title: Column, description: Column) -> Column:
    """A level for every vacancy, by SHOWN_LEVELS."""
    cells = {"title": F.lower(squashed(title)), "text": F.lower(squashed(description))}
    return F.coalesce(*[F.when(cells[c].rlike(p), F.lit(level)) for level, c, p in SHOWN_LEVELS], F.lit(OTHER_LEVEL))
