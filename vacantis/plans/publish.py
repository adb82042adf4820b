"""From collected records to rows of the site: one projection of the 31 columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, statements, text
from ..functions.text import squashed
from .tables import WEBSITE

# fixed values: the industry of a category
INDUSTRIES = {"Interior Design": "Interior Design", "Landscape Architecture": "Landscape Architecture", "Urban Design / Planning": "Urban Design / Planning", "Visualization": "Architecture Visualization"}
LOGO_PROXY = "https://wsrv.nl/"


def site_category(title: Column, stored: Column) -> Column:
    """The category that the title names, else the stored one."""
    named = text.role_category(title)
    return F.when(named != "Architecture / Design", named).when(squashed(stored) != "", squashed(stored)).otherwise("Architecture")


def sized_logo(url: Column, size: int = 500, proxy: str = LOGO_PROXY) -> Column:
    """The address of a logo in one size through an image proxy; one that goes through it already stays."""
    from ..functions.urls import canonical_url

    u, side = canonical_url(url), max(100, min(size, 1000))
    quoted = F.replace(F.replace(F.url_encode(u), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    return F.when(u == "", "").when(F.lower(u).contains("wsrv.nl/?"), u).otherwise(F.concat(F.lit(f"{proxy}?url="), quoted, F.lit(f"&w={side}&h={side}&fit=contain&cbg=00FFFFFF&output=png")))


def website_rows(records: DataFrame, as_of: str, expiry_days: int = 7, most_chars: int = 1800) -> DataFrame:
    """The rows of the site for collected records (columns as in the store of records, such as 'Job Title').

    ``most_chars`` is the length of a description on the site; the record keeps the whole text.
    """
    c = lambda name: squashed(F.col(f"`{name}`")) if name in records.columns else F.lit("")
    whole = F.when(c("Full Description") != "", c("Full Description")).otherwise(c("Short Description"))
    short = F.when(F.length(whole) > most_chars, F.concat(F.regexp_replace(F.substring(whole, 1, most_chars), r"\s\S*$", ""), F.lit("..."))).otherwise(whole)
    description = statements.main_description(short, c("Job Title"), c("Company"))
    by_mail = (F.lower(c("Application Method")) == "email") | F.lower(c("Apply URL")).startswith("mailto:")
    mail = F.when(F.lower(c("Apply URL")).startswith("mailto:"), F.trim(F.regexp_replace(c("Apply URL"), r"(?i)^mailto:|\?.*$", ""))).otherwise(c("Public Contact Email"))
    deadline = dates.parse_date(F.when(c("Application Deadline") != "", c("Application Deadline")).otherwise(c("Valid Through")))
    pay = statements.salary_parts(c("Salary"))
    country = F.when(c("Country") != "", c("Country")).otherwise("India")
    place = F.filter(F.array(c("City"), c("State"), country), lambda p: p != "")
    compact = F.array_join(F.filter(F.array(F.when(c("City") != "", c("City")).otherwise(c("State")), country), lambda p: p != ""), "|")
    category = site_category(c("Job Title"), c("Job Category"))
    cells = {
        "title": c("Job Title"),
        "description": description,
        "status": F.lit("publish"),
        "employer_author": c("Company"),
        "employer_email": c("Public Contact Email"),
        "employer_name": c("Company"),
        "expiry_date": dates.day_text(dates.rolling_expiry(deadline, F.lit(as_of).cast("date"), expiry_days)),
        "application_deadline_date": dates.day_text(deadline),
        "featured": F.lit("no"),
        "urgent": statements.urgent(F.concat_ws(" ", c("Job Title"), description)),
        "filled": F.lit("no"),
        "apply_type": F.when(by_mail, "email").otherwise("external"),
        "apply_url": F.when(by_mail, "").otherwise(c("Apply URL")),
        "apply_email": mail,
        "phone": c("Public Contact Phone"),
        "salary": pay["low"],
        "max_salary": pay["high"],
        "salary_type": pay["per"],
        "address": F.when(c("Location") != "", c("Location")).otherwise(F.array_join(place, ", ")),
        "location": compact,
        "category": category,
        "type": c("Job Type"),
        "tag": text.pipe_tags(c("Skills")),
        "experience": c("Experience"),
        "gender": statements.gender(description),
        "industry": F.coalesce(*[F.when(category == k, F.lit(v)) for k, v in INDUSTRIES.items()], F.lit("Architecture")),
        "qualification": statements.qualification(description),
        "career_level": statements.career_level(c("Job Title"), c("Experience")),
        "logo_url": sized_logo(c("Logo URL")),
    }
    return records.select(*[cells.get(name, F.lit("")).alias(name) for name in WEBSITE])
