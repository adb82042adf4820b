import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vacantis.functions import contacts, dates, standins, statements, text, titles, tokens, urls


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("url", "canonical", "domain"),
    [
        (" https://A.Example/Jobs/#top ", "https://A.Example/Jobs", "a.example"),
        ("http://x.example:8080/a//", "http://x.example:8080/a", "x.example"),
        ("no-scheme.example/a", "no-scheme.example/a", ""),
        ("", "", ""),
        (None, "", ""),
    ],
)
def test_canonical_and_domain(spark, url, canonical, domain):
    assert one(spark, urls.canonical_url(F.col("u")), u=url) == canonical
    assert one(spark, urls.domain(F.col("u")), u=url) == domain


@pytest.mark.parametrize(
    ("url", "clean"),
    [
        ("https://www.linkedin.com/jobs/view/architect-at-x-4412345678?trk=a", "https://in.linkedin.com/jobs/view/architect-at-x-4412345678"),
        ("https://in.indeed.com/viewjob?jk=ab12&from=x", "https://in.indeed.com/viewjob?jk=ab12"),
        ("https://www.naukri.com/job-listings-architect-1?src=y", "https://www.naukri.com/job-listings-architect-1"),
        ("https://firm.example/jobs?id=3#apply", "https://firm.example/jobs?id=3"),
    ],
)
def test_clean_apply_url(spark, url, clean):
    assert one(spark, urls.clean_apply_url(F.col("u")), u=url) == clean


@pytest.mark.parametrize(
    ("url", "provider", "ident", "board"),
    [
        ("https://jobs.lever.co/acme/123", "Lever", "acme", "https://jobs.lever.co/acme"),
        ("https://jobs.eu.lever.co/acme", "Lever", "acme", "https://jobs.eu.lever.co/acme"),
        ("https://boards.greenhouse.io/acme/jobs/1", "Greenhouse", "acme", "https://job-boards.greenhouse.io/acme"),
        ("https://acme.freshteam.com/jobs/9", "Freshteam", "acme", "https://acme.freshteam.com/jobs"),
        ("https://acme.recruitee.com", "Recruitee", "acme", "https://acme.recruitee.com"),
        ("https://acme.example/careers/", "", "", "https://acme.example/careers"),
    ],
)
def test_boards(spark, url, provider, ident, board):
    row = spark.createDataFrame([(url,)], "u string").select(urls.ats_provider(F.col("u")), urls.ats_identifier(F.col("u")), urls.ats_board_root(F.col("u"))).first()
    assert tuple(row) == (provider, ident, board)


def test_redirects_blocks_and_ids(spark):
    assert one(spark, urls.unwrap_redirect(F.col("u")), u="https://duckduckgo.com/l/?uddg=https%3A%2F%2Ffirm.example%2Fjobs%2F&x=1") == "https://firm.example/jobs"
    assert one(spark, urls.blocked_reason(F.col("u"), ["big-portal.com"]), u="https://sub.big-portal.com/a").startswith("blocked domain")
    assert one(spark, urls.blocked_reason(F.col("u"), ["big-portal.com"]), u="https://www.big-portal.com.global.ssl.fastly.net/a").startswith("mirror")
    assert one(spark, urls.blocked_reason(F.col("u"), ["big-portal.com"]), u="https://notbig-portal.com/a") == ""
    assert one(spark, urls.linkedin_job_id(F.col("u")), u="https://in.linkedin.com/jobs/view/role-at-x-4412345678") == "4412345678"
    assert one(spark, urls.is_generic_careers_url(F.col("u")), u="https://x.example/careers/") is True
    assert one(spark, urls.company_from_domain(F.col("u")), u="https://www.northlightarchitects.example/a") == "Northlight Architects"


@settings(max_examples=15, deadline=None)
@given(st.text(max_size=40))
def test_canonical_url_is_idempotent(spark, url):
    df = spark.createDataFrame([(url,)], "u string")
    once = urls.canonical_url(F.col("u"))
    a, b = df.select(once, urls.canonical_url(once)).first()
    assert a.strip().rstrip("/").rstrip() == b.strip().rstrip("/").rstrip()


def test_keys_agree_on_list_and_detail_page(spark):
    k = lambda t: one(spark, text.natural_key(F.col("c"), F.col("t"), F.col("p")), c="A & B", t=t, p="Pune")
    assert k("Junior Architect (0-2 Years of Experience)") == k("Junior Architect") == "a b|junior architect|pune"
    assert one(spark, text.natural_key(F.col("c"), F.col("t"), F.col("p")), c=None, t="", p=None) == "||"


def test_statements(spark):
    t = "CV detailing internship / work. Job type: Full time. Gender: any. B. Arch required, 3-5 years. Urgent hiring! ₹ 30,000 - 45,000 per month"
    assert one(spark, statements.employment_type(F.col("t")), t=t) == "Full Time"
    assert one(spark, statements.gender(F.col("t")), t=t) == "Both"
    assert one(spark, statements.qualification(F.col("t")), t=t) == "B.Arch"
    assert one(spark, statements.experience(F.col("t")), t=t) == "3-5 years"
    assert one(spark, statements.urgent(F.col("t")), t=t) == "yes"
    assert tuple(one(spark, statements.salary_parts(F.col("t")), t="₹ 30,000 - 45,000 per month")) == ("30000", "45000", "Monthly")
    assert tuple(one(spark, statements.salary_parts(F.col("t")), t="6.5 LPA")) == ("650000", "", "Yearly")
    assert one(spark, statements.plausible_experience(F.col("t")), t="Over 60 years since we began. Minimum 4 years of experience.").lower() == "minimum 4 years"
    for f in (statements.employment_type, statements.gender, statements.qualification, statements.experience, statements.plausible_experience, statements.salary_text):
        assert one(spark, f(F.col("t")), t=None) == ""


def test_tags_categories_levels(spark):
    assert one(spark, text.pipe_tags(F.col("t")), t="Revit, revit; 3ds Max | BIM,, ") == "Revit|3ds Max|BIM"
    assert one(spark, text.role_category(F.col("t")), t="Senior Interior Designer") == "Interior Design"
    assert one(spark, text.role_category(F.col("t")), t=None) == "Architecture / Design"
    assert one(spark, statements.career_level(F.col("t"), F.col("e")), t="Architect", e="8-12 years") == "Senior Level"
    assert one(spark, statements.career_level(F.col("t"), F.col("e")), t="Architect", e="") == ""
    assert one(spark, text.soft_title(F.col("t")), t="senior-bim-architect") == "Senior BIM Architect"


def test_main_description(spark):
    body = "We draw schools and parks with care for the people who use them. " * 3
    t = "Home About Projects Careers Contact Acme Acme " + body + "GET IN TOUCH Phone 1"
    assert one(spark, statements.main_description(F.col("d"), F.col("t"), F.col("c")), d=t, t="Architect", c="Acme") == body.strip()


def test_contacts(spark):
    assert one(spark, contacts.best_email(F.col("t")), t="press@x.in info@x.in careers@x.in CAREERS@x.in a@x.png") == "careers@x.in"
    assert one(spark, contacts.best_email(F.col("t")), t=None) == ""
    assert one(spark, contacts.phone(F.col("t")), t="call +91 (987) 654-3210") == "+919876543210"


def test_dates(spark):
    assert str(one(spark, dates.labelled_date(F.col("t"), dates.DEADLINE_LABELS), t="Deadline for Applications: 30th Sept 2023 or so")) == "2023-09-30"
    assert str(one(spark, dates.parse_date(F.col("t")), t="05-09-2026")) == "2026-09-05"
    assert str(one(spark, dates.parse_date(F.col("t"), month_first=True), t="05-09-2026")) == "2026-05-09"
    assert one(spark, dates.parse_date(F.col("t")), t="Sep 2026") is None
    assert str(one(spark, dates.rolling_expiry(F.col("t").cast("date"), F.lit("2026-06-01").cast("date"), 90), t=None)) == "2026-07-01"


def test_titles(spark):
    assert tuple(one(spark, titles.title_and_firm(F.col("t")), t="Arete Studio hiring Junior Architect in Pune, India | LinkedIn")) == ("Junior Architect", "Arete Studio")
    assert one(spark, titles.firm_of_role(F.col("t"), F.col("r")), t="Junior Architect - Arete (Studio)", r="Junior Architect") == "Arete (Studio)"
    assert tuple(one(spark, titles.slug_title_firm(F.col("u")), u="https://b.example/jobs/view/bim-modeller-at-arete-studio-4412345678")) == ("BIM Modeller", "Arete Studio")
    assert one(spark, titles.longest_city(F.col("t"), {"mumbai": "Maharashtra", "navi mumbai": "Maharashtra"}), t="Near Navi Mumbai station") == "Navi Mumbai, Maharashtra, India"
    assert one(spark, titles.title_in_snippet(F.col("t")), t="Job Title: Senior Architect - Location: Pune") == "Senior Architect"
    assert one(spark, titles.role_part(F.col("t"), F.col("c")), t="Acme Studio | Senior Architect", c="Acme Studio") == "Senior Architect"


def test_says_nothing(spark):
    for v in (None, "", "  ", "N/A", "n.a.", "--", "?", "TBA", "Not specified", "xxx", "0"):
        assert one(spark, standins.says_nothing(F.col("v")), v=v)
    for v in ("Nil Ratan Studio", "A", "Zero Architects"):
        assert not one(spark, standins.says_nothing(F.col("v")), v=v)


def test_shingles_of_a_batch():
    offsets, words = tokens.word_lists(pa.array(["One two, two THREE", None, "", "x", "a b c"]))
    assert words.to_pylist() == ["one", "two", "two", "three", "x", "a", "b", "c"] and offsets.tolist() == [0, 4, 4, 4, 5, 8]
    own, parts = tokens.shingle_sets(offsets, tokens.word_hashes(words), 3)
    assert own.tolist() == [0, 2, 2, 2, 3, 4] and len(set(parts.tolist())) == 4
    again = tokens.shingle_sets(*(lambda o, w: (o, tokens.word_hashes(w)))(*tokens.word_lists(pa.array(["a-b-c"]))), 3)[1]
    assert again[0] == parts[-1]
    assert tokens.simhashes(np_empty := own[:1], parts[:0]).tolist() == [] and np_empty is not None
