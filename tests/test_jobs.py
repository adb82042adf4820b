from pyspark.sql import functions as F

from vacantis.functions import evidence, repair, statements, text, urls
from vacantis.sources import cards, html, jobs

CITIES = {"pune": "Maharashtra", "goa": "Goa"}
CAREERS = """<html><head><title>Careers | Acme Studio</title></head><body><main><h1>Careers at Acme</h1>
<h2>Junior Architect</h2><p>You draw schools in Pune. 2-4 years of experience, Revit. Apply by 30 June 2026.</p>
<h2>Site Engineer <a href="/jobs/2">more</a></h2><p>Elsewhere.</p><h3>Contact</h3>
<p><a href="/jobs/2">Site Engineer</a> <a href="/login?x">Sign in</a></p><a href="mailto:careers@acme.example">Apply now by mail</a> We are hiring.</main></body></html>"""
DETAIL = """<html><head><title>Site Engineer | Acme Studio</title><meta property="og:site_name" content="Acme Studio"></head><body><main><h1>Site Engineer</h1>
<p>Build in Goa, full time role. Minimum 3 years. Rs. 40,000 per month</p><a href="/apply/2">Apply now</a></main></body></html>"""
LD = """<html><body><script type="application/ld+json">{"@type":"JobPosting","title":"Planner","hiringOrganization":{"name":"Bee"},"description":"Plan","datePosted":"2026-02-01","url":"https://bee.example/j/1"}</script><h1>Planner</h1></body></html>"""


def facts(spark, pages):
    return html.page_facts(spark.createDataFrame(pages, "url string, body string"), "url", "body")


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]


def test_scan(spark):
    f = facts(spark, [("https://acme.example/careers", CAREERS), ("https://acme.example/jobs/2", DETAIL), ("https://bee.example/careers", LD)])
    rows = [("A", "https://acme.example/careers/"), ("B", "https://bee.example/careers"), ("C", "https://gone.example/careers"), ("D", "https://x.example/login"), ("E", "https://sub.portal.example/jobs"), ("F", None), ("G", "")]
    found, reports = jobs.scan(spark.createDataFrame(rows, "source string, url string"), f, CITIES, blocked=("portal.example",))
    got = {(r["source"], r["title"]): r for r in found.collect()}
    assert set(got) == {("A", "Junior Architect"), ("A", "Site Engineer"), ("B", "Planner")}
    inline, detail, ld = got["A", "Junior Architect"], got["A", "Site Engineer"], got["B", "Planner"]
    assert (inline["location"], inline["experience"], inline["skills"], str(inline["deadline"]), inline["method"], inline["email"]) == ("Pune, Maharashtra, India", "2-4 years", "Revit", "2026-06-30", "Email", "careers@acme.example")
    assert (detail["company"], detail["apply_url"], detail["job_type"], detail["experience"], detail["source_type"]) == ("Acme Studio", "https://acme.example/apply/2", "Full Time", "Minimum 3 years", "HTML")
    assert (ld["company"], str(ld["posted"]), ld["apply_url"], ld["source_type"]) == ("Bee", "2026-02-01", "https://bee.example/j/1", "JSON-LD")
    said = {r["source"]: (r["ok"], r["reason"], r["links"], r["jobs"]) for r in reports.collect()}
    assert said["A"] == (True, "", 1, 2) and said["B"][0] and said["C"] == (False, "Source unreachable", 0, 0) and said["D"][1] == "Login page" and said["E"][1].startswith("blocked") and said["F"][1] == said["G"][1] == "No address"
    nothing, none = jobs.scan(spark.createDataFrame(rows[:1], "source string, url string"), f.limit(0), CITIES)
    assert nothing.count() == 0 and none.first()["reason"] == "Source unreachable"


def test_result_cards(spark):
    bing = '<ol><li class="b_algo x"><h2><a href="https://a.example/1">A &amp; B</a></h2><div><p>Some <b>words</b></p></div></li><li class="b_algo"><p>no link</p></li></ol>'
    duck = '<div class="result"><a class="result__a" href="https://duckduckgo.com/l/?uddg=https%3A%2F%2Fb.example%2F2">B</a><br><div class="result__snippet">S</div></div>'
    df = spark.createDataFrame([("q", bing, duck), ("n", None, "<div>")], "query string, bing string, duck string")
    assert [tuple(r) for r in cards.result_cards(df, "query", "bing", "Bing").collect()] == [("q", 0, "A & B", "https://a.example/1", "Some words")]
    assert [tuple(r) for r in cards.result_cards(df, "query", "duck", "DuckDuckGo").collect()] == [("q", 0, "B", "https://b.example/2", "S")]


def test_repair(spark):
    for good in ("Café – “Å”", "plain", "Ünïcode 東京 🙂"):
        once = good.encode().decode("cp1252", "replace")
        assert one(spark, repair.repaired(F.col("t")), t=good) == good
        if "�" not in once:
            assert one(spark, repair.repaired(F.col("t")), t=once) == good
    assert one(spark, repair.repaired(F.col("t")), t="CafÃƒÂ©") == "Café"
    assert one(spark, repair.repaired(F.col("t")), t=None) is None
    assert one(spark, repair.repaired(F.col("t")), t="é " * 50_000).startswith("é é")


def test_evidence_and_freshness(spark):
    rows = [
        (1, "Architect", "HTML", "https://a.example/careers", "", "", "", "", None, None, ""),
        (2, "Architect", "HTML", "https://a.example/careers", "https://a.example/careers", "Apply Link", "", "", None, None, "apply now"),
        (3, "Requirements: experience with schools. " * 5, "HTML", "https://a.example/jobs/3", "https://a.example/apply/3", "Apply Link", "2 years", "Revit", None, None, "apply now"),
        (4, "x", "HTML", "https://a.example/careers", "https://a.example/careers", "Apply Link", "", "", "2026-07-01", None, "apply now"),
        (5, "x", "HTML", "https://a.example/careers", "https://a.example/careers", "Apply Link", "", "", "2026-05-01", None, "apply now"),
        (6, "x", "HTML", "", "u", "", "", "", None, "2026-05-20", ""),
        (7, "x", "HTML", "", "u", "", "", "", None, "2025-05-20", "Position filled"),
        (8, "x", "HTML", "", "u", "", "", "", None, "2025-05-20", ""),
    ]
    df = spark.createDataFrame(rows, "id int, d string, t string, s string, u string, m string, e string, k string, deadline string, posted string, page string")
    day, as_of = (lambda c: F.col(c).cast("date")), F.lit("2026-06-01").cast("date")
    ev = evidence.live_evidence(F.col("d"), F.col("t"), F.col("s"), F.col("u"), F.col("m"), F.col("e"), F.col("k"), day("deadline"), as_of)
    df = df.withColumn("ev", ev)
    df = df.withColumn("f", evidence.freshness(day("posted"), day("deadline"), F.col("page"), F.col("ev"), F.lit("2026-01-01").cast("date"), as_of))
    got = {r["id"]: (r["ev"]["strong"], r["f"]["accepted"], r["f"]["label"].split(" (")[0], r["f"]["reason"].split(":")[0]) for r in df.collect()}
    assert got[1] == (False, False, "Unverified", evidence.NO_ROUTE) and got[2][:3] == (False, False, "Unverified") and got[3] == (True, True, "Live Verified", "")
    assert got[4][1:3] == (True, "Live Verified") and got[5][2:] == ("Closed", "Application deadline passed") and got[6][1:] == (True, "Fresh", "") and got[7][3] == "Closed signal" and got[8][2] == "Stale"


def test_addresses(spark):
    u = F.col("u")
    assert [one(spark, urls.careerish(u), u=f"https://a.example{p}") for p in ("/careers.html", "/join-us/", "/blog/careers", "/", "/jobs/7", "/about", "/career-growth/transcript")] == [True, True, False, False, True, False, False]
    assert one(spark, urls.login_gated(u), u="https://a.example/Sign-In?x") and not one(spark, urls.login_gated(u), u=None)
    assert one(spark, urls.urls_in_text(u), u='x="https:\\/\\/jobs.lever.co\\/acme" y=https%3A%2F%2Fb.example%2F1 https://b.example/1.') == ["https://jobs.lever.co/acme", "https://b.example/1"]
    assert tuple(one(spark, urls.slug_words(u), u="https://n.example/job-listings-senior-architect-interior-site-lead-acme-design-pune-2-years-12345")) == ("Senior Architect Interior Site Lead", "Acme Design")
    key = lambda v: one(spark, urls.identity_key(F.col("u"), F.col("t"), F.col("c"), F.col("p"), F.col("e")), u=v, t="T", c="C", p=None, e="")
    assert key("https://in.linkedin.com/jobs/view/x-4412345678") == "linkedin:4412345678" and key("https://www.naukri.com/A/?q=1") == "board:www.naukri.com:/a:" and key(None).startswith("text:") and key(None) == key("https://a.example")
    anchors = spark.createDataFrame([("https://a.example/about", [("https://a.example/team", "Work with us"), ("https://a.example/p", "Projects")])], "u string, a array<struct<href:string,text:string>>")
    assert anchors.select(urls.career_candidates(u, F.col("a"), ("work with us",), 3)).first()[0] == ["https://a.example/team", "https://a.example/careers", "https://a.example/career"]
    assert [one(spark, statements.shown_level(F.col("t"), F.col("d")), t=t, d=d) for t, d in (("Jr. Architect", ""), ("Architect", "0 - 2 years"), ("Lead", ""), ("Architect", "8+ yrs"), (None, None))] == ["Entry Level", "Entry Level", "Senior Level", "Senior Level", "Mid Level"]


def test_cleaned(spark):
    for dirty, clean in (("<p>CafÃ© &amp; bar&nbsp;&ndash; 5&euro;</p>", "Café & bar – 5€"), ("a  b", "a b"), (None, ""), ("", ""), ("x &lt; y", "x < y")):
        assert one(spark, text.cleaned(F.col("t")), t=dirty) == clean
    assert spark.createDataFrame([(["<b>A</b>", "", None, "B "],)], "v array<string>").select(text.cleaned_list(F.col("v"))).first()[0] == "A, B"
