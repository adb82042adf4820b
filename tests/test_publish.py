import http.server
import threading

import pytest
from pyspark.sql import functions as F

from vacantis.operators import keyed
from vacantis.plans import publish
from vacantis.plans.tables import WEBSITE
from vacantis.settings import load_settings
from vacantis.sources import html, pages, tables

RECORD = {
    "Job Title": "Senior Architect", "Company": "Example Architects", "Location": "Mumbai, Maharashtra, India", "City": "Mumbai", "State": "Maharashtra", "Country": "India", "Job Category": "Architecture",
    "Job Type": "Full Time", "Experience": "7-10 years", "Salary": "₹80000 - ₹120000 per month", "Skills": "AutoCAD, Revit, Rhino", "Full Description": "Qualification: Bachelor's degree in Architecture (B.Arch). Senior Architect role.",
    "Application Deadline": "2026-10-31", "Application Method": "External", "Apply URL": "https://example.com/jobs/senior-architect", "Public Contact Email": "careers@example.com", "Logo URL": "https://example.com/logo.svg",
}


def test_website_row(spark):
    df = spark.createDataFrame([tuple(RECORD.values())], ", ".join(f"`{k}` string" for k in RECORD))
    r = publish.website_rows(df, as_of="2026-09-01").first()
    assert list(r.asDict()) == WEBSITE
    want = {
        "external_id": "", "status": "publish", "location": "Mumbai|India", "tag": "AutoCAD|Revit|Rhino", "salary": "80000", "max_salary": "120000", "salary_type": "Monthly", "application_deadline_date": "31-10-2026",
        "expiry_date": "31-10-2026", "career_level": "Senior Level", "qualification": "Bachelor's degree in Architecture (B.Arch)", "apply_type": "external", "industry": "Architecture",
        "logo_url": "https://wsrv.nl/?url=https%3A%2F%2Fexample.com%2Flogo.svg&w=500&h=500&fit=contain&cbg=00FFFFFF&output=png",
    }
    assert {k: r[k] for k in want} == want


def test_bare_record_rolls_its_expiry(spark):
    r = publish.website_rows(spark.createDataFrame([("Artist", None)], "`Job Title` string, `Apply URL` string"), as_of="2026-09-01").first()
    assert (r["expiry_date"], r["application_deadline_date"], r["location"], r["logo_url"]) == ("08-09-2026", "", "India", "")
    r = publish.website_rows(spark.createDataFrame([("Artist", "mailto:jobs@x.in?subject=a")], "`Job Title` string, `Apply URL` string"), as_of="2026-09-01").first()
    assert (r["apply_type"], r["apply_url"], r["apply_email"]) == ("email", "", "jobs@x.in")


def test_match_in_turn(spark):
    stored = spark.createDataFrame([(1, "f1", "k1", "Active"), (2, "f2", "k2", "Closed"), (3, "f3", "k2", "Active"), (4, "f4", "k2", "Active"), (5, "f5", "", "Active")], "id int, fp string, nk string, status string")
    incoming = spark.createDataFrame([(10, "f1", "kx"), (11, "new", "k2"), (12, "none", "k9"), (13, "", "")], "seq int, fp string, nk string")
    got = {tuple(r) for r in keyed.match_in_turn(stored, incoming, "id", "seq", ["fp", "nk"], F.col("status") == "Active").collect()}
    assert got == {(1, 10, "update"), (3, 11, "update"), (None, 12, "insert"), (None, 13, "insert"), (4, None, "close"), (2, None, "keep"), (5, None, "keep")}


def test_first_provider(spark):
    hits = spark.createDataFrame([("q", 1, "a"), ("q", 0, "b"), ("r", 1, "c")], "query string, rank int, url string")
    assert {r["url"] for r in keyed.first_provider(hits, "query", "rank").collect()} == {"b", "c"}


PAGE = """<html><head><meta http-equiv="refresh" content="0; url=https://jobs.lever.co/acme/1"><meta property="article:published_time" content="2026-02-03T10:00:00Z"></head>
<body><p>We are hiring</p><p><a href="/jobs/architect">Architect</a></p><p><a href="/jobs/architect#x">Architect</a></p><p><a href="/about">About</a></p><p><a href="https://boards.greenhouse.io/acme">Jobs</a></p>
<p><a href="mailto:hr@acme.example">mail</a></p><p><a href="/apply/1">Apply now</a></p></body></html>"""


def test_links_boards_routes_dates(spark):
    f = html.page_facts(spark.createDataFrame([("https://acme.example/", PAGE)], "url string, body string"), "url", "body")
    assert [r["link"] for r in html.job_links(f, "url", "architect|planner").collect()] == ["https://acme.example/jobs/architect"]
    assert {(r["provider"], r["board"]) for r in html.board_links(f, "url").collect()} == {("Lever", "https://jobs.lever.co/acme"), ("Greenhouse", "https://job-boards.greenhouse.io/acme")}
    route = html.apply_route(f, "url").first()
    assert (route["route"], route["method"], route["email"]) == ("https://acme.example/apply/1", "Apply Link", "hr@acme.example")
    assert str(f.select(html.posted_date(f)).first()[0]) == "2026-02-03"


def test_fetch(spark):
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            self.send_response(200 if self.path == "/ok" else 404)
            self.end_headers()
            self.wfile.write("<p>é</p>".encode())

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    rows = [(f"{base}/ok",), (f"{base}/gone",), ("http://127.0.0.1:1/",), ("mailto:x",), (None,), ("https://portal.example/a",)]
    got = {r["url"]: (r["status"], r["body"], r["error"]) for r in pages.fetch_pages(spark.createDataFrame(rows, "u string"), "u", blocked=("portal.example",), timeout=3).collect()}
    server.shutdown()
    assert got[f"{base}/ok"] == (200, "<p>é</p>", None) and got[f"{base}/gone"][0] == 404 and got["http://127.0.0.1:1/"][2] and len(got) == 3


def test_store(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    schema = spark.createDataFrame([], "a string, b int").schema
    assert store.read("t", schema).count() == 0
    store.overwrite("t", spark.createDataFrame([("x", "more")], "a string, c string"))
    assert store.read("t", schema).first().asDict() == {"a": "x", "c": "more", "b": None}
    store.overwrite("t", store.read("t", schema).withColumn("b", F.lit(2)), ["b", "a"])
    store.append("t", spark.createDataFrame([(3, "y")], "b int, a string"))
    assert sorted(tuple(r) for r in store.read("t", schema).select("b", "a").collect()) == [(2, "x"), (3, "y")]
    assert store.drop(["t", "u"], keep=("t",)) == [] and store.drop(["t", "u"]) == ["t"] and not store.exists("t")


def test_settings(tmp_path):
    p = tmp_path / "s.yaml"
    p.write_text("a: 1\nb: x\na: 2\n")
    s = load_settings(str(p), {"c": 3})
    assert dict(s) == {"a": 2, "b": "x", "c": 3}
    with pytest.raises(ValueError, match="missing"):
        load_settings(str(p), required=("d",))
