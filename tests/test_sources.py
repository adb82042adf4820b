import json

from pyspark.sql import functions as F

from vacantis.sources import feeds, html

PAGE = """<html><head><title>Careers | Acme</title><meta property="og:title" content="Work at Acme"><link rel="icon" href="/f.ico">
<script type="application/ld+json">{"@graph":[{"@type":["JobPosting"],"title":"Architect","description":"<p>Draw &amp; build</p>","hiringOrganization":{"name":"Acme"},
"jobLocation":[{"address":{"addressLocality":"Pune","addressRegion":"MH","addressCountry":{"name":"India"}}}],"baseSalary":{"currency":"INR","value":{"minValue":10,"maxValue":20,"unitText":"MONTH"}},"datePosted":"2026-01-02"}]}</script>
<script type="application/ld+json">{broken</script></head><body><header><img src="/img/logo.svg" alt="Acme"></header><main>
<h1>Join us</h1><h2>Junior Architect</h2><p>You draw.</p><p>You draw.</p><h3>Requirements</h3><p>Two years</p>
<h2>Site Engineer</h2><p>You build. <a href="jobs/2">Details</a></p><form></form><p>Footer</p></main><script>var x = "hidden";</script></body></html>"""


def facts(spark, rows=(("https://acme.example/careers", PAGE), ("https://empty.example", ""), (None, None))):
    return html.page_facts(spark.createDataFrame(list(rows), "url string, body string"), "url", "body")


def test_page_facts(spark):
    f = facts(spark).where("url = 'https://acme.example/careers'")
    r = f.select(html.page_title(f).alias("t"), "title", "has_form", "main_text").first()
    assert (r["t"], r["title"], r["has_form"]) == ("Join us", "Careers | Acme", True) and "hidden" not in r["main_text"]
    roles = {x["title"]: x["section"] for x in html.role_headings(f, "url").collect()}
    assert roles == {"Junior Architect": "Junior Architect You draw. Requirements Two years", "Site Engineer": "Site Engineer You build. Details"}
    assert [(x["href"], x["text"]) for x in html.links(f, "url").collect()] == [("https://acme.example/jobs/2", "Details")]
    assert html.logos(f, "url").first()["logo"] == "https://acme.example/img/logo.svg"


def test_empty_pages_have_empty_facts(spark):
    assert facts(spark).count() == 3
    assert html.role_headings(facts(spark).where("url is null or url like '%empty%'"), "url").count() == 0


def test_jsonld(spark):
    objects = feeds.jsonld_objects(facts(spark), "url")
    job = feeds.jsonld_jobs(objects, "url").collect()
    assert len(job) == 1
    j = job[0]
    assert (j["title"], j["description"], j["company"], j["location"], j["salary"], j["posted"]) == ("Architect", "Draw & build", "Acme", "Pune, MH, India", "INR 10-20 MONTH", "2026-01-02")


def test_board_feeds(spark):
    bodies = {
        "lever": [{"text": "Architect", "categories": {"location": "Pune", "commitment": "Full-time"}, "descriptionPlain": "A", "additionalPlain": "B", "hostedUrl": "https://h/1", "applyUrl": ""}],
        "greenhouse": {"jobs": [{"title": "Planner", "location": {"name": "Goa"}, "content": "&lt;p&gt;Plan&lt;/p&gt;", "absolute_url": "https://g/1", "updated_at": "2026-01-01"}]},
        "ashby": {"jobs": [{"title": "BIM", "isListed": False}, {"title": "Artist", "descriptionHtml": "<b>x</b>", "jobUrl": "https://a/1", "createdAt": "2026-02-02"}]},
    }
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in bodies.items()] + [("bad", "{"), ("none", None)], "board string, body string")
    lever = feeds.lever_jobs(df.where("board in ('lever', 'bad', 'none')"), "board", "body").collect()
    assert [(r["title"], r["description"], r["apply_url"], r["posted"]) for r in lever] == [("Architect", "A B", "https://h/1", None)]
    assert [(r["title"], r["description"], r["posted"]) for r in feeds.greenhouse_jobs(df.where("board in ('greenhouse', 'bad')"), "board", "body").collect()] == [("Planner", "Plan", "2026-01-01")]
    assert [(r["title"], r["description"], r["apply_url"]) for r in feeds.ashby_jobs(df.where("board in ('ashby', 'none')"), "board", "body").collect()] == [("Artist", "x", "https://a/1")]


def test_smartrecruiters(spark):
    listing = json.dumps({"content": [{"id": "1", "name": "Architect", "location": {"city": "Pune", "country": "in"}}, {"id": "2", "name": "Cook"}]})
    detail = json.dumps({"jobAd": {"sections": {"a": {"text": "<p>Draw</p>"}, "b": {"text": "Build"}}}, "ref": "https://s/1", "typeOfEmployment": {"label": "Full"}})
    listed = feeds.smart_listing(spark.createDataFrame([("acme", listing)], "board string, body string"), "board", "body", most=1)
    jobs = feeds.smart_jobs(listed, spark.createDataFrame([("acme", "1", detail)], "board string, id string, body string"), "body").collect()
    assert [(r["title"], r["location"], r["description"], r["job_type"]) for r in jobs] == [("Architect", "Pune, in", "Draw Build", "Full")]


def test_rss_and_sitemaps(spark):
    rss = "<rss><channel><item><title>A</title><link>https://x/1</link><description>&lt;b&gt;s&lt;/b&gt;</description></item><item><title>B</title><link>https://x/2</link></item></channel></rss>"
    hits = feeds.rss_hits(spark.createDataFrame([("q", rss), ("bad", "<rss"), ("none", None)], "query string, body string"), "query", "body", 1).collect()
    assert [(r["query"], r["title"], r["url"], r["snippet"]) for r in hits] == [("q", "A", "https://x/1", "s")]
    maps = spark.createDataFrame([("r", "<urlset><url><loc> https://x/a?b=1&amp;c=2 </loc></url><sitemap><loc>https://x/n.xml</loc></sitemap></urlset>"), ("https://x/n.xml", "<u><loc>https://x/deep</loc><loc>https://x/m.xml</loc></u>")], "url string, body string")
    got = {r["loc"] for r in feeds.sitemap_pages(maps, maps.where("url = 'r'").select("url"), "url", "body").collect()}
    assert got == {"https://x/a?b=1&c=2", "https://x/deep"}
    assert feeds.sitemap_pages(maps.limit(0), maps.select("url"), "url", "body").count() == 0


def test_words_beside_links_and_times_count_wherever_they_stand(spark):
    filler = "We draw and build. " * 40
    page = f'<body><div>{filler}<a href="/openings/1">Details</a> for an architect</div><p>{filler}<a href="/go/apply">Here</a> you can apply</p><p>{filler} Posted on <time datetime="2026-01-05">Monday</time></p></body>'
    f = facts(spark, [("https://acme.example/p", page)])
    assert [r["link"] for r in html.job_links(f, "url", "architect").collect()] == ["https://acme.example/openings/1"]
    assert html.apply_route(f, "url").first()["route"] == "https://acme.example/go/apply"
    assert str(f.select(html.posted_date(f).alias("d")).first()["d"]).startswith("2026-01-05")
