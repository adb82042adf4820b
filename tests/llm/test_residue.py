from pyspark.sql import functions as F

from vacantis.llm import residue

YES = [
    "404 Not Found", "Please enable JavaScript to view this page.", "<!-- Just a moment... verifying that you are human -->", "Undefined 404 Not Found",
    "Lorem ipsum dolor sit amet consectetur elit.", "Blah blah Architect blah", "Sample description for Town Planner, to be replaced", "ACCESS DENIED. Reference number 12.3",
    "acme.example – 503 Service Temporarily Unavailable", "Test job do not publish", "[object Object]", "Too many requests. Slow down and retry after 9 s. (ref. 3)",
]
NO = ["Architect needed in Juvanagar. Call the studio.", "Error-free Drawings Team", "Test engineer for façades", "Loading docks are drawn here.", "N/A", "", "  ", "Site planner"]
FIELDS_YES = ["Write to {{ company_name }} soon", "in ${city}", "[salary_max] a month", "#ROLE#", "Dear %(name)s", "about <company_name>", "ends with {{company_na…"]
FIELDS_NO = ["Architect [Part-time]", "{Studio K}", "<5 yrs", "the [draft] folder <A1>", "100% site and 5% rest", "title block (client, survey, date)"]


def test_labels_reach_every_wording(spark):
    rows = [(i, t) for i, t in enumerate([*YES, *NO])]
    df = spark.createDataFrame(rows, "id long, t string")
    got = {rows[r["row"]][1] for r in residue.residue_fields(df, "id", ["t"]).collect()}
    assert got == set(YES)
    assert residue.residue_fields(df, "id", ["t"], trusted=[]).count() == 0


def test_template_fields(spark):
    rows = [(i, t) for i, t in enumerate([*FIELDS_YES, *FIELDS_NO])]
    values = spark.createDataFrame(rows, "row long, text string").withColumn("field", F.lit("t"))
    got = {rows[r["row"]][1] for r in residue.template_fields(values).collect()}
    assert got == set(FIELDS_YES)


def long_text(seed, changed=0):
    words = [f"w{(seed * 97 + i * 31) % 1009}" for i in range(300)]
    words[150 : 150 + changed] = ["other"] * changed
    return " ".join(words)


def test_labels_spread_to_near_duplicates(spark):
    texts = spark.createDataFrame([(1, long_text(1)), (2, long_text(1, 4)), (3, long_text(2)), (4, long_text(1, 120)), (5, "..."), (6, "")], "id long, text string")
    labelled = spark.createDataFrame([(1,)], "id long")
    taken, links = residue.spread_labels(texts, labelled)
    assert {r["id"] for r in taken.collect()} == {1, 2}
    assert {(r["a"], r["b"]) for r in links.collect()} == {(1, 2)}


def test_every_pair_at_the_threshold_is_found(spark):
    # 28 words in a row replaced: 32 of 296 shingles, Jaccard 0.805; 29 words: 0.799
    words = lambda n, changed: " ".join(f"o{n}x{i}" if 150 <= i < 150 + changed else f"w{n}x{i}" for i in range(300))
    rows = [(10 * n + i, words(n, c)) for n in range(40) for i, c in enumerate([0, 28, 29])]
    rows += [(10 * n + 1000 + i, " ".join(f"s{n}x{k}" for k in range(9 - i))) for n in range(40) for i in range(2)]
    texts = spark.createDataFrame(rows, "id long, text string")
    taken, links = residue.spread_labels(texts, texts.where("id % 10 = 0").select("id"))
    got = {(r["a"], r["b"]) for r in links.collect()}
    assert {(10 * n, 10 * n + 1) for n in range(40)} <= got
    assert {(10 * n + 1000, 10 * n + 1001) for n in range(40)} <= got
    assert not {(10 * n, 10 * n + 2) for n in range(40)} & got


def test_chains_of_any_length(spark):
    # each text drops eight words at the front and adds eight at the end: only neighbours are similar enough
    rows = [(i, " ".join(f"c{k}" for k in range(8 * i, 8 * i + 84))) for i in range(22)]
    taken, links = residue.spread_labels(spark.createDataFrame(rows, "id long, text string"), spark.createDataFrame([(0,)], "id long"))
    assert {r["id"] for r in taken.collect()} == set(range(22))
    assert {(r["a"], r["b"]) for r in links.collect()} == {(i, i + 1) for i in range(21)}


def test_whole_operator(spark):
    rows = [(1, "Untitled", None, "x"), (2, "Untitled", "We draw.", "x"), (2, "Untitled", "We draw.", "x"), (3, None, "To ${city} " + "word " * 30_000, "x"), (4, "", "  ", "x")]
    df = spark.createDataFrame(rows, "id long, title string, text string, field string")
    got = {(r["row"], r["field"]) for r in residue.residue_fields(df, "id", ["title", "text"]).collect()}
    assert got == {(1, "title"), (2, "title"), (3, "text")}
    assert residue.residue_fields(df.limit(0), "id", ["title", "text"]).count() == 0
    assert residue.residue_groups(df, "id", ["title", "text"]).select("group").distinct().count() == 1


def test_edited_notices_are_reached_through_the_tables(spark):
    edited = {
        "Sorry, this listing is no longer available, or the link has been moved!": True,
        "You need a browser with script switched on to run this app": True,
        "This page isn't working right now. Bad gateway": True,
        "Checking your browser before you access the site": False,  # too far from the wording given
        "Sorry, this position is filled, the next one opens in May": False,
    }
    rows = list(enumerate(edited))
    got = {rows[r["row"]][1] for r in residue.residue_fields(spark.createDataFrame(rows, "id long, t string"), "id", ["t"]).collect()}
    assert got == {t for t, yes in edited.items() if yes}


def test_recall_of_the_tables():
    assert all(residue.recall(s, t) >= 0.99 for s, t in zip(residue.SIMILARITY, residue.TABLES, strict=True))
