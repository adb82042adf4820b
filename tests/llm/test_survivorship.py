from pyspark.sql import functions as F

from vacantis.llm import survivorship as sv


def test_sets(spark):
    rows = [
        (1, "VX-001", "https://www.A.example/jobs/1/?utm=2", 0), (2, " vx.001 ", None, 0), (3, None, "http://a.example/jobs/1#top", 0), (4, "N/A", "pending", 0), (5, "-", "", 0),
        (6, "VX-2", None, 0), (7, "VX_2.", None, 0), (8, "VX-3", "b.example/x", 0),
    ]
    df = spark.createDataFrame(rows, "row_id long, external_id string, apply_url string, row int")
    keys = [sv.id_key(F.col("external_id")), sv.url_key(F.col("apply_url"))]
    got = {r["row"]: r["group"] for r in sv.same_thing(df, "row_id", keys).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 6: 6, 7: 6}
    assert sv.same_thing(df.limit(0), "row_id", keys).count() == 0


def test_cut_short(spark):
    values = {
        "Junior Architect": 40, "Junior Arch": 2, "Furniture Designer": 50, "Furniture Design": 2, "Furniture Desi…": 1, "Architect": 90, "Architectural Assistant": 60, "Studio Bee Interiors": 30, "Studio Bee Interior": 4,
        "Planner (2-4 yr": 1, "Planner (2-4 yrs)": 20, "Retail Pla": 1, "Retail Planner": 30, "Site": 5,
    }
    df = spark.createDataFrame([("t", v, n) for v, n in values.items()], "field string, value string, n long")
    assert {r["value"] for r in sv.cut_short(df).collect()} == {"Junior Arch", "Furniture Design", "Furniture Desi…", "Planner (2-4 yr", "Retail Pla"}


def observed(spark, rows):
    return spark.createDataFrame(rows, "group long, field string, row long, value string, day int").withColumn("ts", F.timestamp_seconds(F.col("day") * 86400)).drop("day")


def test_latest_timestamp_wins(spark):
    rows = [(1, "t", 1, "a", 1), (1, "t", 2, "b", 5), (1, "t", 3, "c", 5), (1, "u", 1, "x", None), (2, "t", 9, "z", 0)]
    got = {(r["group"], r["field"]): r["row"] for r in sv.survivors(observed(spark, rows)).collect()}
    assert got == {(1, "t"): 2, (1, "u"): 1, (2, "t"): 9}


def test_learned_order_where_timestamps_are_missing(spark):
    rows = [(g, "t", 10 * g + i, v, i) for g in range(1, 6) for i, v in enumerate(["junior", "architect", "senior"])]
    rows += [(50, "t", 501, "senior", None), (50, "t", 502, "junior", None)]
    rows += [(51, "t", 511, "architect", 3), (51, "t", 512, "senior", None), (51, "t", 513, "unheard", None)]
    rows += [(52, "t", 521, "architect", 3), (52, "t", 522, "junior", None)]
    rows += [(53, "t", 531, "p", None), (53, "t", 532, "q", None)]
    got = {r["group"]: r["row"] for r in sv.survivors(observed(spark, rows)).where("group >= 50").collect()}
    assert got == {50: 501, 51: 512, 52: 521, 53: 531}
    order = {(r["before"], r["after"]) for r in sv.precedence(observed(spark, rows)).collect()}
    assert order == {("junior", "architect"), ("architect", "senior"), ("junior", "senior")}


def test_long_chains_of_learned_order(spark):
    steps = "zyxwvu"
    rows = [(g, "t", 10 * g + i, v, i) for g, pair in enumerate(zip(steps, steps[1:], strict=False), 1) for i, v in enumerate(pair)]
    rows += [(50, "t", 501, "z", None), (50, "t", 502, "u", None)]
    rows += [(60, "r", 601, "p", 1), (60, "r", 602, "q", 2), (61, "r", 611, "q", 1), (61, "r", 612, "o", 2), (62, "r", 621, "o", 1), (62, "r", 622, "p", 2)]
    rows += [(63, "r", 631, "q", None), (63, "r", 632, "p", None)]
    got = {r["group"]: r["row"] for r in sv.survivors(observed(spark, rows)).where("group in (50, 63)").collect()}
    assert got == {50: 502, 63: 631}  # the latest of six in a row; values in a cycle go by row


def test_unusable(spark):
    rows = [(1, "Architect", "Acme Studio"), (2, "Untitled", "N/A"), (3, "Fa�ade Engineer", "Acm…"), (4, None, ""), (5, "Architect", "Acme Studio")]
    df = spark.createDataFrame(rows, "id long, title string, firm string")
    got = {(r["field"], r["value"]) for r in sv.unusable(df, "id", ["title", "firm"], ["title"]).collect()}
    assert got == {("title", "Untitled"), ("title", "Fa�ade Engineer"), ("firm", "N/A"), ("firm", "Acm…"), ("firm", "")}
