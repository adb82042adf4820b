from vacantis.llm import canonical


def places(spark):
    return spark.createDataFrame([("P1", "Talvagarh", "Madhyavan", "Fort Talva|TLG"), ("P2", "Kesmeru", "Himadesh", None), ("P3", "Kolmitra", "Purvan", "Old Kolmit")], "place_id string, city string, state string, aliases string")


WANT = {
    "talvagarh": "P1", "Tavlagarh|India": "P1", "Plot 5, Ring Road, Kesmeru": "P2", "Kesmeroo": "P2", "TLG": "P1", "fort talva": "P1", "Talva…": "P1", "Kolmi": "P3", "Old Bazaar | Tavlagarh | Madhyavan": "P1",
    "Remote": "", "Old Bazaar": "", "N/A": "", "Madhyavan": "", "Threvali": "", "?": "",
}


def test_places(spark):
    rows = [(i, v, "x") for i, v in enumerate(WANT)] + [(100, "Kesmeru|India", "x"), (101, None, "x"), (102, "  ", "x"), (103, "talvagarh", "x"), (104, "far " * 5000 + "Kesmeru", "x")]
    df = spark.createDataFrame(rows, "id long, place string, value string")
    got = canonical.map_values(df, "id", "place", places(spark), "place_id", ["city", "aliases"], "concat(city, '|India')", ["state"]).collect()
    by_id = {r["row"]: r["entry_id"] for r in got}
    assert by_id == {i: e for i, e in enumerate(WANT.values())} | {103: "P1", 104: "P2"}


def test_ties_and_empty(spark):
    twins = spark.createDataFrame([("A", "North Hall"), ("B", "South Hall")], "id string, name string")
    df = spark.createDataFrame([(1, "Hall"), (2, "North Hal")], "id long, v string")
    got = {r["row"]: r["entry_id"] for r in canonical.map_values(df, "id", "v", twins, "id", ["name"], "name").collect()}
    assert got == {1: "", 2: "A"}
    assert {r["entry_id"] for r in canonical.map_values(df, "id", "v", twins.limit(0), "id", ["name"], "name").collect()} == {""}
    assert canonical.map_values(df.limit(0), "id", "v", twins, "id", ["name"], "name").count() == 0


def test_short_forms_of_words():
    for short, word, is_one in [("consv", "conservation", True), ("mgr", "manager", True), ("plnr", "planner", True), ("cons", "conservation", False), ("pan", "panchelu", False), ("cat", "conservation", False), ("conx", "conservation", False), ("planner", "planner", False), ("co", "conservation", False)]:
        assert canonical.abbreviates(short, word) is is_one
