import random

from pyspark.sql import functions as F

from vacantis.operators import history, keyed
from vacantis.operators.reasons import first_reason, score


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([(1, "a", 3), (2, "a", 1), (3, None, 2), (4, "b", 5), (5, None, 1)], "id int, k string, o int")
    assert {(r["k"], r["id"]) for r in keyed.first_wins(df, ["k"], [F.col("o")]).collect()} == {("a", 2), (None, 5), ("b", 4)}
    won = keyed.last_wins([df.where("id < 3"), df.where("id >= 3")], ["k"], "id").collect()
    assert {(r["k"], r["id"], r["layer"], r["first_layer"]) for r in won} == {("a", 2, 0, 0), (None, 5, 1, 1), ("b", 4, 1, 1)}


def fold(rows, names, worth):
    """The fold as a loop: rows of a key in order, the higher score leads, blanks are filled."""
    out = {}
    total = lambda r: r["base"] + sum(worth(n, r[n]) for n in names)
    for r in sorted(rows, key=lambda r: r["seq"]):
        if r["key"] is None:
            continue
        r = dict(r)
        if r["key"] not in out:
            out[r["key"]] = r
            continue
        lead, other = (r, out[r["key"]]) if total(r) > total(out[r["key"]]) else (out[r["key"]], r)
        out[r["key"]] = {**lead, **{n: lead[n] or other[n] for n in names}}
    return {k: (r["seq"], total(r), *[r[n] or None for n in names]) for k, r in out.items()}


def test_fold_against_a_loop(spark):
    rng = random.Random(3)
    names = ["skills", "mail", "pay"]
    rows = [
        {"key": rng.choice(["a", "b", "c", "hot", "hot", "hot", None]), "seq": i, "base": float(rng.randrange(4)), "skills": rng.choice(["", None, "x", "yy"]), "mail": rng.choice([None, "jobs@x", "press@x"]), "pay": rng.choice(["", "5"])}
        for i in range(400)
    ]
    worth = lambda n, v: 0.0 if not v else {"skills": 2.0, "pay": 0.0}.get(n, 4.0 if v.startswith("jobs") else 1.0)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "key string, seq int, base double, skills string, mail string, pay string")
    mail = F.when(F.col("mail").startswith("jobs"), 4).otherwise(1)
    got = keyed.fold_duplicates(df, "key", "seq", F.col("base"), {"skills": F.lit(2), "mail": mail, "pay": F.lit(0)})
    assert {r["key"]: tuple(r)[1:] for r in got.collect()} == fold(rows, names, worth)


def test_fold_is_no_argmax(spark):
    rows = [("k", 1, 12.0, None), ("k", 2, 9.0, "x"), ("k", 3, 13.0, None)]
    df = spark.createDataFrame(rows, "key string, seq int, base double, skills string")
    r = keyed.fold_duplicates(df, "key", "seq", F.col("base"), {"skills": F.lit(2)}).first()
    assert (r["leader"], r["score"], r["skills"]) == (1, 14.0, "x")


def test_upsert(spark):
    stored = spark.createDataFrame([("a", "2020", "x", "n"), ("b", "", "y", "n"), ("c", "2021", "z", "n")], "id string, seen string, v string, note string")
    new = spark.createDataFrame([("a", "2025", "x2", 1), ("b", "2025", "y2", 1), ("b", "2026", "y3", 2), ("d", "2025", "w", 1), ("", "2025", "lost", 1), (None, "2025", "lost", 1)], "id string, seen string, v string, seq int")
    got = {tuple(r[c] for c in ("id", "seen", "v", "note", "action")) for r in keyed.upsert(stored, new, "id", ["seen"], "seq").collect()}
    assert got == {("a", "2020", "x2", "n", "update"), ("b", "2026", "y3", "n", "update"), ("c", "2021", "z", "n", "keep"), ("d", "2025", "w", None, "insert")}
    again = keyed.upsert(stored.limit(0), new.limit(0), "id", ["seen"], "seq")
    assert again.count() == 0


def test_append_cap_target_top(spark):
    df = spark.createDataFrame([(i, "abcab"[i % 5], i % 3 == 0) for i in range(30)], "id int, k string, ok boolean")
    assert [r["id"] for r in keyed.append_new(df.where("k = 'a'"), df, F.col("k"), "id").orderBy("id").collect()] == [1, 2]
    assert keyed.cap(df, ["k"], [F.desc("id")], 2).count() == 6
    assert sorted(r["id"] for r in keyed.until_target(df, F.col("ok"), "id", 4).collect()) == list(range(10))
    assert keyed.until_target(df, F.col("ok"), "id", 400).count() == 30
    assert keyed.until_target(df.limit(0), F.col("ok"), "id", 4).count() == 0
    assert [tuple(r) for r in keyed.top_counts(df, F.col("k"), "id", 2).orderBy("place").collect()] == [("a", 12, 1), ("b", 12, 2)]


def test_reasons_and_scores(spark):
    df = spark.createDataFrame([(None,), (1,), (9,)], "n int")
    reason = first_reason([("big", F.col("n") > 5), ("small", F.col("n") > 0)], "none")
    assert [r[0] for r in df.select(reason).collect()] == ["none", "small", "big"]
    assert [r[0] for r in df.select(score([(60, F.col("n") > 0), (60, F.col("n") > 5)], most=100)).collect()] == [0, 60, 100]


def test_history(spark):
    e = spark.createDataFrame([("s", 1, False), ("s", 2, True), ("s", 3, False), ("s", 4, False), ("t", 1, False), ("u", 1, True)], "k string, n int, ok boolean").withColumn("ts", F.timestamp_seconds("n"))
    got = {r["k"]: (r["checks"], r["failures"], r["open_failures"]) for r in history.streaks(e, "k", "ts", "n", ~F.col("ok")).collect()}
    assert got == {"s": (4, 3, 2), "t": (1, 1, 1), "u": (1, 0, 0)}
    assert history.islands(e, "k", "ts", "n", F.col("ok")).where("k = 's'").count() == 3
    places = spark.createDataFrame([(i,) for i in range(7)], "p int")
    turns = [sorted(r["p"] for r in history.rotation(places, "p", t, 3).collect()) for t in range(3)]
    assert turns == [[0, 1, 2], [3, 4, 5], [0, 1, 6]]
    assert history.rotation(places.limit(0), "p", 2, 3).count() == 0
