import random
import re

import pytest
from pyspark.sql import functions as F

from vacantis.llm import languages, leakage, mixing


def leaks_by_hand(docs, items):
    run = lambda t: (lambda ws: {tuple(ws[i : i + 4]) for i in range(len(ws) - 3)})(re.findall(r"[^\W_]+", (t or "").lower()))
    own = {i: run(t) for i, t in items}
    return {(d, i) for d, t in docs for i, r in own.items() if r and len(r & run(t)) >= 0.5 * len(r)}


def test_leaks_against_all_pairs(spark, monkeypatch):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(80)]
    items = [(i, " ".join(rng.choices(words, k=30))) for i in range(12)] + [(90, "too few words"), (91, None), (92, "")]
    items.append((93, items[0][1]))
    docs = [(d, " ".join(rng.choices(words, k=60))) for d in range(20)]
    for d in range(20, 40):
        ws = items[d % 12][1].split()
        part = ws[: rng.choice([8, 14, 20, 30])]
        docs.append((d, f"Intro, {'; '.join(part).upper()} outro"))
    docs += [(98, None), (99, ""), (100, "x " * 50_000 + items[3][1]), (100, "x " * 50_000 + items[3][1])]
    d, i = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit(0)), spark.createDataFrame(items, "item_id long, text string")
    want = leaks_by_hand(docs, items)
    assert {(r["doc"], r["item"]) for r in leakage.leaks(d, "doc_id", "text", i, "item_id", "text").collect()} == want
    monkeypatch.setattr(leakage, "BLOCK", 5)  # items in several blocks give the same
    assert {(r["doc"], r["item"]) for r in leakage.leaks(d, "doc_id", "text", i, "item_id", "text").collect()} == want
    assert leakage.leaks(d, "doc_id", "text", i.limit(0), "item_id", "text").count() == 0
    assert leakage.leaks(d.limit(0), "doc_id", "text", i, "item_id", "text").count() == 0


def test_substitutions_are_tolerated():
    index = leakage.ItemIndex([1], ["a b c d e f g h i j k l"])
    import pyarrow as pa

    _, _, runs, words = leakage.match_batch(index, pa.array(["a b X d e f Y h i j k l"]))
    assert runs[0] < 0.5 < words[0]


def test_every_fourth_word_replaced(spark):
    words = [f"w{i}" for i in range(40)]
    edited = " ".join("zz" if i % 4 == 3 else w for i, w in enumerate(words))
    docs = spark.createDataFrame([(1, f"before {edited} after"), (2, " ".join(words[:12])), (3, "w1 w9 w30")], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    got = leakage.leaks(docs, "doc_id", "text", items, "item_id", "text").collect()
    assert [(r["doc"], r["run_share"]) for r in got] == [(1, 0.0)] and got[0]["word_share"] > 0.7


def test_a_phrase_of_all_items_is_taken_in_parts(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"the same four words x{i} y{i} z{i} q{i}") for i in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(d, f"the same four words x{d} y{d} z{d} q{d} the same four words") for d in range(30)], "doc_id long, text string")
    monkeypatch.setattr(leakage, "LOAD", 100)
    got = {(r["doc"], r["item"]) for r in leakage.leaks(docs, "doc_id", "text", items, "item_id", "text").collect()}
    assert got == {(d, d) for d in range(30)}


def subset_sum(lengths, budget):
    reach = {0}
    for n, c in lengths.items():
        reach = {r + n * k for r in reach for k in range(c + 1) if r + n * k <= budget}
    return max(reach)


def test_fit_is_the_best_sum():
    rng = random.Random(4)
    for _ in range(40):
        lengths = {rng.randrange(1, 30): rng.randrange(1, 5) for _ in range(4)}
        budget = rng.randrange(0, 120)
        got = mixing.fit(lengths, budget)
        assert sum(n * c for n, c in got.items()) == subset_sum(lengths, budget)
        assert all(c <= lengths[n] for n, c in got.items())
    assert mixing.fit({0: 5}, 10) == {} and mixing.fit({}, 10) == {} and mixing.fit({5: 2}, 0) == {}
    big = {n: 10_000 for n in range(100, 140)}
    assert 20_000_000 - sum(n * c for n, c in mixing.fit(big, 20_000_000).items()) == 0


def test_mix(spark):
    rows = [(i, "Big-Source" if i % 2 else "big source ", 10 + i % 7) for i in range(200)] + [(900 + i, "small", 10) for i in range(5)] + [(990, None, 50), (991, "", 50), (992, "other", 50)]
    counted = spark.createDataFrame(rows, "doc long, raw string, tokens long").select("doc", mixing.source_key(F.col("raw")).alias("source"), "tokens")
    targets = spark.createDataFrame([("big_source", 0.5, 2), ("Small", 0.4, 3), ("absent", 0.1, 2)], "source string, target_share double, max_repeats int")
    reports, draws = mixing.plan(counted, targets)
    by = {r["source"]: r for r in reports}
    assert {s for s, r in by.items() if r["falls_short"]} == {"Small", "absent"}
    assert by["big_source"]["reached"] == by["big_source"]["budget"] and by["Small"]["reached"] == 150 and by["absent"]["reached"] == 0
    mixed = mixing.mix(counted, reports, draws).collect()
    assert sum(r["tokens"] * r["repeats"] for r in mixed if r["source"] == "big_source") == by["big_source"]["budget"]
    assert {r["repeats"] for r in mixed if r["source"] == "Small"} == {3}
    assert sorted((r["doc"], r["repeats"]) for r in mixed) == sorted((r["doc"], r["repeats"]) for r in mixing.mix(counted, reports, draws).collect())
    nothing = mixing.plan(counted.limit(0), targets)
    assert not any(r["falls_short"] for r in nothing[0]) and nothing[1] == []


def test_token_counts(spark):
    df = spark.createDataFrame([(1, " A-b ", "Hello world"), (2, None, None), (3, "", "<|endoftext|>"), (4, "a_B", "word " * 30_000)], "id long, source string, text string")
    got = {r["doc"]: (r["source"], r["tokens"]) for r in mixing.token_counts(df, "id", "source", "text").collect()}
    assert got[1] == ("a_b", 2) and got[2] == (None, 0) and got[3][1] > 1 and got[4][0] == "a_b" and got[4][1] >= 30_000


@pytest.fixture(scope="module")
def model(spark, root):
    docs, samples = spark.read.parquet(root.replace("0.001", "0.01") + "/documents.parquet"), spark.read.parquet(root + "/lang_samples.parquet")
    return languages.fit(docs, "text", "lang", samples, "text", "lang")


def test_held_out_accuracy(spark, root, model):
    """Documents of another table whose label and language are known: their sentences must nearly all agree."""
    docs = spark.read.parquet(root + "/documents.parquet")
    labels = {r["doc_id"]: r["l"] for r in docs.select("doc_id", languages.label_key(F.col("lang")).alias("l")).collect()}
    full = languages.segments(docs, "doc_id", "text", model).groupBy("doc", "lang").agg(F.sum("full_sentences").alias("n")).collect()
    right = sum(r["n"] for r in full if labels[r["doc"]] == r["lang"])
    every = sum(r["n"] for r in full if labels[r["doc"]])
    assert right / every > 0.85  # a tenth of the labels is wrong and some texts are mixed


def test_segments_and_labels(spark, model):
    en = "The office on the corner hires people who can draw and listen well."
    de = "Nach der Besichtigung haben wir beschlossen, die alte Fassade aus Glas nicht abzureißen."
    rows = [(1, en, "en", 0), (2, en, "de", 0), (3, f"{en} {de} {de}", "en-IN", 0), (4, de, "unknown", 0), (5, None, "en", 0), (6, "", None, 0), (7, "Wir danken", "en", 0), (8, (en + " ") * 2000, " EN_in ", 0), (9, "zzqx vvkw qqpz xxjk wwvz kkqp zzvw qxqx jjkk", "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, doc int")
    segments = languages.segments(docs, "doc_id", "text", model)
    assert [(r["lang"], r["full_sentences"]) for r in segments.where("doc = 3").orderBy("segment").collect()] == [("en", 1), ("de", 2)]
    assert {r["lang"] for r in segments.where("doc = 9").collect()} == {"und"}
    got = {(r["doc"], r["lang"]) for r in languages.wrong_labels(docs, "doc_id", "lang", segments).collect()}
    assert got == {(2, "en"), (3, "en"), (3, "de"), (4, "de")}
    assert languages.wrong_labels(docs.limit(0), "doc_id", "lang", languages.segments(docs.limit(0), "doc_id", "text", model)).count() == 0
