import random
import re

import pytest
from pyspark.sql import functions as F

from vacantis.llm import near_duplicates as nd


def brute(rows, least, k, similarity):
    sets = {}
    for i, title, text in rows:
        if text is None or len(re.findall(r"[^\W_]+", text)) < least:
            continue
        ws = re.findall(r"[^\W_]+", ((title or "") + "\n" + text).lower())
        sets[i] = {tuple(ws[j : j + k]) for j in range(len(ws) - k + 1)}
    ids = sorted(sets)
    return {(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])}


def corpus(n, copies, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(45, 90))]
        for _ in range(rng.randrange(1, copies)):
            w = list(words)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(4000)}"
            rows.append((len(rows) * 3 + 1, rng.choice([None, "", "A title"]), " ".join(w)))
    rows += [(90_001, "t", rows[0][2]), (90_004, "t", rows[0][2]), (90_007, "t", "too short"), (90_010, None, None), (90_013, "", "")]
    return rows


def found(spark, rows):
    df = spark.createDataFrame(rows, "row_id long, title string, description string").withColumn("row", F.lit(1))
    text = F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.col("description"))
    links, members = nd.class_links(df.where("description is not null"), "row_id", text, F.col("description"), least_words=40, shingle=3, similarity=0.6, missed=1e-5)
    return {(r["row_id_a"], r["row_id_b"]) for r in nd.expand(links, members).collect()}


def test_against_all_pairs(spark):
    rows = corpus(60, 5)
    assert found(spark, rows) == brute(rows, 40, 3, 0.6)


def test_hot_blocks_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(nd, "HOT", 8)
    monkeypatch.setattr(nd, "TILE", 4)
    rows = corpus(3, 40, seed=9)
    assert found(spark, rows) == brute(rows, 40, 3, 0.6)


def test_long_text_and_empty_table(spark):
    long = " ".join(f"v{i % 5000}" for i in range(30_000))
    rows = [(1, None, long), (2, None, long + " more")]
    assert found(spark, rows) == {(1, 2)}
    assert found(spark, [(1, None, "short")]) == set()


def test_full_bitmaps_are_left_to_the_texts(spark):
    half = [(1, None, " ".join(f"v{i}" for i in range(12_000))), (2, None, " ".join(f"v{i}" for i in range(4_000, 16_000)))]
    assert found(spark, half) == set()  # Jaccard 0.5
    like = [(1, None, " ".join(f"v{i}" for i in range(12_000))), (2, None, " ".join(f"v{i}" for i in range(2_000, 14_000)))]
    assert found(spark, like) == {(1, 2)}  # Jaccard 0.71


@pytest.mark.parametrize("similarity", [0.6, 0.8, 0.95])
def test_collision_curve(similarity):
    b = nd.bands_for(similarity, 3, 1e-3)
    assert (1 - similarity**3) ** b <= 1e-3 < (1 - similarity**3) ** (b - 1)
