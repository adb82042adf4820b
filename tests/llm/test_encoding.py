import pytest

from vacantis.llm import encoding


@pytest.mark.parametrize("codec", encoding.CODECS)
@pytest.mark.parametrize("word", ["façade", "“slow", "₹20,000", "crew’s", "Rorádopa"])
def test_round_trip_through_every_chain(codec, word):
    once = encoding.garble(word, codec)
    assert encoding.forms(word)[once]
    if encoding.ungarble(once) is not None:
        assert encoding.ungarble(once) == word
    assert encoding.ungarble(encoding.garble(once, codec)) in (None, word)


def test_clean_words_stay_clean():
    for w in ["café", "résumé", "“unfinished”", "Sushüdava", "–", "•", "m²", "Français", "…", "घर", "«", "NÃO"]:
        assert encoding.classify(w) == ("clean", None), w


def rows(spark):
    long = "word " * 20_000 + "façade"
    data = [
        (1, "The façade of Rorádopa", "clean crew’s", 7),
        (2, "The faÃ§ade of Ror?dopa", "the crewâ€™s", 7),
        (3, "lost fa�ade", None, 7),
        (4, None, "", 7),
        (5, long, "Why? Because.", 7),
        (5, long, "Why? Because.", 7),
        (6, "Zw├╢lf", "teak?", 7),
    ]
    return spark.createDataFrame(data, "id long, a string, b string, row int")


def test_found_and_repaired(spark):
    df = rows(spark)
    assert {(r["row"], r["field"]) for r in encoding.garbled_fields(df, "id", ["a", "b"]).collect()} == {(2, "a"), (2, "b"), (3, "a"), (6, "a")}
    got = {(r["row"], r["field"]): r["restored"] for r in encoding.repaired_fields(df, "id", ["a", "b"]).collect()}
    assert got == {(2, "a"): "The façade of Rorádopa", (2, "b"): "the crew’s", (3, "a"): "lost façade", (6, "a"): "Zwölf"}


def test_empty(spark):
    assert encoding.garbled_fields(rows(spark).limit(0), "id", ["a", "b"]).count() == 0


@pytest.mark.parametrize(("first", "then"), [("cp1252", "cp1251"), ("cp1251", "cp1252"), ("mac-roman", "cp1252"), ("latin-1", "cp437")])
def test_chains_of_two_codecs(first, then):
    twice = encoding.garble(encoding.garble("façade", first), then)
    assert twice in encoding.forms("façade")
    assert encoding.ungarble(twice) == "façade"


def test_one_single_byte_encoding_read_as_another(spark):
    wrong = ["Café".encode("cp1252").decode(c) for c in ("cp437", "mac-roman", "cp1251")]
    data = [(i, "Café Rorádopa") for i in range(20)] + [(100 + i, f"the {w}") for i, w in enumerate(wrong)] + [(200, "ein Kafé")]
    df = spark.createDataFrame(data, "id long, a string")
    got = {r["row"]: (r["restored"], r["unknown"]) for r in encoding.repaired_fields(df, "id", ["a"]).collect()}
    assert got == {100 + i: ("the Café", 0) for i in range(3)}
