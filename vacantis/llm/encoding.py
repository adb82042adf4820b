"""Text read in a wrong encoding: find the affected fields and restore them.

Every distinct clean word of the corpus is turned into its garbled forms: its UTF-8 bytes read in one codec, once or
again in the same or any other, and its bytes in one single-byte codec read in another. The words of the documents are
hash-joined against that table and replaced by the verified original; a form of the last kind, which is made of
ordinary letters, counts where the original is far commoner. What the join cannot verify, as the original stands nowhere
in the corpus, is ``unverified``: such words are decoded by running chains of up to three layers backwards, or
reported with their lost characters; ``verified_only`` leaves them out. The joins are by hash with both sides
shuffled: words and forms grow with the corpus and are never broadcast.

Cases: null and empty texts have no words and are never reported; rows repeated whole are reported each; a word
with two possible originals gets the more frequent one, the lesser by code points on ties; lost characters with no
known original are reported and left as they are; empty tables give empty results.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# fixed values: the single-byte encodings that UTF-8 and one another are mistaken for
CODECS = ("cp1252", "latin-1", "cp1250", "cp1251", "cp1254", "iso8859-15", "cp437", "cp850", "cp852", "cp866", "koi8-r", "mac-roman")
LOST = "�"
BLANKS = "[ \\t\\n\\r]+"
INNER_MARK = regex.compile(r"\p{L}\?\p{L}")
MARK_INSIDE = regex.compile(r"\?[\p{L}\p{N}]")
LETTER = regex.compile(r"\p{L}")
FOREIGN = regex.compile(r"[^\p{Latin}\p{Common}\p{Inherited}]")
#: A word is a misreading from one single-byte encoding to another only if its original is so many times commoner.
COMMONER = 20
C1 = regex.compile(r"[\x80-\x9f]")


@functools.cache
def byte_table(codec: str) -> list[str]:
    """Byte to character; bytes without one pass through, as browsers do."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


@functools.cache
def inverse_table(codec: str) -> dict[str, int]:
    table = {}
    for b, c in enumerate(byte_table(codec)):
        table.setdefault(c, b)
    for b in range(0x80, 0xA0):
        table.setdefault(chr(b), b)
    return table


@functools.cache
def sequence_pattern(codec: str) -> regex.Pattern:
    """Runs of characters whose bytes in ``codec`` form UTF-8 sequences of two to four bytes."""
    back = inverse_table(codec)
    chars = {b: [c for c, x in back.items() if x == b] for b in range(0x80, 0x100)}
    cls = lambda lo, hi: "[" + "".join(regex.escape(c, literal_spaces=True) for b in range(lo, hi + 1) for c in chars[b]) + "]"
    tail = cls(0x80, 0xBF)
    return regex.compile(f"(?:{cls(0xC2, 0xDF)}{tail}|{cls(0xE0, 0xEF)}{tail}{{2}}|{cls(0xF0, 0xF4)}{tail}{{3}})+")


def garble(word: str, codec: str) -> str:
    table = byte_table(codec)
    return "".join(table[b] for b in word.encode("utf-8"))


def peel(text: str, codec: str) -> str | None:
    """``text`` with the runs garbled by ``codec`` decoded; None if it has none."""
    back = inverse_table(codec)
    ok = False

    def decode(m: regex.Match) -> str:
        nonlocal ok
        try:
            out = bytes(back[c] for c in m.group()).decode("utf-8")
        except UnicodeDecodeError:
            return m.group()
        ok = True
        return out

    out = sequence_pattern(codec).sub(decode, text)
    return out if ok else None


def ungarble(word: str) -> str | None:
    """``word`` with its garbled runs decoded, under the chain that explains most of it; None if no chain does.

    Layers of different codecs count only where they end in Latin script: in others, clean words look garbled too.
    """
    best: tuple[int, tuple[int, ...], str] | None = None
    layers: list[tuple[str, tuple[int, ...]]] = [(word, ())]
    for _ in range(3):
        following = {}
        for text, chain in layers:
            for rank, codec in enumerate(CODECS):
                out = peel(text, codec)
                if out is None:
                    continue
                path = (*chain, rank)
                following.setdefault((out, len(set(path)) > 1), path)
                if len(set(path)) > 1 and FOREIGN.search(out):
                    continue
                score = (sum(c > "\x7f" for c in out) + 2 * len(C1.findall(out)), path, out)
                if best is None or (score[0], path[0], -len(path)) < (best[0], best[1][0], -len(best[1])):
                    best = score
        layers = [(text, path) for (text, _), path in following.items()]
    return best[2] if best else None


def forms(word: str) -> dict[str, str]:
    """Garbled form to chain, for one clean word with characters beyond ASCII."""
    out: dict[str, str] = {}
    once = {codec: garble(word, codec) for codec in CODECS}
    for codec, text in once.items():
        out.setdefault(text, codec)
    for codec, text in once.items():
        out.setdefault(garble(text, codec), f"{codec} twice")
    for first, text in once.items():
        for codec in CODECS:
            out.setdefault(garble(text, codec), f"{first}, {codec}")
    places = [i for i, c in enumerate(word) if c > "\x7f"]
    for mark in (LOST, "?"):
        for wide in (False, True):
            put = lambda i: mark * (len(word[i].encode("utf-8")) if wide else 1)  # noqa: B023, E731
            out.setdefault("".join(put(i) if i in places else c for i, c in enumerate(word)), "lost")
            for i in places:
                out.setdefault(word[:i] + put(i) + word[i + 1 :], "lost")
    out.pop(word, None)
    # a mark at the end of a word may be punctuation, one within or before it is not
    return {k: v for k, v in out.items() if "?" not in k or MARK_INSIDE.search(k)}


def misreadings(word: str) -> dict[str, str]:
    """Form to chain, for one clean word whose bytes in one single-byte encoding are read in another; short words would meet by chance."""
    out: dict[str, str] = {}
    if len(LETTER.findall(word)) < 3:
        return out
    for source in CODECS:
        try:
            data = word.encode(source)
        except UnicodeEncodeError:
            continue
        for codec in CODECS:
            out.setdefault("".join(byte_table(codec)[b] for b in data), f"{source} as {codec}")
    out.pop(word, None)
    return out


def words_of(df: DataFrame, row: str, fields: list[str]) -> DataFrame:
    """(row, field, word) for the words that hold a character beyond ASCII or a question mark; words end at ASCII blanks."""
    per = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])
    rows = df.select(F.col(row).alias("row"), F.explode(per).alias("x")).where(F.col("x.text").rlike(r"[^\x00-\x7F]|\?"))
    word = F.explode(F.array_distinct(F.filter(F.split("x.text", BLANKS), lambda w: w.rlike(r"[^\x00-\x7F]|\?"))))
    return rows.select("row", "x.field", word.alias("word"))


def classify(word: str) -> tuple[str, str | None]:
    """'clean', 'garbled' (with the text decoded backwards), 'lost', or 'mark' (a question mark only the join can judge)."""
    if LOST in word:
        return "lost", None
    decoded = ungarble(word)
    if decoded is not None:
        return "garbled", decoded
    if C1.search(word):
        return "garbled", None
    if "?" in word:
        return ("lost" if INNER_MARK.search(word) and not regex.search(r"[/=&]|\?\w+=", word) else "mark"), None
    return "clean", None


def _classify_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        both = [classify(w) for w in b["word"]]
        yield pd.DataFrame({"word": b["word"], "n": b["n"], "kind": [k for k, _ in both], "decoded": pd.Series([d for _, d in both], dtype="object")})


def _all_forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(f, w, n, chain, single) for w, n in zip(b["word"], b["n"], strict=True) for single, made in ((False, forms(w)), (True, misreadings(w))) for f, chain in made.items()]
        yield pd.DataFrame(rows, columns=["word", "original", "original_n", "chain", "single"])


def verdicts(words: DataFrame, verified_only: bool = False) -> DataFrame:
    """(word, restored, chain) for every garbled word among ``words``; restored is null where the original is unknown.

    Work is per distinct word, so a word in a third of all rows is judged once; counting combines on the map side.
    """
    seen = words.groupBy("word").agg(F.count("*").alias("n"))
    kinds = materialize(seen.mapInPandas(_classify_all, "word string, n long, kind string, decoded string"), "words")
    table = kinds.where("kind = 'clean'").select("word", "n").mapInPandas(_all_forms, "word string, original string, original_n long, chain string, single boolean")
    order = F.struct(~F.col("single"), F.col("original_n"), F.expr("-length(original)"), F.col("original"))
    met = kinds.hint("merge").join(table, "word").where(f"(kind <> 'clean' and not single) or (single and original_n >= {COMMONER} * n)")
    verified = met.groupBy("word").agg(F.max_by("original", order).alias("restored"), F.max_by("chain", order).alias("chain"))
    if verified_only:
        return materialize(verified, "verdicts")
    verified = materialize(verified, "verified")
    rest = kinds.where("kind in ('garbled', 'lost')").join(verified.hint("merge"), "word", "left_anti")
    rest = rest.select("word", F.col("decoded").alias("restored"), F.when(F.col("decoded").isNotNull(), "unverified").otherwise("lost").alias("chain"))
    return materialize(verified.unionByName(rest), "verdicts")


def garbled_fields(df: DataFrame, row: str, fields: list[str], verified_only: bool = False) -> DataFrame:
    """(row, field) of every field that holds a garbled word."""
    words = materialize(words_of(df, row, fields), "tokens")
    return words.join(verdicts(words, verified_only).hint("merge"), "word", "left_semi").select("row", "field").distinct()


def _restore(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for text, swaps in zip(b["text"], b["swaps"], strict=True):
            known = {s["word"]: s["restored"] for s in swaps if s["restored"] is not None}
            out.append("".join(known.get(p, p) for p in regex.split(r"([ \t\n\r]+)", text)))
        yield pd.DataFrame({"row": b["row"], "field": b["field"], "restored": out, "unknown": [sum(s["restored"] is None for s in swaps) for swaps in b["swaps"]]})


def repaired_fields(df: DataFrame, row: str, fields: list[str]) -> DataFrame:
    """(row, field, restored, unknown): the affected fields as originally written, and how many words stay unknown."""
    words = materialize(words_of(df, row, fields), "tokens")
    swaps = words.join(verdicts(words).hint("merge"), "word").groupBy("row", "field").agg(F.collect_list(F.struct("word", "restored")).alias("swaps"))
    per = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])
    texts = df.select(F.col(row).alias("row"), F.explode(per).alias("x")).select("row", "x.field", "x.text")
    return texts.join(swaps, ["row", "field"]).select("row", "field", "text", "swaps").mapInPandas(_restore, f"row {dict(df.dtypes)[row]}, field string, restored string, unknown int")
