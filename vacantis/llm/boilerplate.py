"""Page parts around the main text: tag-path ratios over the lines of each page.

The pages come as text, so a line's path is the chain of its structural marks from the page down to the leaf: how it
is marked as an item, what separates its parts, how it ends, how long it is, and, where its wording names a kind of page
furniture, that kind and the words it begins with. Text length and punctuation are summed per path over all pages; the
ratios of a path, smoothed along the page and fused with the line's own, decide by threshold which lines are content.
Wording alone weighs little: it tells furniture where lines of the kind begin alike again and again, as page parts do
and prose does not. Characters of a wrong encoding are read as meant.

Cases: null and empty pages and pages of a single line have no rows; empty and blank lines count as lines but are
never reported; rows repeated whole are reported each; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import collect_bounded, materialize
from .encoding import ungarble

#: A path is built from a fixed set of marks and the repeated beginnings, so there are at most so many; the check keeps that true.
MOST_PATHS = 20_000
#: Weight of the neighbours (one line off, two lines off) against the line itself.
SMOOTH = (0.08, 0.04)
THRESHOLD = 0.5
#: The lines of a kind that begin alike must be this share of its lines to count as repeated; so many beginnings fit.
REPEATED = 0.01
#: What furniture wording takes from a score, alone and where its beginning is repeated.
WORDING = (0.3, 0.9)

# fixed values: wording of page furniture, by kind
FURNITURE = {
    "consent": r"use(?:s)? (?:of )?cookies|cookie (?:policy|settings|notice|preferences|banner)|accept (?:all|cookies)|manage (?:choices|cookies|preferences)|your privacy matters|which trackers|continuing to browse|stores small files|save preferences",
    "account": r"sign in to|sign in or|log ?in\b.{0,12}\bregister|forgot(?:ten)? (?:your )?password|create an? (?:free )?account|get alerts for|my account",
    "sharing": r"share (?:on|this|via|with)|\btweet\b|follow us|copy link|report this (?:ad|job|posting)|\bbookmark\b|on social media",
    "navigation": r"skip to (?:main )?content|back to top|search (?:the |this )?site|\bsitemap\b|terms of use|\bimprint\b|language: |download our app|main menu$",
    "legal": r"(?:^|\s)\S{0,4}© |\(c\) (?:19|20)\d\d|copyright (?:19|20)\d\d|all rights reserved|reuse only with|\bsite by\b|powered by",
    "paging": r"previous\b.*\bnext\b|page \d+ of \d+",
    "related": r"(?:people )?also viewed|may also like|related (?:openings|jobs|posts|roles|articles)|similar (?:jobs|roles|openings)|recently viewed|latest (?:openings|jobs|posts)|^more (?:roles|jobs|openings)$|also hiring|popular tags|^read next|^see also",
    "subscription": r"newsletter|enter your e-?mail|subscribe (?:to|now)",
    "feedback": r"was this (?:page|article) helpful|^comments \(\d+\)|be the first to (?:reply|comment)|posted \d+ (?:day|hour|week|month)s? ago|\d+ views",
    "advert": r"^advertisements?$|^sponsored(?: content)?$|^ads? by",
    "contact": r"\btel(?:\.|ephone)?:? ?\+?\d[\d ]{5,}|\bfax:? ?\+?\d",
}
BEYOND = regex.compile(r"[^\x00-\x7F]{2,}")
ANY_FURNITURE = "|".join(f"(?:{p})" for p in FURNITURE.values())
SEPARATOR = r" [|/>·»«•–—] |  +| \S{1,2}[·»«] "


def as_meant(lines: pa.Array) -> pa.Array:
    """Lines with the runs of characters that arose from a wrong encoding decoded; each distinct run is judged once."""
    some = np.flatnonzero(pc.match_substring_regex(lines, pattern=r"[^\x00-\x7F]{2,}").to_numpy(zero_copy_only=False))
    if not len(some):
        return lines
    known: dict[str, str] = {}

    def decode(m: regex.Match) -> str:
        run = m.group()
        if run not in known:
            known[run] = ungarble(run) or run
        return known[run]

    put = [BEYOND.sub(decode, x) for x in lines.take(pa.array(some)).to_pylist()]
    mask = np.zeros(len(lines), bool)
    mask[some] = True
    return pc.replace_with_mask(lines, pa.array(mask), pa.array(put, pa.string()))


def line_paths(lines: pa.Array) -> list[str | None]:
    """The path of each line, root first; None for a blank one."""
    t = pc.utf8_trim_whitespace(as_meant(lines))
    count = lambda pattern, of=t: pc.count_substring_regex(of, pattern=pattern).to_numpy(zero_copy_only=False)
    has = lambda pattern, of=t: pc.match_substring_regex(of, pattern=pattern).to_numpy(zero_copy_only=False)
    led = pc.binary_join_element_wise("", t, " ")  # a count's pattern must not use ^, which holds again after each hit
    item = np.where(has(r"^(?:[-*•‣▪]|\d{1,2}[.)])\s"), "item", "block")
    parts = count(SEPARATOR, pc.replace_substring_regex(t, pattern=r"^[-*•‣▪]\s+", replacement=""))
    cut = np.select([parts >= 2, parts == 1], ["list", "pair"], "run")
    end = np.select([has(r"[.!?…;]['”’\")\]]*$"), has(r"^[^:|]{2,30}: "), has(r":$")], ["sentence", "label", "heading"], "open")
    words = count(r"\S+")
    size = np.select([words <= 3, words <= 8, words <= 30], ["few", "some", "many"], "text")
    case = np.where(count(r"\s[(“\"]?\p{Lu}", led) >= 0.6 * count(r"\s[(“\"]?\p{L}", led), "title", "prose")
    low = pc.utf8_lower(t)
    some = np.flatnonzero(has(ANY_FURNITURE, low) & (size != "text"))
    kind = np.full(len(t), "plain", dtype="<U12")
    near = low.take(pa.array(some))
    for name, pattern in reversed(FURNITURE.items()):
        kind[some[has(pattern, near)]] = name
    ends = np.full((2, len(t)), "", dtype=object)
    named = np.flatnonzero(kind != "plain")
    own = pc.replace_substring_regex(low.take(pa.array(named)), pattern=r"[0-9]+", replacement="0")
    own = pc.utf8_trim_whitespace(pc.replace_substring_regex(own, pattern=r"[^\p{L}\p{N}©]+", replacement=" "))
    ends[0, named] = pc.replace_substring_regex(own, pattern=r"^(\S+(?: \S+)?)(?s:.*)$", replacement=r"\1").to_pylist()
    ends[1, named] = pc.replace_substring_regex(own, pattern=r"^(?s:.*?)((?:\S+ )?\S+)$", replacement=r"\1").to_pylist()
    path = ["page/" + "/".join(x) for x in zip(item, cut, end, size, case, kind, *ends, strict=True)]
    return [p if w else None for p, w in zip(path, words, strict=True)]


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = pc.split_pattern(b.column("text"), "\n")
        lines = lists.flatten()
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        make = lambda values, kind: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))  # noqa: B023, E731
        marks = pc.count_substring_regex(lines, pattern=r"[.,;:!?…](?:\s|$)").to_numpy(zero_copy_only=False)
        length = pc.utf8_length(lines).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([b.column("row"), make(line_paths(lines), pa.string()), make(length, pa.int32()), make(marks, pa.int32())], ["row", "paths", "length", "marks"])


def marked_pages(df: DataFrame, row: str, text: str) -> DataFrame:
    """(row, paths, length, marks): for each page of two lines or more, arrays with one entry a line."""
    pages = df.select(F.col(row).alias("row"), F.col(text).alias("text")).where(F.col("text").contains("\n"))
    return pages.mapInArrow(_mark, f"row {dict(df.dtypes)[row]}, paths array<string>, length array<int>, marks array<int>")


def path_ratios(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ratios, repeated): per path lines, mean text length and mean punctuation, summed on the map side; and per kind the ends that are repeated.

    A path keeps of the words at its ends only whether one is repeated, so that it is one of a bounded number.
    """
    lines = pages.select(F.explode(F.arrays_zip("paths", "length", "marks")).alias("x")).select("x.*").where("paths is not null")
    full = materialize(lines.groupBy(F.col("paths").alias("path")).agg(F.count("*").alias("n"), F.sum("length").alias("length"), F.sum("marks").alias("marks")), "paths")
    parts = F.split("path", "/", 9)
    named = full.select("n", "length", "marks", parts[6].alias("kind"), parts[7].alias("head"), parts[8].alias("tail"), F.array_join(F.slice(parts, 1, 7), "/").alias("path"))
    per_kind = named.groupBy("kind").agg(F.sum("n").alias("all"))
    sides = named.where("kind <> 'plain'").select("kind", "n", F.explode(F.array(F.struct(F.lit("head").alias("side"), F.col("head").alias("words")), F.struct(F.lit("tail").alias("side"), F.col("tail").alias("words")))).alias("x"))
    often = sides.groupBy("kind", "x.side", "x.words").agg(F.sum("n").alias("own")).join(per_kind, "kind").where(F.col("own") >= REPEATED * F.col("all")).select("kind", "side", "words")
    often = materialize(often, "repeated")
    by = lambda side: often.where(F.col("side") == side).select("kind", F.col("words").alias(side), F.lit(True).alias(f"by_{side}"))
    told = named.join(by("head"), ["kind", "head"], "left").join(by("tail"), ["kind", "tail"], "left").withColumn("repeated", F.coalesce("by_head", "by_tail", F.lit(False)))
    rated = told.groupBy("path", "repeated").agg(F.sum("n").alias("n"), (F.sum("length") / F.sum("n")).alias("length"), (F.sum("marks") / F.sum("n")).alias("marks"))
    return rated, often


def path_score(path: str, repeated: bool, length: float, marks: float) -> float:
    """Content score of a path between 0 and 1: long and punctuated paths are content; paths of separated parts, of bare titles and of repeated furniture are not."""
    _, item, cut, end, size, case, kind = path.split("/")
    ratio = np.tanh(length / 40.0) * np.tanh((marks + 0.2) / 0.7)
    bare = 0.15 if case == "title" or size == "few" else 0.9
    grammar = {"sentence": 1.0, "label": 0.95, "heading": 0.9, "open": bare}[end]
    shape = {"run": 1.0, "pair": 0.95 if end == "sentence" or case == "prose" else 0.5, "list": 0.9 if end in ("sentence", "label") else 0.1}[cut]
    said = 0.0 if kind == "plain" else WORDING[repeated]
    return float((1 - said) * (grammar * shape * (0.65 + 0.35 * ratio) + (0.1 if item == "item" and end == "sentence" else 0.0)))


def smoothed(scores: np.ndarray) -> np.ndarray:
    """Scores with those of the lines around, weighted by distance."""
    total, weight = scores * (1 - 2 * sum(SMOOTH)), np.full(len(scores), 1 - 2 * sum(SMOOTH))
    for d, w in enumerate(SMOOTH, 1):
        if len(scores) > d:
            total[d:] += w * scores[:-d]
            total[:-d] += w * scores[d:]
            weight[d:] += w
            weight[:-d] += w
    return total / weight


def boilerplate_lines(df: DataFrame, row: str, text: str) -> DataFrame:
    """(row, line_no) of every line that belongs to the page and not to its main text."""
    pages = materialize(marked_pages(df, row, text), "pages")
    ratios, repeated = path_ratios(pages)
    table, often = collect_bounded(ratios, MOST_PATHS), collect_bounded(repeated, MOST_PATHS)
    if table is None or often is None:
        raise ValueError(f"more than {MOST_PATHS} paths: the marks of a path must come from a fixed set")
    score = {(r["path"], r["repeated"]): path_score(r["path"], r["repeated"], r["length"], r["marks"]) for r in table}
    score = score, {(r["kind"], r["side"], r["words"]) for r in often}
    shared = df.sparkSession.sparkContext.broadcast(score)
    kind = dict(df.dtypes)[row]

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = shared.value

        def scored(full: str) -> float:
            path, head, tail = full.rsplit("/", 2)
            kind = path.rsplit("/", 1)[1]
            return known[path, kind != "plain" and ((kind, "head", head) in often or (kind, "tail", tail) in often)]

        seen: dict[str, float] = {}
        for b in batches:
            rows, numbers = [], []
            for at, paths in enumerate(b.column("paths").to_pylist()):
                for p in paths:
                    if p is not None and p not in seen:
                        seen[p] = scored(p)
                here = [(i, seen[p]) for i, p in enumerate(paths, 1) if p is not None]
                if not here:
                    continue
                own = np.array([s for _, s in here])
                fused = np.where((own > 0.75) | (own < 0.25), own, smoothed(own))
                for (i, _), s in zip(here, fused, strict=True):
                    if s < THRESHOLD:
                        rows.append(at)
                        numbers.append(i)
            yield pa.RecordBatch.from_arrays([b.column("row").take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int64())], ["row", "line_no"])

    return pages.select("row", "paths").mapInArrow(decide, f"row {kind}, line_no long")


def main_text(df: DataFrame, row: str, text: str) -> DataFrame:
    """(row, main): each page without its furniture; pages of one line stand as they are, null stays null."""
    pages = df.select(F.col(row).alias("row"), F.col(text).alias("text"))
    out = boilerplate_lines(df, row, text).groupBy("row").agg(F.collect_set(F.col("line_no").cast("int")).alias("gone"))
    keep = F.expr("filter(transform(split(text, '\n'), (l, i) -> struct(l as l, i + 1 as n)), x -> not array_contains(coalesce(gone, array()), x.n)).l")
    return pages.join(out, "row", "left").select("row", F.array_join(keep, "\n").alias("main"))
