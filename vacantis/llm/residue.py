"""Template residue, filler and error-page text in place of content.

Trusted labels are an input: a list of notices, each in one wording, of which some have a gap. They spread through the
corpus by near-duplicates: texts meet in partitioned SimHash tables, are verified by Hamming distance and by text
similarity, and every text of a component that holds a trusted label takes it. A text that is nothing but labelled
texts one after another, or a name followed by one, takes the label too and spreads it further, until no text joins.
Fields with an unfilled template field carry a trusted label of their own, found by the marks of template engines;
it does not spread, as the near-duplicate of such a text is the same text with the field filled.

Texts are compared as words without case, signs and numbers. Of SHORT words or fewer, similarity is that of letter
trigrams, as one edit changes most five-word shingles of a short text; of LONG or more it is that of five-word
shingles; both must be 0.8 or more, and texts between are compared both ways. Repeated shingles count as often as they occur,
so the length of a text bounds the lengths of those like it and all others need no fingerprint. ``recall`` gives the
collision curve: 64 tables of 16 bits find 0.99 of the pairs at 0.8, 128 find 0.9999.

Cases: null, empty and blank fields are never reported; rows repeated whole are reported each; texts without letters
or digits take part in nothing; an empty list of labels leaves the template fields; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tokens
from ..operators.components import connected_components
from ..session import materialize

SHINGLE = 5
SHORT, LONG = 32, 20
KEY_BITS = 16
#: Similarity and number of tables, by letters for short texts and by words for long ones.
SIMILARITY = (0.8, 0.8)
TABLES = (64, 128)
#: Results of so many rounds stay apart before they are written as one.
PARTS = 10

# fixed values: the ways template engines write a field; the name stands in the group
STRONG = r"\{\{\{?\s*([A-Za-z][\w .\-]{0,40}?)\s*\}\}|\$\{\s*([A-Za-z][\w .\-]{0,40}?)\s*\}|\[\[\s*([A-Za-z][\w .\-]{0,40}?)\s*\]\]|\{%-?\s*([A-Za-z][\w .\-]{0,40}?)\s*-?%\}|%\(([A-Za-z][\w .\-]{0,40}?)\)[sd]|<<\s*([A-Za-z][\w .\-]{0,40}?)\s*>>|@@([A-Za-z][\w .\-]{0,40}?)@@|\b__([A-Za-z][\w .\-]{0,40}?)__|<%=?\s*([A-Za-z][\w .\-]{0,40}?)\s*%>|#\{\s*([A-Za-z][\w .\-]{0,40}?)\s*\}|\*\|([A-Za-z][\w .\-]{0,40}?)\|\*"
WEAK = r"\{\s*([A-Za-z][\w .\-]{0,40}?)\s*\}|\[\s*([A-Za-z][\w .\-]{0,40}?)\s*\]|<\s*([A-Za-z][\w .\-]{0,40}?)\s*>|#([A-Za-z][\w .\-]{0,40}?)#|\$([A-Za-z][\w .\-]{0,40}?)\$|%([A-Za-z][\w .\-]{0,40}?)%"
UNCLOSED = r"(?:\{\{|\$\{|\[\[|\{%|%\(|<<|@@)\s*[A-Za-z][\w .]{0,40}(?:…|\.\.\.)?$"
# fixed values: words that name a field of a vacancy template
FIELD_WORDS = "company name employer location city date role title job department salary max min years experience start end apply link contact email phone studio position description category deadline url".split()

# fixed values: the vocabulary of the usual Latin filler
LATIN = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
FILLER = "lorem ipsum dolor".split()

# fixed values: trusted labels, one wording each; … is a gap of up to GAP letters
TRUSTED = """
lorem ipsum dolor | blah blah | blah blah … blah | asdf asdf | qwerty qwerty | foo bar | xx xx | xx xxx xxxx | zz zz | test test | test test please ignore | please ignore
test entry | test post | test job | test vacancy | do not publish | sample post | sample title | your text here | your content here | text goes here | content goes here
job title goes here | position title placeholder | enter job description here | type something about the vacancy | sample description for … to be replaced
this is dummy copy used only to check the layout | placeholder text | todo write the posting | untitled | untitled document | new job posting copy | undefined | null null | nan | object object
error 404 | 404 not found | 404 page not found | page not found | 403 forbidden | you do not have permission to view this resource | bad gateway | 502 bad gateway | the upstream host gave no valid answer
500 internal server error | 503 service temporarily unavailable | 503 service unavailable | 504 gateway timeout | please try again in 5 minutes | please try again later
error 404 the page you requested could not be located on this server | sorry this listing is no longer available or the link has moved | page unavailable | this page isn't working right now
oops something went wrong on our side | something went wrong | your connection was interrupted request timed out 30 ms | database connection failed at line 10 | fatal error uncaught typeerror in render on line 10
access denied | reference number 10 | the requested url was rejected | your support id is 10 | too many requests | slow down and retry after 10 s | session expired kindly log in again to see the content
domain parked | this name may be for sale | site under maintenance back at 10 o'clock | attention required | just a moment | verifying that you are human
checking your browser before accessing the site | this takes up to 5 seconds | loading please wait | loading if nothing happens check that scripts are allowed
please enable javascript | please enable scripts | please enable cookies | please enable javascript to view this page | javascript is disabled in your browser | turn it on and reload to continue
you need a browser with scripts switched on to run this app | this site needs javascript to run
"""
GAP = 80
OWNER = r"^[^\n]{2,80}?(?::| [–-]) "  # the firm or host that a notice names first
NODE = "id long, words int, letters int, head long, heads long, text string"


def trusted_labels() -> list[str]:
    return [s.strip() for line in TRUSTED.strip().splitlines() for s in line.split("|")]


def recall(similarity: float, tables: int, bits: int = KEY_BITS) -> float:
    """The share of pairs of a similarity that meet in a table: bits agree with chance 1 - angle / pi."""
    return 1 - (1 - (1 - _angle(similarity)) ** bits) ** tables


def _angle(similarity: float) -> float:
    """The chance that one bit differs; 2s/(1+s) is the least cosine of two sets of Jaccard similarity s."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def _counted(offsets: np.ndarray, parts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes), ascending in each text; the second and further of equal hashes get one of their own."""
    order = np.lexsort((parts, owner))
    owner, parts = owner[order], parts[order]
    new = np.ones(len(parts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (parts[1:] != parts[:-1])
    at = np.arange(len(parts))
    nth = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    with np.errstate(over="ignore"):
        parts = np.where(new, parts, tokens.mix(parts + nth * np.uint64(0x9E3779B97F4A7C15)))
    order = np.lexsort((parts, owner))
    return np.searchsorted(owner, np.arange(len(offsets))), parts[order]


def features(texts: pa.Array, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Letter trigrams (kind 0) or five-word shingles (kind 1) of texts already in reading form."""
    if kind:
        offsets, words = tokens.word_lists(texts)
        start, h = tokens.run_hashes(offsets, tokens.word_hashes(words), tuple(range(SHINGLE)))
        return _counted(offsets, h, np.searchsorted(offsets, start, side="right") - 1)
    joined = "".join(f"\x02{t}\x03" for t in texts.to_pylist())
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.cumsum(codes == 2) - 1
    with np.errstate(over="ignore"):
        h = tokens.mix((codes[:-2] << np.uint64(42)) ^ (codes[1:-1] << np.uint64(21)) ^ codes[2:])
    own = owner[:-2] == owner[2:]
    return _counted(np.zeros(len(texts) + 1, np.int64), h[own], owner[:-2][own])


def fingerprints(offsets: np.ndarray, parts: np.ndarray, tables: int) -> np.ndarray:
    """(texts, tables) keys of KEY_BITS bits: the SimHash of each text, cut into the parts that key the tables."""
    docs = len(offsets) - 1
    out = np.zeros((docs, tables * KEY_BITS // 8), np.uint8)
    size = np.diff(offsets)
    some = np.flatnonzero(size)
    for lo in range(0, len(some), 2000):
        own = some[lo : lo + 2000]
        a, z = offsets[own[0]], offsets[own[-1] + 1]
        for word in range(tables * KEY_BITS // 64):
            with np.errstate(over="ignore"):
                h = tokens.mix(parts[a:z] ^ np.uint64((word + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            bits = np.unpackbits(h.view(np.uint8)).reshape(-1, 64)
            ones = np.add.reduceat(bits, offsets[own] - a, axis=0, dtype=np.int32)
            out[own, word * 8 : word * 8 + 8] = np.packbits(2 * ones > size[own, None], axis=1)
    return out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in reading form: words, numbers as 0, runs of Latin filler as one, a word said over and over as twice."""
    for b in batches:
        text = pc.replace_substring_regex(pc.fill_null(b.column("text"), ""), pattern=r"\([^()\n]*[0-9][^()\n]*\)([\s\p{P}\p{S}]*)$", replacement=r" \1")
        text = pc.replace_substring_regex(pc.replace_substring_regex(text, pattern=r"['’]", replacement=""), pattern=r"([0-9])[.,:]([0-9])", replacement=r"\1\2")
        offsets, words = tokens.word_lists(text, mask_digits=True)
        words = pc.replace_substring_regex(words, pattern=r"^(x{2,}|z{2,})$", replacement="xx") if len(words) else words
        owner = np.repeat(np.arange(b.num_rows), np.diff(offsets))
        latin = pc.is_in(words, pa.array(LATIN)).to_numpy(zero_copy_only=False)
        begins = np.ones(len(words) + 1, bool)
        begins[1:-1] = (latin[1:] != latin[:-1]) | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(begins)
        run = np.repeat(np.diff(starts), np.diff(starts))
        place = np.arange(len(words)) - np.repeat(starts[:-1], np.diff(starts))
        filler = latin & (run >= 3)
        if filler.any():
            put = np.array(FILLER, dtype=object)[np.minimum(place, 2)]
            words = pc.if_else(pa.array(filler), pa.array(put, pa.string()), words)
        h = tokens.word_hashes(words)
        keep = ~(filler & (place >= 3))
        keep[2:] &= ~((h[2:] == h[1:-1]) & (h[2:] == h[:-2]) & (owner[2:] == owner[:-2]))
        kept = np.concatenate([[0], np.cumsum(keep)])
        offsets, h, words = kept[offsets], h[keep], words.filter(pa.array(keep))
        size = np.diff(offsets)
        some = np.flatnonzero(size)
        first = h[offsets[:-1][some]]
        second = h[np.minimum(offsets[:-1][some] + 1, max(len(h) - 1, 0))]
        with np.errstate(over="ignore"):
            at = (np.arange(len(h)) - np.repeat(offsets[:-1], size)).astype(np.uint64)
            ident = np.add.reduceat(tokens.mix(h + at * np.uint64(0xC2B2AE3D27D4EB4F)), offsets[:-1][some]) if len(some) else np.zeros(0, np.uint64)
            two = tokens.mix(first * np.uint64(0x9E3779B97F4A7C15) + second)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), words), " ").take(pa.array(some))
        cols = [pa.array(ident.view(np.int64)), pa.array(size[some].astype(np.int32)), pc.cast(pc.utf8_length(joined), pa.int32()), pa.array(first.view(np.int64)), pa.array(two.view(np.int64)), joined]
        rest = [c for c in b.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([b.column(c).take(pa.array(some)) for c in rest] + cols, [*rest, "id", "words", "letters", "head", "heads", "text"])


def read(df: DataFrame) -> DataFrame:
    """The columns of ``df`` with its text in reading form, the text's id and its length; texts without words go."""
    kept = [c for c in df.columns if c != "text"]
    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != "text"] + [NODE])
    return df.select(*kept, "text").mapInArrow(_read, kinds)


def _prints(kind: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets, parts = features(b.column("text"), kind)
            bits = fingerprints(offsets, parts, TABLES[kind])
            keys = bits.view(np.uint16).astype(np.int32) + (np.arange(TABLES[kind], dtype=np.int32) << KEY_BITS)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, TABLES[kind], dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.diff(offsets).astype(np.int32)), lists, pa.array([x.tobytes() for x in bits], pa.binary()), b.column("text")], ["id", "size", "keys", "bits", "text"]).filter(pa.array(np.diff(offsets) > 0))

    return run


def _similar(kind: int):
    """Hamming distance first, then similarity of the texts' features: one sorted merge for all pairs of a batch."""
    bits, chance = TABLES[kind] * KEY_BITS, _angle(SIMILARITY[kind])
    radius = bits * chance + 4 * math.sqrt(bits * chance * (1 - chance))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("bits_a", "bits_b"))
            near = np.flatnonzero(np.bitwise_count(x ^ y).sum(axis=1) <= radius)
            b = b.take(pa.array(near))
            (oa, p), (ob, q) = features(b.column("text_a"), kind), features(b.column("text_b"), kind)
            owner = np.concatenate([np.repeat(np.arange(len(near)), np.diff(oa)), np.repeat(np.arange(len(near)), np.diff(ob))])
            both = np.concatenate([p, q])
            order = np.lexsort((both, owner))
            same = (owner[order][1:] == owner[order][:-1]) & (both[order][1:] == both[order][:-1])
            shared = np.bincount(owner[order][1:][same], minlength=len(near))
            keep = shared >= SIMILARITY[kind] * (np.diff(oa) + np.diff(ob) - shared) - 1e-9
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep))

    return run


class _Prints:
    """Fingerprints of the texts whose length the frontier can reach; a wider reach adds those not yet taken."""

    def __init__(self, rows: DataFrame, kind: int) -> None:
        self.rows, self.kind, self.reach, self.parts = rows, kind, None, []

    def of(self, texts: DataFrame) -> DataFrame:
        return texts.select("id", "text").mapInArrow(_prints(self.kind), "id long, size int, keys array<int>, bits binary, text string")

    def within(self, low: int, high: int) -> DataFrame:
        own = F.col("words") >= LONG if self.kind else F.col("words") <= SHORT
        # features of a text: its letters, or its words less four; s of the larger at least in the smaller
        off, share = (1 - SHINGLE, SIMILARITY[1]) if self.kind else (0, SIMILARITY[0])
        size = F.col("words" if self.kind else "letters") + off
        low, high = math.floor((low + off) * share), math.ceil((high + off) / share)
        cond = own & size.between(low, high)
        if self.reach:
            low, high = min(low, self.reach[0]), max(high, self.reach[1])
            cond = own & size.between(low, high) & ~size.between(*self.reach)
        if not self.reach or (low, high) != self.reach:
            self.parts.append(materialize(self.of(self.rows.where(cond).dropDuplicates(["id"])), "prints"))
            self.reach = (low, high)
        out = self.parts[0]
        for p in self.parts[1:]:
            out = out.unionByName(p)
        return out


def _spread(rows: DataFrame, start: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(taken, links): ``rows`` and ``start`` are nodes; grows from ``start`` by near-duplicates until no text joins."""
    spark = rows.sparkSession
    prints = [_Prints(rows, kind) for kind in range(2)]
    taken = frontier = start
    links, parts = spark.createDataFrame([], "a long, b long"), 0
    while True:
        span = frontier.agg(*[f(F.when(F.col("words") <= SHORT, F.col("letters"))) for f in (F.min, F.max)], *[f(F.when(F.col("words") >= LONG, F.col("words"))) for f in (F.min, F.max)]).first()
        found = None
        for kind, (low, high) in enumerate([span[:2], span[2:]]):
            if low is None:
                continue
            every = prints[kind].within(low, high)
            own = materialize(prints[kind].of(frontier.where(F.col("words") >= LONG if kind else F.col("words") <= SHORT)), "front")
            far = every.join(taken.select("id"), "id", "left_anti")
            near = own.select(F.col("id").alias("a"), F.col("size").alias("size_a"), F.explode("keys").alias("key"))
            met = near.join(far.select(F.col("id").alias("b"), F.col("size").alias("size_b"), F.explode("keys").alias("key")), "key")
            met = met.where(f"least(size_a, size_b) >= {SIMILARITY[kind]} * greatest(size_a, size_b)").select("a", "b").distinct()
            side = lambda d, x: d.select(F.col("id").alias(x), F.col("bits").alias(f"bits_{x}"), F.col("text").alias(f"text_{x}"))
            pairs = met.join(side(own, "a"), "a").join(side(every, "b"), "b").select("a", "b", "bits_a", "bits_b", "text_a", "text_b").mapInArrow(_similar(kind), "a long, b long")
            found = pairs if found is None else found.unionByName(pairs)
        if found is None:  # no text joined in the last round
            return taken, links
        found = materialize(found.distinct(), "links")
        links, parts = links.unionByName(found), parts + 1
        if parts > PARTS:  # a long chain would make the plan grow with every round
            links, parts = materialize(links, "links"), 1
        frontier = materialize(rows.join(found.select(F.col("b").alias("id")).distinct(), "id", "left_semi").dropDuplicates(["id"]).select(*start.columns), "frontier")
        taken = taken.unionByName(frontier)
        if parts == 1:
            taken = materialize(taken, "labelled")


def spread_labels(texts: DataFrame, labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Grow components from labelled texts: (ids that take the label, verified links).

    ``texts``: (id, text), ids distinct. ``labelled``: (id). Each round matches only the texts that joined in the round
    before against those without a label, so its cost follows the labelled part. It ends when no text joins.
    """
    nodes = materialize(read(texts.withColumnRenamed("id", "own")), "nodes")
    start = materialize(nodes.join(labelled.select(F.col("id").alias("own")).distinct(), "own", "left_semi").drop("own").dropDuplicates(["id"]), "start")
    taken, links = _spread(nodes.drop("own"), start)
    key = nodes.groupBy("id").agg(F.min("own").alias("own"))
    of = lambda x: key.select(F.col("id").alias(x), F.col("own").alias(f"own_{x}"))
    linked = links.join(of("a"), "a").join(of("b"), "b").select(F.col("own_a").alias("a"), F.col("own_b").alias("b"))
    return nodes.join(taken.select("id"), "id", "left_semi").select(F.col("own").alias("id")).distinct(), linked


def _composed(rows: DataFrame, fresh: DataFrame, gaps: list[tuple[str, str]] | None, pending: DataFrame | None, taken: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(composed, pending): texts that are labelled texts one after another: (id, by), and what remains of those begun: (id, by, rest).

    A text that begins with a labelled one meets it by its first word or first two words; what follows must be
    labelled, or begin with a labelled text in turn.
    """
    starts = fresh.select(F.col("id").alias("by"), F.when(F.col("words") == 1, F.col("head")).otherwise(F.col("heads")).alias("key"), F.col("text").alias("begin"), (F.col("words") == 1).alias("one"))
    unlabelled = rows.where("words > 1").join(taken.select("id"), "id", "left_anti")
    cut = F.expr("substring(text, length(begin) + 2)")
    begun = None
    for one in (True, False):
        key = "head" if one else "heads"
        met = unlabelled.withColumnRenamed(key, "key").join(starts.where(F.col("one") == one), "key").where("startswith(text, concat(begin, ' '))").select("id", "by", cut.alias("rest"))
        begun = met if begun is None else begun.unionByName(met)
    if pending is not None:
        begun = begun.unionByName(pending)
    begun = materialize(begun.distinct(), "begun")
    whole = taken.select(F.col("text").alias("rest"))
    out, open_ = begun.join(whole, "rest", "left_semi").select("id", "by"), begun
    while True:  # a third and further piece
        first = taken.select(F.col("text").alias("begin"), F.regexp_extract("text", r"^\S+", 0).alias("word"))
        open_ = open_.withColumn("word", F.regexp_extract("rest", r"^\S+", 0)).join(first, "word").where("startswith(rest, concat(begin, ' '))").select("id", "by", F.expr("substring(rest, length(begin) + 2)").alias("rest"))
        open_ = materialize(open_.distinct(), "begun")
        if not open_.take(1):
            break
        out = out.unionByName(open_.join(whole, "rest", "left_semi").select("id", "by"))
    for head, tail in gaps or []:
        between = F.length("text") - len(head) - len(tail)
        out = out.unionByName(unlabelled.where(F.col("text").startswith(head + " ") & F.col("text").endswith(" " + tail) & between.between(2, GAP)).select("id", F.lit(0).cast("long").alias("by")))
    return materialize(out.groupBy("id").agg(F.min("by").alias("by")), "composed"), begun


def labelled_texts(rows: DataFrame, trusted: list[str]) -> tuple[DataFrame, DataFrame]:
    """(taken, links) of the nodes that take a label of ``trusted``: spread and put together in turn until no text joins."""
    spark = rows.sparkSession
    plain = [t for t in trusted if "…" not in t]
    given = materialize(read(spark.createDataFrame([(t,) for t in plain], "text string")).dropDuplicates(["id"]), "trusted")
    holes = [tuple(x["text"] for x in read(spark.createDataFrame([(p,) for p in t.split("…")], "text string").coalesce(1)).collect()) for t in trusted if "…" in t]
    taken = fresh = given
    links, pending, gaps, rounds = spark.createDataFrame([], "a long, b long"), None, holes, 0
    while True:
        grown, more = _spread(rows, fresh)
        links = links.unionByName(more)
        taken = materialize(taken.unionByName(grown.join(taken.select("id"), "id", "left_anti")), "taken")
        composed, pending = _composed(rows, grown, gaps, pending, taken)
        gaps = None
        links, rounds = links.unionByName(composed.select(F.col("by").alias("a"), F.col("id").alias("b"))), rounds + 1
        if rounds % PARTS == 0:
            links = materialize(links, "links")
        fresh = materialize(rows.join(composed.select("id"), "id", "left_semi").join(taken.select("id"), "id", "left_anti").select(*given.columns).dropDuplicates(["id"]), "fresh")
        if not fresh.take(1):
            return taken, links
        taken = materialize(taken.unionByName(fresh), "taken")


def field_words_only(name: Column) -> Column:
    """The name of a weakly marked field is made of the words that name fields, or is written as an identifier."""
    words = F.filter(F.split(F.lower(name), r"[\s_.\-]+"), lambda w: w != "")
    return (F.size(F.array_except(words, F.array(*[F.lit(w) for w in FIELD_WORDS]))) == 0) | name.rlike(r"^[a-z]+[_.][a-z_.]+$")


def template_fields(values: DataFrame) -> DataFrame:
    """(row, field) of the values with an unfilled template field.

    Marks that only templates use are taken as they are; marks that also occur in ordinary writing count where the
    name inside is one that stands in a template mark elsewhere in the corpus, or names a field by its own words.
    """
    some = values.where(F.col("text").rlike(r"\{\{|\$\{|\[\[|\{%|%\(|<<|@@|__|<%|#\{|\*\||[\[{<#$%]\s?[A-Za-z]"))
    marks = some.select("row", "field", F.col("text").rlike(f"{STRONG}|{UNCLOSED}").alias("strong"), "text")

    def names(pattern: str, groups: int) -> Column:
        whole = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        return F.transform(whole, lambda m: F.regexp_replace(m, r"^\W+|_{2,}|\)[sd]$|\W+$", ""))

    marks = materialize(marks.select("row", "field", "strong", F.when(F.col("strong"), names(STRONG, 11)).alias("in_strong"), F.when(~F.col("strong"), names(WEAK, 6)).alias("in_weak")), "marks")
    sure = marks.where("strong").select("row", "field")
    known = marks.where("strong").select(F.explode("in_strong").alias("name")).select(F.lower("name").alias("name")).distinct()
    weak = marks.where("not strong").select("row", "field", F.explode("in_weak").alias("name"))
    spelled = weak.where(field_words_only(F.col("name"))).select("row", "field")
    learned = weak.withColumn("name", F.lower("name")).join(known, "name", "left_semi").select("row", "field")
    return sure.unionByName(spelled).unionByName(learned).distinct()


def values_of(df: DataFrame, row: str, fields: list[str]) -> DataFrame:
    per = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])
    return df.select(F.col(row).alias("row"), F.explode(per).alias("x")).select("row", "x.field", "x.text").where(F.col("text").rlike(r"\S"))


def _labelled(values: DataFrame, trusted: list[str] | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes of the values, taken, links): a value is a node, and so is what follows the name at its beginning."""
    rest = F.when(F.col("text").rlike(OWNER), F.regexp_replace("text", OWNER, ""))
    both = values.select("row", "field", F.explode(F.array_compact(F.array("text", rest))).alias("text"))
    rows = materialize(read(both), "nodes")
    return rows, *labelled_texts(rows.drop("row", "field"), trusted_labels() if trusted is None else trusted)


def residue_fields(df: DataFrame, row: str, fields: list[str], trusted: list[str] | None = None) -> DataFrame:
    """(row, field) of the fields with template residue, filler or a notice in place of content."""
    values = values_of(df, row, fields)
    rows, taken, _ = _labelled(values, trusted)
    whole = rows.join(taken.select("id"), "id", "left_semi").select("row", "field")
    return whole.unionByName(template_fields(values)).distinct()


def residue_groups(df: DataFrame, row: str, fields: list[str], trusted: list[str] | None = None) -> DataFrame:
    """(row, field, group) of the fields that took a label, by component of the verified links; a text without links is its own."""
    rows, taken, links = _labelled(values_of(df, row, fields), trusted)
    groups = connected_components(taken.select(F.col("id").alias("a"), F.col("id").alias("b")).unionByName(links))
    return rows.join(groups, F.col("id") == F.col("node")).groupBy("row", "field").agg(F.min("component").alias("group"))
