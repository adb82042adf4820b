"""Near-duplicate records: tiled exact comparison of shingle bitmaps with exclusive-or and bit counts.

Every text becomes the set of its word shingles and a bitmap of them. Two sets of Jaccard similarity t differ in at
most (1-t)/(1+t) of their joint size, and bitmaps differ in no more places than the sets, so that number is a radius
outside of which no pair can lie. Comparing all tiles with all would be quadratic, so texts first fall into blocks by
MinHash bands; within a block, tiles sorted by population count are compared by exclusive-or, and tile pairs whose
counts differ beyond the radius are never formed. Blocks of many rows are cut into tiles that go to different tasks.
What survives is decided on wider bitmaps by linear counting, and on the texts themselves where that is near the
threshold or a bitmap is too full to count.

Cases: rows with too few words are left out; a null title counts as empty; rows with the same words form one class,
compared once and expanded in the result; ties cannot occur, as a pair is given once, smaller id first; empty tables
give no pairs.
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
from ..session import materialize

WIDE, NARROW = 1024, 256
#: A block of more rows than this is cut into tiles of about TILE rows, by population count and then by hash; a row goes to
#: as many pairs of tiles as its block has tiles within the radius, so larger tiles are sent less often.
HOT, TILE = 8000, 4000
COUNT_STEP = 16
#: With more bits than this set in the wide bitmap, so few are left that their number no longer bounds the union.
FULL = WIDE - WIDE // 16


def bands_for(similarity: float, rows: int, missed: float) -> int:
    """How many bands of ``rows`` hashes miss at most the share ``missed`` of the pairs of ``similarity``: from the collision curve 1-(1-s^r)^b."""
    return math.ceil(math.log(missed) / math.log(1 - similarity**rows))


def minhash_bands(offsets: np.ndarray, parts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) 32-bit keys; texts must have a shingle each."""
    out = np.zeros((len(offsets) - 1, bands), np.uint64)
    for band in range(bands):
        for r in range(rows):
            salt = np.uint64((band * rows + r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            with np.errstate(over="ignore"):
                h = (parts ^ salt) * np.uint64(0xD6E8FEB86659FD93)
                h ^= h >> np.uint64(32)
                least = np.minimum.reduceat(h, offsets[:-1])
                out[:, band] = tokens.mix(out[:, band] * np.uint64(0x9E3779B97F4A7C15) + least)
    return (out & np.uint64(0x7FFFFFFF)).astype(np.int32)


def bitmaps(offsets: np.ndarray, parts: np.ndarray, bits: int) -> np.ndarray:
    """(texts, bits/64) words: the bit of each shingle's hash set."""
    docs = len(offsets) - 1
    flat = np.zeros((docs, bits), np.uint8)
    flat[np.repeat(np.arange(docs), np.diff(offsets)), (parts >> np.uint64(20)) % np.uint64(bits)] = 1
    return np.packbits(flat, axis=1).view(np.uint64)


def narrowed(wide: np.ndarray) -> np.ndarray:
    """The bitmap of fewer bits that the same hashes would give: the parts of the wide one laid over each other."""
    return np.bitwise_or.reduce(wide.reshape(len(wide), WIDE // NARROW, NARROW // 64), axis=1)


def radius(sizes: np.ndarray, similarity: float) -> np.ndarray:
    return (1 - similarity) / (1 + similarity) * sizes


def signatures(df: DataFrame, row: str, text: Column, body: Column, least_words: int, shingle: int, bands: int, rows: int) -> DataFrame:
    """(row, h1, h2, size, bands, bits) of the rows whose body has enough words; text is what is compared."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            body_offsets, _ = tokens.word_lists(b.column("body"))
            keep = np.flatnonzero(np.diff(body_offsets) >= least_words)
            if not len(keep):
                continue
            b = b.take(pa.array(keep))
            offsets, words = tokens.word_lists(b.column("text"))
            hashes = tokens.word_hashes(words)
            at = np.arange(len(hashes), dtype=np.uint64) - np.repeat(offsets[:-1], np.diff(offsets)).astype(np.uint64)
            with np.errstate(over="ignore"):
                h1 = np.add.reduceat(tokens.mix(hashes + at * np.uint64(0x9E3779B97F4A7C15)), offsets[:-1])
                h2 = np.add.reduceat(tokens.mix(hashes ^ (at * np.uint64(0xC2B2AE3D27D4EB4F))), offsets[:-1])
            own, parts = tokens.shingle_sets(offsets, hashes, shingle)
            keys = minhash_bands(own, parts, bands, rows)
            bits = bitmaps(own, parts, WIDE)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(np.diff(own).astype(np.int32)), lists, pa.array([x.tobytes() for x in bits], pa.binary())], ["row", "h1", "h2", "size", "bands", "bits"])

    kind = dict(df.dtypes)[row]
    source = df.select(F.col(row).alias("row"), text.alias("text"), body.alias("body"))
    return source.mapInArrow(sign, f"row {kind}, h1 long, h2 long, size int, bands array<int>, bits binary")


def _words(column: pa.Array) -> np.ndarray:
    """Binary values of one length as rows of 64-bit words."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint64).reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.uint64)


def compare_tiles(similarity: float):
    """Exclusive-or and bit count over the rows of each block; rows arrive sorted by block and population."""

    def within(t: pa.Table) -> pa.RecordBatch:
        key, ident, side = (t.column(c).to_numpy() for c in ("slot", "row", "side"))
        size, bits = t.column("size").to_numpy().astype(np.int64), _words(t.column("bits").combine_chunks())
        left, right = [], []
        at = np.arange(len(key))
        step = 1
        while True:
            at = at[at + step < len(key)]
            # rows are sorted by size: once a row's partner is beyond the radius, so are all further ones
            at = at[(key[at] == key[at + step]) & (size[at + step] - size[at] <= radius(size[at] + size[at + step], similarity))]
            if not len(at):
                break
            ok = (side[at] != side[at + step]) | (side[at] == 0)
            i, j = at[ok], at[ok] + step
            hit = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1) <= radius(size[i] + size[j], similarity)
            left.append(ident[i[hit]])
            right.append(ident[j[hit]])
            step += 1
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            key = b.column("slot").to_numpy()
            first = int(np.searchsorted(key == key[-1], True))  # the last block may go on in the next batch
            if first == 0 and rest and rest[-1].column("slot")[0].as_py() == key[-1]:
                rest.append(b)
                continue
            if rest or first:
                yield within(pa.Table.from_batches([*rest, b.slice(0, first)]))
            rest = [b.slice(first)]
        if rest:
            yield within(pa.Table.from_batches(rest))

    return run


def blocks(signed: DataFrame, similarity: float) -> DataFrame:
    """(slot, side, row, size, bits): the rows of every block, hot blocks cut into pairs of tiles.

    ``side`` is 0 in a block or tile compared with itself, 1 and 2 in a pair of tiles of which only pairs across count.
    """
    keyed = signed.select("row", "size", "bits", F.posexplode("bands").alias("band", "key")).withColumn("key", F.col("band").cast("long") * F.lit(1 << 31) + F.col("key")).drop("band")
    counts = signed.select("size", F.posexplode("bands").alias("band", "key")).groupBy((F.col("band").cast("long") * F.lit(1 << 31) + F.col("key")).alias("key")).count()
    hot = materialize(counts.where(F.col("count") > HOT).select("key", F.ceil(F.col("count") / TILE).cast("int").alias("tiles")), "hot")
    plain = lambda d: d.select(F.col("key").alias("slot"), F.lit(0).alias("side"), "row", "size", "bits")
    if not hot.take(1):
        return plain(keyed)
    cool = plain(keyed.join(hot, "key", "left_anti"))
    # a tile is a range of population counts and a share of its rows; only tiles within the radius of each other meet
    tiled = keyed.join(hot, "key").withColumn("step", F.floor(F.col("size") / COUNT_STEP).cast("int")).withColumn("part", F.pmod(F.xxhash64("row"), F.col("tiles")).cast("int"))
    tiled = tiled.withColumn("tile", F.col("step").cast("long") * F.lit(1 << 32) + F.col("part"))
    others = F.expr(
        f"filter(flatten(transform(sequence(cast(floor(step * {similarity}) as int) - 1, cast(ceil((step + 1) / {similarity}) as int) + 1), s -> transform(sequence(0, tiles - 1), p -> cast(s as bigint) * {1 << 32} + p))), t -> t >= 0)"
    )
    met = tiled.withColumn("other", F.explode(others))
    slot = F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other"))
    side = F.when(F.col("tile") == F.col("other"), 0).when(F.col("tile") < F.col("other"), 1).otherwise(2)
    return cool.unionByName(met.select(slot.alias("slot"), side.alias("side"), "row", "size", "bits"))


def decide(similarity: float):
    """Keep, drop or send on: linear counting on the wide bitmaps, with four standard errors of doubt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            both = b.column("size_a").to_numpy().astype(float) + b.column("size_b").to_numpy()
            used = np.minimum(np.bitwise_count(_words(b.column("bits_a")) | _words(b.column("bits_b"))).sum(axis=1), WIDE - 1)
            union = -WIDE * np.log(1 - used / WIDE)
            load = union / WIDE
            doubt = 4 * np.sqrt(WIDE * (np.exp(load) - load - 1)) + 2
            estimate = lambda u: both / np.maximum(u, both / 2) - 1  # noqa: B023, E731
            told = used <= FULL  # a fuller bitmap says nothing of the union: only the texts do
            sure, never = told & (estimate(union + doubt) >= similarity), told & (estimate(np.maximum(union - doubt, 1)) < similarity)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(sure)], ["a", "b", "sure"]).filter(pa.array(~never))

    return run


def verify(similarity: float, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = []
            for c in ("text_a", "text_b"):
                offsets, words = tokens.word_lists(b.column(c))
                sets.append(tokens.shingle_sets(offsets, tokens.word_hashes(words), shingle))
            (oa, a), (ob, c) = sets
            keep = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                p, q = a[oa[i] : oa[i + 1]], c[ob[i] : ob[i + 1]]
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep[i] = both >= similarity * (len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep))

    return run


def class_links(df: DataFrame, row: str, text: Column, body: Column, least_words: int, shingle: int, similarity: float, certain: float | None = None, rows: int = 3, missed: float = 2e-5) -> tuple[DataFrame, DataFrame]:
    """(links between classes, membership): links (a, b) between the least rows of two classes of equal words, a < b; membership (row, class).

    ``certain`` is the similarity at which the bands miss at most the share ``missed``; by default the threshold.
    """
    bands = bands_for(certain or similarity, rows, missed)
    kind = dict(df.dtypes)[row]
    signed = materialize(signatures(df, row, text, body, least_words, shingle, bands, rows), "signed")
    classes = signed.groupBy("h1", "h2", "size").agg(F.min("row").alias("class"))
    membership = materialize(signed.select("row", "h1", "h2", "size").join(classes, ["h1", "h2", "size"]).select("row", "class"), "members")
    heads = signed.join(membership.where("row = class").select("row"), "row", "left_semi")

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                bits = narrowed(_words(b.column("bits")))
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("size"), b.column("bands"), pa.array([x.tobytes() for x in bits], pa.binary())], ["row", "size", "bands", "bits"])

    slim = heads.select("row", "size", "bands", "bits").mapInArrow(narrow, f"row {kind}, size int, bands array<int>, bits binary")
    met = blocks(slim, similarity).repartition("slot").sortWithinPartitions("slot", "size")
    near = materialize(met.mapInArrow(compare_tiles(similarity), f"a {kind}, b {kind}").distinct(), "near")
    side = lambda x: signed.select(F.col("row").alias(x), F.col("size").alias(f"size_{x}"), F.col("bits").alias(f"bits_{x}"))
    judged = materialize(near.join(side("a"), "a").join(side("b"), "b").mapInArrow(decide(similarity), f"a {kind}, b {kind}, sure boolean"), "judged")
    doubtful = judged.where("not sure").select("a", "b")
    texts = df.select(F.col(row).alias("row"), text.alias("text"))
    with_text = doubtful.join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
    checked = with_text.mapInArrow(verify(similarity, shingle), f"a {kind}, b {kind}")
    return judged.where("sure").select("a", "b").unionByName(checked), membership


def expand(links: DataFrame, membership: DataFrame) -> DataFrame:
    """(row_id_a, row_id_b): all pairs of rows from linked classes and from within a class, smaller id first."""
    of = lambda x, r: membership.select(F.col("class").alias(x), F.col("row").alias(r))
    across = links.join(of("a", "p"), "a").join(of("b", "q"), "b").select("p", "q")
    inside = of("a", "p").join(of("a", "q"), "a").where("p < q").select("p", "q")
    return across.unionByName(inside).select(F.least("p", "q").alias("row_id_a"), F.greatest("p", "q").alias("row_id_b"))
