"""Evaluation texts inside a training corpus, by spaced-seed hashing.

Fixed masks lay over the words of items and documents; the words a mask keeps are hashed and the rest ignored, so a
replaced word leaves other windows intact. Documents whose hashes meet those of an item under any mask are verified
around the hits: how much of the item is covered when substituted words are tolerated, and how many of its different
runs of consecutive words stand in the document. Either share decides: an item with every fourth word replaced holds no
run of four and is found by the masks with gaps alone. The mask without gaps is among the masks, so no document that
holds a run of an item is missed.

Cases: null and empty texts hold nothing; items of fewer words than a run are never found; items with equal text are
found each; repeated documents are reported each; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tokens

RUN = 4
# fixed values: the masks, as the positions of the words that count
MASKS = ((0, 1, 2, 3), (0, 1, 3, 4), (0, 2, 3, 5), (0, 1, 4, 6))
#: Items are matched in blocks of about so many; the index of a block goes to every worker, so its size is bounded.
BLOCK = 20_000
#: Windows of items that are held at once; more are taken document by document.
LOAD = 4_000_000
#: Share of an item's words that must be covered where substituted words are tolerated.
TOLERANT = 0.7


class ItemIndex:
    """Hashes of a block of items under every mask, sorted, with the item and place of each."""

    def __init__(self, ids: list, texts: list[str]) -> None:
        self.ids = ids
        offsets, words = tokens.word_lists(pa.array(texts, pa.string()))
        hashes = tokens.word_hashes(words)
        self.length = np.diff(offsets)
        self.tables = []
        for mask in MASKS:
            start, h = tokens.run_hashes(offsets, hashes, mask)
            item = np.searchsorted(offsets, start, side="right") - 1
            order = np.argsort(h, kind="stable")
            self.tables.append((h[order], item[order], (start - offsets[item])[order]))
        h, item, _ = self.tables[0]
        first = np.unique(np.stack([item.astype(np.uint64), h]), axis=1) if len(h) else np.zeros((2, 0), np.uint64)
        self.runs = np.bincount(first[0].astype(np.int64), minlength=len(ids))

    def met(self, which: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into h, number of items' windows) of the hashes that occur in the index."""
        keys = self.tables[which][0]
        low, high = np.searchsorted(keys, h, side="left"), np.searchsorted(keys, h, side="right")
        some = np.flatnonzero(high > low)
        return some, (high - low)[some]

    def windows(self, which: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index into h, item, place in the item) of every equal hash."""
        keys, item, place = self.tables[which]
        some, n = self.met(which, h)
        low = np.searchsorted(keys, h[some], side="left")
        at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.repeat(some, n), item[at], place[at]


def document_hits(index: ItemIndex, texts: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each mask (document, hash) of the different hashes met, by document; and how many windows of items each document meets."""
    offsets, words = tokens.word_lists(texts)
    hashes = tokens.word_hashes(words)
    out, load = [], np.zeros(len(texts), np.int64)
    for which, mask in enumerate(MASKS):
        start, h = tokens.run_hashes(offsets, hashes, mask)
        some, n = index.met(which, h)
        doc = np.searchsorted(offsets, start[some], side="right") - 1
        order = np.lexsort((h[some], doc))
        doc, own, n = doc[order], h[some][order], n[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (own[1:] != own[:-1])
        out.append((doc[new], own[new]))
        load += np.bincount(doc[new], n[new], minlength=len(texts)).astype(np.int64)
    return out, load


def shares(index: ItemIndex, hits: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, share of the item's runs, share of its words covered) for every document and item that meet."""
    width = int(index.length.max()) + 1 if len(index.length) else 1
    runs, cells = np.zeros(0, np.int64), []
    for which, (doc, h) in enumerate(hits):
        at, item, place = index.windows(which, h)
        key = doc[at].astype(np.int64) * len(index.ids) + item
        if which == 0:  # equal runs at two places of an item count once
            order = np.lexsort((h[at], key))
            k, own = key[order], h[at][order]
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (own[1:] != own[:-1])
            runs = k[new]
        cells += [key * width + place + m for m in MASKS[which]]
    cell = np.unique(np.concatenate(cells))
    found, covered = np.unique(cell // width, return_counts=True)
    of_run = np.bincount(np.searchsorted(found, runs), minlength=len(found))
    doc, item = np.divmod(found, max(len(index.ids), 1))
    return doc, item, of_run / np.maximum(index.runs[item], 1), covered / np.maximum(index.length[item], 1)


def match_batch(index: ItemIndex, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``shares`` of the texts, a slice of documents at a time, so that a phrase of many items costs no more than LOAD windows at once."""
    hits, load = document_hits(index, texts)
    part = np.cumsum(load) // LOAD
    out = []
    for p in np.unique(part[load > 0]):
        lo, hi = np.searchsorted(part, [p, p + 1])
        own = [(d[(d >= lo) & (d < hi)], h[(d >= lo) & (d < hi)]) for d, h in hits]
        out.append(shares(index, own))
    if not out:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),) * 2
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def leaks(docs: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str, share: float = 0.5, tolerant: float = TOLERANT) -> DataFrame:
    """(doc, item, run_share, word_share) for each document that holds at least ``share`` of an item's different runs, or covers ``tolerant`` of its words."""
    kinds = f"doc {dict(docs.dtypes)[doc]}, item {dict(items.dtypes)[item]}, run_share double, word_share double"
    source = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    count = items.count()
    blocks = max(1, -(-count // BLOCK))
    out = None
    for block in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64(item), F.lit(blocks)) == block)
        rows = own.select(item, F.coalesce(item_text, F.lit("")).alias("text")).collect()
        if not rows:
            continue
        shared = docs.sparkSession.sparkContext.broadcast(ItemIndex([r[0] for r in rows], [r[1] for r in rows]))

        def match(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pd.DataFrame]:
            index = shared.value
            ids = pa.array(index.ids)
            for b in batches:
                d, i, runs, words = match_batch(index, b.column("text"))
                keep = (runs >= share) | (words >= tolerant)
                yield pa.RecordBatch.from_arrays([b.column("doc").take(pa.array(d[keep])), ids.take(pa.array(i[keep])), pa.array(runs[keep]), pa.array(words[keep])], ["doc", "item", "run_share", "word_share"])

        part = source.mapInArrow(match, kinds)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], kinds)


def leaked_items(found: DataFrame, items: DataFrame, item: str, share: float = 0.5) -> DataFrame:
    """(item, documents, best_share) for every item, found or not: the documents that hold ``share`` of its runs."""
    per = found.where(F.col("run_share") >= share).groupBy("item").agg(F.count("*").alias("documents"), F.max("run_share").alias("best_share"))
    return items.select(F.col(item).alias("item")).join(per, "item", "left").select("item", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("best_share", F.lit(0.0)).alias("best_share"))
