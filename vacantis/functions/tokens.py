"""Words and shingles of whole Arrow batches as flat numpy arrays; no Python object per word."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ROLL = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every input bit over the output."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * _MIX_A
        h = (h ^ (h >> np.uint64(27))) * _MIX_B
        return h ^ (h >> np.uint64(31))


def word_lists(texts: pa.Array, mask_digits: bool = False) -> tuple[np.ndarray, pa.Array]:
    """(offsets, words): words are maximal runs of letters and digits, lower-cased; null counts as empty."""
    flat = pc.fill_null(texts, "")
    flat = pc.replace_substring_regex(pc.utf8_lower(flat), pattern=r"[^\p{L}\p{N}]+", replacement=" ")
    if mask_digits:
        flat = pc.replace_substring_regex(flat, pattern=r"\b[0-9]+\b", replacement="0")
    lists = pc.split_pattern(pc.utf8_trim(flat, " "), " ")
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    words = lists.flatten()
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
    if empty.any():
        keep = np.concatenate([[0], np.cumsum(~empty)])
        offsets, words = keep[offsets], words.filter(pa.array(~empty))
    return offsets, words


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word; every distinct word is hashed once."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)[coded.indices.to_numpy(zero_copy_only=False)]


def run_hashes(offsets: np.ndarray, hashes: np.ndarray, mask: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(position of the first word, hash) of every window of a text, of which the words at the offsets in ``mask`` count."""
    span = mask[-1] + 1
    n = len(hashes)
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n - span + 1, np.uint64)
        for m in mask:
            total = mix(total * _ROLL + hashes[m : n - span + 1 + m])
    ends = np.repeat(offsets[1:], np.diff(offsets))[: n - span + 1]
    start = np.flatnonzero(np.arange(n - span + 1) + span <= ends)
    return start, total[start]


def shingle_sets(offsets: np.ndarray, hashes: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes) of the distinct k-word shingles of each text, ascending. With ``short``, a text of one to k-1 words is one shingle."""
    docs = len(offsets) - 1
    start, h = run_hashes(offsets, hashes, tuple(range(k)))
    doc = np.searchsorted(offsets, start, side="right") - 1
    if short:
        length = np.diff(offsets)
        few = np.flatnonzero((length > 0) & (length < k))
        if len(few):
            with np.errstate(over="ignore"):
                own = np.array([np.bitwise_xor.reduce(mix(hashes[offsets[d] : offsets[d + 1]] + np.arange(length[d], dtype=np.uint64) * _ROLL)) for d in few], np.uint64)
            doc, h = np.concatenate([doc, few]), np.concatenate([h, own])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    doc, h = doc[first], h[first]
    return np.searchsorted(doc, np.arange(docs + 1)), h


def simhashes(offsets: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each text from its shingle hashes; 0 for a text without any."""
    docs = len(offsets) - 1
    out = np.zeros(docs, np.uint64)
    size = np.diff(offsets)
    some = np.flatnonzero(size > 0)
    if not len(some):
        return out
    for bit in range(64):
        ones = np.add.reduceat(((parts >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), offsets[some])
        out[some] |= (2 * ones > size[some]).astype(np.uint64) << np.uint64(bit)
    return out
