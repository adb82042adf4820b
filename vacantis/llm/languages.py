"""Languages of documents and of their stretches, by the nearest of several centroids per language.

Sentences become TF-IDF vectors of character trigrams; each language has a few centroids, clustered from sentences of
known language and from a bounded sample of labelled documents whose sentences agree with those. A sentence takes the
language of the nearest centroid by cosine; beyond a distance it takes none, and near a tie it keeps the language of
its document.

Cases: null and empty texts have no sentence; sentences of few words are judged but do not make a language count;
texts in a script or language without centroids come out as 'und'; labels compare by language only, and blanks and
words for unknown are missing labels; repeated documents are judged each; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.standins import says_nothing
from ..session import collect_bounded

DIMENSIONS = 1 << 15
CENTROIDS = 4
#: The classifier is fitted on the known sentences and on at most so many labelled documents of each label.
SAMPLE = 150
MOST_SAMPLES = 20_000
REJECT = 0.12
#: How much nearer another language must be than the document's own for a sentence to leave it.
LEAD = 0.03
FULL_SENTENCE = 8
BLOCK = 64
SPLIT = regex.compile(r"(?<=[.!?।…])[)”\"’»]*\s+|\n+")


def label_key(label: Column) -> Column:
    """The language of a label, without case, blanks and region; null where it is missing."""
    key = F.regexp_extract(F.lower(F.trim(label)), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    return F.when(~says_nothing(label) & (key != "") & ~key.isin("und", "unk", "xx", "zxx", "mis", "mul", "nan", "na", "tbd"), key)


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence."""
    out, start = [], 0
    for m in SPLIT.finditer(text):
        if text[start : m.start()].strip():
            out.append((start, m.start()))
        start = m.end()
    if text[start:].strip():
        out.append((start, len(text)))
    return out


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) of each different trigram of letters and each whole word; digits and signs count as blanks."""
    joined = "\x00".join(f" {t} " for t in texts).lower()
    joined = pc.replace_substring_regex(pa.array([joined], pa.large_string()), pattern=r"[^\p{L}\p{M}\x00]+", replacement=" ")[0].as_py()
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.cumsum(codes == 0)
    if len(codes) < 3:
        return (np.zeros(0, np.int64),) * 3
    with np.errstate(over="ignore"):
        h = ((codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1]) * np.uint64(0x85EBCA77) + codes[2:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    gram = (h >> np.uint64(40)) % np.uint64(DIMENSIONS)
    whole = (codes[:-2] != 0) & (codes[1:-1] != 0) & (codes[2:] != 0)
    lists = pc.utf8_split_whitespace(pa.array(joined.split("\x00"), pa.string()))
    word = lists.flatten()
    coded = word.dictionary_encode()
    hashed = (pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False) % np.uint64(DIMENSIONS)).astype(np.int64)
    of_word = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    some = (pc.utf8_length(word).to_numpy(zero_copy_only=False) > 0) if len(word) else np.zeros(0, bool)
    words = of_word[some] * DIMENSIONS + hashed[coded.indices.to_numpy(zero_copy_only=False)[some]]
    narrow = np.int32 if len(texts) < (1 << 31) // DIMENSIONS else np.int64  # half the bytes to sort
    key, count = np.unique(np.concatenate([owner[:-2][whole].astype(narrow) * narrow(DIMENSIONS) + gram[whole].astype(narrow), words.astype(narrow)]), return_counts=True)
    key = key.astype(np.int64)
    return key // DIMENSIONS, key % DIMENSIONS, count


def normed(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    owner, gram, count = trigrams(texts)
    weight = (1 + np.log(np.maximum(count, 1))) * idf[gram]
    norm = np.sqrt(np.bincount(owner, weight**2, minlength=len(texts)))
    return owner, gram, weight / np.maximum(norm[owner], 1e-9)


def cosines(texts: list[str], idf: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(texts, centroids). Texts are multiplied in small blocks over the features that occur in them, which stay dense enough for the matrix product."""
    out = np.zeros((len(texts), centroids.shape[1]), np.float32)
    owner, gram, weight = normed(texts, idf)
    for lo in range(0, len(texts), BLOCK):
        i, j = np.searchsorted(owner, (lo, lo + BLOCK))
        if i == j:
            continue
        own, at = np.unique(gram[i:j], return_inverse=True)
        dense = np.zeros((min(BLOCK, len(texts) - lo), len(own)), np.float32)
        dense[owner[i:j] - lo, at] = weight[i:j]
        out[lo : lo + len(dense)] = dense @ centroids[own]
    return out


class Model:
    """Centroids of each language."""

    def __init__(self, known: list[tuple[str, str]], labelled: list[tuple[str, str]]) -> None:
        self.languages = sorted({lang for lang, _ in known} | {lang for lang, _ in labelled})
        texts = [t for _, t in known]
        pool = [(lang, t[a:b]) for lang, t in labelled for a, b in sentences(t) if len(t[a:b].split()) >= FULL_SENTENCE]
        _, gram, _ = trigrams(texts + [t for _, t in pool])
        n = len(texts) + len(pool) + 1
        self.idf = np.log((n + 1) / (np.bincount(gram, minlength=DIMENSIONS) + 1)).astype(np.float32)
        clean = {lang: [t for k, t in known + pool if k == lang] for lang in self.languages}
        # wrong labels and foreign sentences go first: a sentence stays with its label only while it lies nearest to it
        for _ in range(3):
            self.centroids, self.owner = self._cluster({lang: ts + [t for k, t in known if k == lang] for lang, ts in clean.items()}, 1)
            best = [self.languages[i] for i in self.owner[cosines([t for _, t in pool], self.idf, self.centroids).argmax(axis=1)]] if pool else []
            clean = {lang: [t for (k, t), to in zip(pool, best, strict=True) if k == lang and to == lang] for lang in self.languages}
        self.centroids, self.owner = self._cluster({lang: ts + [t for k, t in known if k == lang] for lang, ts in clean.items()}, CENTROIDS)

    def _cluster(self, texts: dict[str, list[str]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Spherical k-means in each language, from seeds far from each other."""
        out, owner = [], []
        for at, lang in enumerate(self.languages):
            own = texts[lang]
            if not own:
                continue
            who, gram, weight = normed(own, self.idf)

            def centres(to: np.ndarray, n: int) -> np.ndarray:
                total = np.zeros((DIMENSIONS, n), np.float32)
                np.add.at(total, (gram, to[who]), weight)  # noqa: B023
                return total / np.maximum(np.linalg.norm(total, axis=0), 1e-9)

            to = np.zeros(len(own), np.int64)
            centre = centres(to, 1)
            while centre.shape[1] < min(k, len(own)):
                far = int(cosines(own, self.idf, centre).max(axis=1).argmin())
                alone = np.zeros((DIMENSIONS, 1), np.float32)
                alone[gram[who == far], 0] = weight[who == far]
                centre = np.hstack([centre, alone])
            for _ in range(6 if k > 1 else 0):
                to = cosines(own, self.idf, centre).argmax(axis=1)
                centre = centres(to, centre.shape[1])
            for c in np.unique(to):
                out.append(centre[:, c])
                owner.append(at)
        return np.ascontiguousarray(np.stack(out, axis=1)), np.array(owner)

    def judge(self, texts: list[str]) -> np.ndarray:
        """(texts, languages): the cosine of the nearest centroid of each language."""
        c = cosines(texts, self.idf, self.centroids)
        out = np.zeros((len(texts), len(self.languages)), np.float32)
        for at in range(len(self.languages)):
            if (self.owner == at).any():
                out[:, at] = c[:, self.owner == at].max(axis=1)
        return out


def fit(docs: DataFrame, text: str, label: str, samples: DataFrame, sample_text: str, sample_label: str) -> Model:
    """The classifier: from all known sentences and a seeded sample of labelled documents, SAMPLE of a label at most."""
    listed = collect_bounded(samples.select(label_key(F.col(sample_label)), sample_text).where(F.col(sample_text).isNotNull()), MOST_SAMPLES)
    if listed is None:
        raise ValueError(f"more than {MOST_SAMPLES} known sentences: give a sample of them")
    known = [(r[0], r[1]) for r in listed if r[0]]
    own = sorted({k for k, _ in known})
    keyed = docs.select(label_key(F.col(label)).alias("lang"), F.col(text).alias("text")).where(F.col("lang").isin(own) & F.col("text").isNotNull())
    order = F.xxhash64("text")
    total = {r["lang"]: r["count"] for r in keyed.groupBy("lang").count().collect()}
    # a row is drawn with the chance that gives about SAMPLE documents of its label; the cut below makes the bound exact
    odds = F.lit(0.0)
    for lang, n in total.items():
        odds = F.when(F.col("lang") == lang, min(1.0, SAMPLE / n)).otherwise(odds)
    chance = F.pmod(order, F.lit(1 << 20)) / float(1 << 20)
    rows = keyed.where(chance < odds).orderBy(order, "lang").limit(2 * SAMPLE * max(1, len(total))).collect()
    taken: dict[str, list[str]] = {}
    for r in rows:
        taken.setdefault(r["lang"], []).append(r["text"])
    return Model(known, [(lang, t) for lang, ts in sorted(taken.items()) for t in sorted(ts)[:SAMPLE]])


def segments(docs: DataFrame, doc: str, text: str, model: Model) -> DataFrame:
    """(doc, segment, begins, ends, lang, confidence, sentences, full_sentences): stretches of one language, in order; full sentences have eight words or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                texts = [t or "" for t in part.column("text").to_pylist()]
                spans = [sentences(t) for t in texts]
                flat = [t[a:z] for t, s in zip(texts, spans, strict=True) for a, z in s]
                score = m.judge(flat)
                words = pc.count_substring_regex(pa.array(flat, pa.string()), pattern=r"[\p{L}\p{M}\p{N}]+").to_numpy(zero_copy_only=False)
                out: dict[str, list] = {c: [] for c in ("at", "segment", "begins", "ends", "lang", "confidence", "sentences", "full")}
                first = 0
                for at, s in enumerate(spans):
                    own = score[first : first + len(s)]
                    size = words[first : first + len(s)]
                    first += len(s)
                    if not len(s):
                        continue
                    main = int((own * np.sqrt(size + 1)[:, None]).sum(axis=0).argmax())
                    best = own.argmax(axis=1)
                    best = np.where((own.max(axis=1) - own[:, main] < LEAD) | (size < 4), main, best)
                    name = ["und" if own[i].max() < REJECT and size[i] >= 4 else m.languages[best[i]] for i in range(len(s))]
                    ranked = np.sort(own, axis=1)
                    sure = np.where(best == own.argmax(axis=1), ranked[:, -1] / np.maximum(ranked[:, -1] + ranked[:, -2], 1e-9) if own.shape[1] > 1 else 1.0, 0.5)
                    number = -1
                    for i, (a, z) in enumerate(s):
                        if i == 0 or name[i] != name[i - 1]:
                            number += 1
                            for c, v in (("at", at + lo), ("segment", number), ("begins", a), ("ends", z), ("lang", name[i]), ("confidence", [float(sure[i])]), ("sentences", 0), ("full", 0)):
                                out[c].append(v)
                        else:
                            out["confidence"][-1].append(float(sure[i]))
                        out["ends"][-1] = z
                        out["sentences"][-1] += 1
                        out["full"][-1] += int(size[i] >= FULL_SENTENCE)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc").take(pa.array(out["at"], pa.int64())), pa.array(out["segment"], pa.int32()), pa.array(out["begins"], pa.int32()), pa.array(out["ends"], pa.int32()), pa.array(out["lang"], pa.string()), pa.array([sum(c) / len(c) for c in out["confidence"]], pa.float64()), pa.array(out["sentences"], pa.int32()), pa.array(out["full"], pa.int32())],
                    ["doc", "segment", "begins", "ends", "lang", "confidence", "sentences", "full_sentences"],
                )

    source = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    return source.mapInArrow(judge, f"doc {dict(docs.dtypes)[doc]}, segment int, begins int, ends int, lang string, confidence double, sentences int, full_sentences int")


def wrong_labels(docs: DataFrame, doc: str, label: str, found: DataFrame) -> DataFrame:
    """(doc, lang): for documents of missing or wrong label or of several languages, each language with a full sentence."""
    langs = found.where("full_sentences > 0 and lang <> 'und'").groupBy("doc").agg(F.collect_set("lang").alias("langs"))
    labels = docs.select(F.col(doc).alias("doc"), label_key(F.col(label)).alias("label"))
    judged = langs.join(labels, "doc")
    wrong = F.col("label").isNull() | (F.size("langs") > 1) | ~F.array_contains("langs", F.col("label"))
    return judged.where(wrong).select("doc", F.explode("langs").alias("lang"))
