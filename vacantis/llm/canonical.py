"""Free-entered values mapped to a canonical list, with the unmatched ones reported.

Distinct values only; each is normalised to words and the words look up candidates in an inverted index of the
character n-grams of the list's words. A candidate's score is the cosine of its words, weighted by how telling they
are on the list, with the n-gram similarity of the best word of the value in place of exact equality. The best entry
is accepted above a threshold and a margin over the second.

Cases: null and blank values are left out; stand-ins and values without a match have entry_id ''; a value equal to a
canonical form is left out; the same value typed in many rows is matched once and reported for each; ties between two
entries are no match; an empty list gives '' for every value.
"""

from __future__ import annotations

import os
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.standins import STAND_INS, says_nothing
from ..session import collect_bounded

#: The list is held by every worker; a longer one must be cut into parts by the caller.
MOST_ENTRIES = 200_000
#: Cosine of n-grams from which a word of the list is looked at, and cosine or edit similarity from which it counts.
RETRIEVE = 0.25
WORD_FLOOR = 0.7
ACCEPT = 0.52
MARGIN = 0.08

# fixed values: everyday short forms in the names of trades and places
SHORT_FORMS = {"plng": "planning", "engg": "engineering", "eng": "engineering", "mgmt": "management", "mgt": "management", "qty": "quantity", "viz": "visualisation", "vis": "visualisation", "int": "interior", "ext": "exterior", "specs": "specification", "spec": "specification", "arch": "architecture", "tech": "technical", "struct": "structural", "consult": "consulting", "coord": "coordination", "dev": "development", "svcs": "services", "mktg": "marketing"}


def plain(text: str) -> str:
    text = unicodedata.normalize("NFKD", text.lower())
    return "".join(c for c in text if not unicodedata.combining(c))


def words_of(text: str) -> list[str]:
    text = regex.sub(r"\b(?:\p{L}\.){2,}", lambda m: m.group().replace(".", ""), plain(text))
    return [SHORT_FORMS.get(w, w) for w in regex.findall(r"[\p{L}\p{N}]+", text)]


def grams(word: str) -> set[str]:
    """Pairs of letters, next to each other and one apart, with the ends marked: two swapped letters change few."""
    w = f"^{word}$"
    return {w[i : i + 2] for i in range(len(w) - 1)} | {w[i] + "_" + w[i + 2] for i in range(len(w) - 2)}


def edit_similarity(a: str, b: str) -> float:
    """1 less the edits per letter; two neighbours swapped are one edit."""
    n, m = len(a), len(b)
    before, last = [], list(range(m + 1))
    for i in range(1, n + 1):
        row = [i] + [0] * m
        for j in range(1, m + 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                row[j] = min(row[j], before[j - 2] + 1)
        before, last = last, row
    return 1 - last[m] / max(n, m, 1)


def abbreviates(short: str, word: str) -> bool:
    """The first letter and then only consonants of ``word``, in order; after its first three letters, or more, any letters.

    A mere beginning is no short form of this kind: it counts where only one name goes on from it."""
    same = len(os.path.commonprefix([short, word]))
    if len(short) < 3 or same < 1 or len(short) >= len(word) or (not 3 <= same < len(short) and set(short[1:]) & set("aeiou")):
        return False
    rest = iter(word)
    return all(c in rest for c in short)


@dataclass
class Index:
    """Inverted index of the list: gram to words, and words to the names they stand in."""

    names: list[tuple[str, tuple[str, ...]]]
    weight: dict[str, float] = field(default_factory=dict)
    postings: dict[str, list[tuple[str, float]]] = field(default_factory=lambda: defaultdict(list))
    stop: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        seen = defaultdict(set)
        for entry, ws in self.names:
            for w in ws:
                seen[w].add(entry)
        entries = len({e for e, _ in self.names}) or 1
        self.weight = {w: float(np.log(1 + entries / len(s))) for w, s in seen.items()}
        count = defaultdict(int)
        for w in self.weight:
            for g in grams(w):
                count[g] += 1
        self.idf = {g: float(np.log(1 + len(self.weight) / n)) for g, n in count.items()}
        self.unseen = float(np.log(1 + len(self.weight)))
        for w in self.weight:
            gs = grams(w)
            norm = float(np.sqrt(sum(self.idf[g] ** 2 for g in gs)))
            for g in gs:
                self.postings[g].append((w, self.idf[g] / norm))
        self.heads: dict[str, dict[str, set[str]]] = {}
        self.joined = {"".join(ws) for _, ws in self.names if len(ws) > 1}
        for w in self.weight.keys() - self.joined:
            for n in range(4, len(w)):
                for e in seen[w]:
                    self.heads.setdefault(w[:n], {}).setdefault(e, set()).add(w)
        self.holders: dict[str, list[int]] = defaultdict(list)
        for at, (_, ws) in enumerate(self.names):
            for w in set(ws):
                self.holders[w].append(at)
        self.cache: dict[str, dict[str, float]] = {}

    def similar(self, word: str) -> dict[str, float]:
        """Words of the list like ``word``, with their cosine; a word cut short counts as its only completion."""
        if word in self.cache:
            return self.cache[word]
        out: dict[str, float] = {}
        if word not in self.stop:
            gs = grams(word)
            norm = float(np.sqrt(sum(self.idf.get(g, self.unseen) ** 2 for g in gs)))
            dot: dict[str, float] = defaultdict(float)
            for g in gs:
                for w, x in self.postings.get(g, ()):
                    dot[w] += x * self.idf[g] / norm
            if len(word) > 3:
                for w, d in dot.items():
                    if d >= RETRIEVE and len(w) > 3 and (near := max(d, edit_similarity(word, w))) >= WORD_FLOOR:
                        out[w] = near
            for w in dot:
                if word not in self.weight and w not in self.joined and abbreviates(word, w):
                    out[w] = max(0.8, out.get(w, 0))
            if len(of := self.heads.get(word, {})) == 1:
                out |= {w: max(0.9, out.get(w, 0)) for ws in of.values() for w in ws}
            if word in self.weight:
                out[word] = 1.0
        if len(self.cache) < 1_000_000:
            self.cache[word] = out
        return out

    def _found(self, words: list[str]) -> dict[str, float]:
        found: dict[str, float] = {}
        for w in words + [a + b for a, b in zip(words, words[1:], strict=False)] + ["".join(words)] * (len(words) > 2):
            for name, s in self.similar(w).items():
                found[name] = max(found.get(name, 0.0), s)
        return found

    def _cosine(self, name: tuple[str, ...], found: dict[str, float]) -> float:
        total = sum(self.weight[w] ** 2 for w in name)
        return float(np.sqrt(sum((self.weight[w] * found.get(w, 0.0)) ** 2 for w in name) / total)) if total else 0.0

    def match(self, value: str) -> tuple[str, float]:
        """(entry, score); entry is '' where none is near enough or two are equally near.

        A name found whole in the value takes the similarity of its words; of a name found in part, the words beside
        it in the same part of the value count against it.
        """
        best: dict[str, float] = {}
        parts = [words_of(p) for p in regex.split(r"[,|/()\[\];:]+| [-–—>] ", value)]
        everywhere = [w for p in parts for w in p]
        found_all = self._found(everywhere)
        if not found_all:
            return "", 0.0
        # the candidates are the names that hold a word found through the grams; no other name is looked at
        for at in sorted({at for w in found_all for at in self.holders[w]}):
            entry, name = self.names[at]
            score = self._cosine(name, found_all)
            if score < 0.75 or any(w not in found_all for w in name):
                score = 0.0
                for p in parts:
                    found = self._found(p)
                    cosine = self._cosine(name, found)
                    if cosine:
                        spare = sum(1 for w in p if not any(x in name for x in self.similar(w)) and w not in self.stop and len(w) > 2)
                        score = max(score, cosine / float(np.sqrt(1 + spare)) if len(name) > 1 else cosine)
            best[entry] = max(best.get(entry, 0.0), score + (0.02 if score > 0.9 and len(name) > 1 else 0))
        if not best:
            return "", 0.0
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))
        top, second = ranked[0], ranked[1] if len(ranked) > 1 else ("", 0.0)
        return (top[0], top[1]) if top[1] >= ACCEPT and top[1] - second[1] >= MARGIN else ("", top[1])


def build_index(rows: list[tuple[str, list[str]]], stop: set[str]) -> Index:
    """``rows``: entry id and its names. ``stop``: words of values that say nothing about the entry, such as states."""
    names = [(e, ws) for e, ns in rows for n in ns if (ws := tuple(words_of(n)))]
    names += [(e, ("".join(ws),)) for e, ws in names if len(ws) > 1]
    return Index(names, stop=frozenset(stop))


def map_values(df: DataFrame, row: str, column: str, entries: DataFrame, entry: str, names: list[str], canonical: str, context: list[str] = ()) -> DataFrame:
    """(row, value, entry_id, score) of every value of ``column`` that is not blank and not canonical.

    ``entries``: the list, with its key ``entry``, the columns ``names`` (each may hold several, separated by '|'),
    the SQL expression ``canonical`` for the exact form, and ``context`` columns whose words describe an entry without
    naming it.
    """
    listed = collect_bounded(entries.select(entry, *names, F.expr(canonical).alias("__form"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(context)]), MOST_ENTRIES)
    if listed is None:
        raise ValueError(f"more than {MOST_ENTRIES} entries: match the list in parts and keep the best of each value")
    rows = [(r[entry], [p.strip() for n in names for p in (r[n] or "").split("|") if p.strip()]) for r in listed]
    own = {w for _, ns in rows for n in ns for w in words_of(n)}
    stop = {w for r in listed for i in range(len(context)) for w in words_of(r[f"__c{i}"] or "")} - own
    index = build_index(rows, stop)
    shared = df.sparkSession.sparkContext.broadcast(index)

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for b in batches:
            hits = [("", 0.0) if regex.sub(r"[^\p{L}\p{N}\p{M}]+", "", v).lower() in STAND_INS else known.match(v) for v in b["value"]]
            yield pd.DataFrame({"value": b["value"], "entry_id": [str(e) for e, _ in hits], "score": [s for _, s in hits]})

    forms = entries.select(F.expr(canonical).alias("value")).where("value is not null").distinct()
    values = df.select(F.col(row).alias("row"), F.col(column).alias("value")).where(F.col("value").rlike(r"\S"))
    values = values.join(F.broadcast(forms), "value", "left_anti")
    # a number of parts of our own: distinct values are few bytes but much work, and would else be put
    # into one task; by a hash of the value, as by the value itself the shuffle of distinct would be taken for this one
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    judged = values.select("value").distinct().repartition(parts, F.xxhash64("value")).mapInPandas(match, "value string, entry_id string, score double")
    return values.join(judged, "value").select("row", "value", "entry_id", "score")
