"""Sources mixed to target weights, with sizes in tokens of a public tokenizer.

Documents are counted by source and exact token length; each may be taken as often as the cap on repeats allows. The
budget of a source is fitted by subset sums over these counts: an even share of every length, then a bounded-knapsack
table over what is left. The numbers chosen say how often the documents of a length are taken, and a seeded hash says
which are taken once more than the others. A source whose fit takes every copy and stays below its budget falls short.

Cases: sources written differently count together; documents without a source count in the size of the whole but are
never drawn; a source of the targets without documents falls short; documents of no tokens are never
drawn; repeated documents count each; equal hashes are told apart by the id; an empty corpus gives no mix and budgets
of zero, which nobody misses.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import collect_bounded, materialize

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: The lengths of all sources come to the driver: one row for each source and length that occurs, however many documents.
MOST_LENGTHS = 500_000
#: The targets are a setting of a few rows; the check keeps it one.
MOST_TARGETS = 10_000
#: The knapsack table spans so many times the greatest length at most; the even share covers the rest of a budget.
TABLE_LENGTHS = 8
#: A group of equal source and length is drawn from in so many parts, so that none lands in one task.
PARTS = 64
SEED = 20_240_101


def source_key(source: Column) -> Column:
    """One spelling of a source: without case, outer blanks, and with one sign between words."""
    key = F.regexp_replace(F.lower(F.trim(source)), r"[\s_\-]+", "_")
    return F.when(key != "", key)


def token_counts(docs: DataFrame, doc: str, source: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc, source, tokens): the length of every document; null text has no tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer)
        t.encode_special_tokens = True
        for b in batches:
            texts = [x or "" for x in b.column("text").to_pylist()]
            sizes = [len(e.ids) for at in range(0, len(texts), 512) for e in t.encode_batch_fast(texts[at : at + 512], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("source"), pa.array(sizes, pa.int64())], ["doc", "source", "tokens"])

    plain = docs.select(F.col(doc).alias("doc"), source_key(F.col(source)).alias("source"), F.col(text).alias("text"))
    return plain.mapInArrow(count, f"doc {dict(docs.dtypes)[doc]}, source string, tokens long")


def fit(lengths: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length make a sum of at most ``budget``, and as near to it as can be reached.

    An even share of each length fills the budget but for a few lengths; a table of reachable sums fits the rest.
    """
    lengths = {n: c for n, c in sorted(lengths.items()) if n > 0}
    total = sum(n * c for n, c in lengths.items())
    if total <= budget:
        return dict(lengths)
    if not lengths or budget <= 0:
        return {}
    size, count = np.array(list(lengths), np.int64), np.array(list(lengths.values()), np.int64)
    even = max(0.0, (budget - TABLE_LENGTHS * int(size[-1])) / total)
    # rounded along the running count, so that the rest stays near the room even if every length occurs once
    even_share = np.minimum(np.diff(np.floor(np.cumsum(count) * even), prepend=0).astype(np.int64), count)
    taken = dict(zip(lengths, even_share.tolist(), strict=True))
    rest = budget - int((size * even_share).sum())
    step = math.gcd(*lengths)
    rest //= step
    # the table is a row of bits, one for each sum up to the rest; a step adds so many documents of one length
    mask, row, steps = (1 << (rest + 1)) - 1, 1, []
    for n in sorted(lengths, reverse=True):
        spare, k = min(lengths[n] - taken[n], rest * step // n), 1
        while spare > 0 and not row >> rest & 1:
            k = min(k, spare)
            wider = (row | row << (n // step * k)) & mask
            if wider != row:
                steps.append((n, k, row))
                row = wider
            spare -= k
            k *= 2
    at = row.bit_length() - 1
    for n, k, before in reversed(steps):
        if not before >> at & 1:
            taken[n] += k
            at -= n // step * k
    return {n: c for n, c in taken.items() if c}


def plan(counted: DataFrame, targets: DataFrame) -> tuple[list[dict], list[tuple[str, int, int, int]]]:
    """(one report a source, draws): a draw says how often the documents of a source and length are taken, and how many of them once more."""
    total = counted.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    wanted = targets.select(source_key(F.col("source")).alias("key"), "source", "target_share", "max_repeats")
    wanted = collect_bounded(wanted, MOST_TARGETS)
    if wanted is None:
        raise ValueError(f"more than {MOST_TARGETS} sources in the targets")
    histogram = counted.join(F.broadcast(targets.select(source_key(F.col("source")).alias("source")).distinct()), "source").groupBy("source", "tokens").agg(F.count("*").alias("n"))
    table = histogram.limit(MOST_LENGTHS + 1).toArrow()
    if table.num_rows > MOST_LENGTHS:
        raise ValueError(f"more than {MOST_LENGTHS} lengths: round lengths up to a coarser step first")
    lengths: dict[str, dict[int, int]] = {}
    for source, n, c in zip(*(table.column(i).to_pylist() for i in range(3)), strict=True):
        lengths.setdefault(source, {})[n] = c
    reports, draws = [], []
    for w in wanted:
        own, budget = lengths.get(w["key"], {}), round(w["target_share"] * total)
        copies = {n: c * w["max_repeats"] for n, c in own.items() if n}
        drawn = fit(copies, budget)
        got = sum(n * c for n, c in drawn.items())
        draws += [(w["key"], n, *divmod(c, own[n])) for n, c in drawn.items()]
        whole_passes = min((drawn.get(n, 0) // c for n, c in own.items() if n), default=0)
        size = sum(n * c for n, c in own.items())
        reports.append({"source": w["source"], "key": w["key"], "target_share": w["target_share"], "documents": sum(own.values()), "size": size, "budget": budget, "capacity": size * w["max_repeats"], "passes": whole_passes, "reached": got, "falls_short": drawn == copies and got < budget})
    whole = sum(r["reached"] for r in reports)
    for r in reports:
        r["reached_share"] = r["reached"] / whole if whole else 0.0
    return reports, draws


def mix(counted: DataFrame, reports: list[dict], draws: list[tuple[str, int, int, int]]) -> DataFrame:
    """(doc, source, tokens, repeats) of the documents in the mix; the same seed gives the same mix."""
    spark = counted.sparkSession
    names = spark.createDataFrame([(r["key"], r["source"]) for r in reports], "source string, name string")
    wanted = spark.createDataFrame(draws, "source string, tokens long, times long, draw long")
    keyed = counted.join(F.broadcast(names), "source").withColumn("order", F.xxhash64(F.lit(SEED), "doc")).withColumn("part", F.pmod("order", F.lit(PARTS)))
    # how many to draw from each part of a group: the parts in turn, until the number is reached
    sizes = keyed.groupBy("source", "tokens", "part").agg(F.count("*").alias("n")).join(wanted, ["source", "tokens"])
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source", "tokens").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    share = sizes.withColumn("before", before).select("source", "tokens", "part", "times", F.greatest(F.lit(0), F.least("n", F.col("draw") - F.col("before"))).alias("take"))
    place = F.row_number().over(Window.partitionBy("source", "tokens", "part").orderBy("order", "doc"))
    drawn = keyed.join(share, ["source", "tokens", "part"]).withColumn("more", (place <= F.col("take")).cast("int"))
    return drawn.select("doc", F.col("name").alias("source"), "tokens", (F.col("times") + F.col("more")).cast("int").alias("repeats")).where("repeats > 0")


def counted_once(docs: DataFrame, doc: str, source: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    return materialize(token_counts(docs, doc, source, text, tokenizer), "tokens")
