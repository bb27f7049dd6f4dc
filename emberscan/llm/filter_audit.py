"""Filter interaction audit by survival words.

A document failing a set f of the five filters survives exactly the subsets of filters
disjoint from f. Bit s of its 32-bit survival word says whether it survives subset s, so the
number of survivors of every subset is a positional popcount over words. Tasks take it with
carry-save adders: three words of one weight become a sum word and a carry word of twice
the weight, until at most two words of each weight are left; only those are read bit by bit.
What leaves a task is 32 counts per part and label, whatever the number of rows. Every
order's figures then follow from the 32 counts of a part: the survivors of its prefixes.

Two shuffles by key precede: the first id of each text that occurs under several ids, and labels
by document. Texts travel as digests.

Defined results: a null text is empty; a null source is the part ''; a null id is neither larger
nor smaller than any, so it fails no E and makes none fail; rows that repeat an id count each;
a label counts if any of the document's label rows has it; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.guards import broadcast_if_small
from .shared import count_of, keep, text_of, words

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITAL_PERCENT = 5
SYMBOLS = r"[#$%&*|]"
HELD_PARTS = 50_000  # parts a task counts before it lets them go

KINDS = {"everyone": 0, "good": 1, "toxic": 2}  # bits of a label that each counts

# Survival word of each set of failed filters.
TRUTH = np.array([sum(1 << s for s in range(SUBSETS) if not s & f) for f in range(SUBSETS)], dtype=np.uint32)


def positional_popcount(values: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit, by carry-save adders."""
    counts = np.zeros(32, dtype=np.int64)
    weight, level = 0, np.asarray(values, dtype=np.uint32)
    while len(level):
        carries = []
        while len(level) > 2:
            third = len(level) // 3
            a, b, c = level[:third], level[third : 2 * third], level[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = np.concatenate([half ^ c, level[3 * third :]])
        for word in level:
            counts += ((int(word) >> np.arange(32)) & 1) << weight
        level = np.concatenate(carries) if carries else np.zeros(0, dtype=np.uint32)
        weight += 1
    return counts


def failed_filters(docs: DataFrame) -> DataFrame:
    """doc_id, part, failed (a bit per filter, A lowest) for every row."""
    text = text_of(docs)
    found = words(text)
    alone = {
        "A": F.size(found) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(found)) < MIN_DISTINCT_PERCENT * F.size(found),
        "C": 100 * count_of(text, "[A-Z]") > MAX_CAPITAL_PERCENT * F.char_length(text),
        "D": text.rlike(SYMBOLS),
    }
    bits = [F.when(fails, 1 << FILTERS.index(name)).otherwise(0) for name, fails in alone.items()]
    judged = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        sum(bits[1:], bits[0]).alias("alone"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    judged = keep(judged)
    firsts = judged.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    firsts = broadcast_if_small(keep(firsts.where("first < last").select("digest", "first")))
    copy = F.when(F.col("doc_id") > F.col("first"), 1 << FILTERS.index("E")).otherwise(0)
    return judged.join(firsts, "digest", "left").select("doc_id", "part", (F.col("alone") + copy).alias("failed"))


def labelled(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failed, label: 1 for quality, 2 for toxic, their sum for both."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        (F.max(F.when(F.col("quality") == 1, 1).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, 2).otherwise(0))).alias("label")
    )
    known = broadcast_if_small(keep(known.where("label > 0")))
    return failed.join(known, "doc_id", "left").select("part", "failed", F.coalesce("label", F.lit(0)).alias("label"))


def survivors(rows: DataFrame) -> DataFrame:
    """part, kind (everyone, good, toxic) and s0..s31, the documents surviving each subset; several rows a group, one per task."""
    names = [f"s{s}" for s in range(SUBSETS)]

    def block(held: dict) -> pa.RecordBatch:
        sums = np.array(list(held.values()))
        keys = [pa.array([k[i] for k in held], pa.string()) for i in (0, 1)]
        return pa.record_batch([*keys, *(pa.array(sums[:, s]) for s in range(SUBSETS))], names=["part", "kind", *names])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], np.ndarray] = {}
        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            named = parts.dictionary.to_pylist()
            group = np.asarray(parts.indices).astype(np.int64) * 4 + np.asarray(batch.column(2))
            order = np.argsort(group, kind="stable")
            found = TRUTH[np.asarray(batch.column(1))[order]]
            keys, starts = np.unique(group[order], return_index=True)
            for key, one in zip(keys.tolist(), np.split(found, starts[1:])):
                counts = positional_popcount(one)
                for kind, bit in KINDS.items():
                    at = (named[key // 4], kind)
                    held[at] = held.get(at, 0) + counts * (key & bit == bit)
            if len(held) >= HELD_PARTS:
                yield block(held)
                held = {}
        if held:
            yield block(held)

    schema = "part string, kind string, " + ", ".join(f"{n} long" for n in names)
    return rows.select("part", "failed", "label").mapInArrow(count, schema)


def _steps() -> list[dict]:
    """Every step of every order: its filter, and the subsets of filters before and after it."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, one in enumerate(order, 1):
            name, after = "".join(FILTERS[i] for i in order), before | 1 << one
            out.append({"filter_order": name, "step": step, "filter": one, "before": before, "after": after})
            before = after
    return out


def _shares(bit: int) -> list[int]:
    """How often the survivors of each subset count in a filter's removals, summed over all orders."""
    shares = [0] * SUBSETS
    for before in (s for s in range(SUBSETS) if not s & bit):
        size = before.bit_count()
        times = factorial(size) * factorial(len(FILTERS) - 1 - size)
        shares[before] += times
        shares[before | bit] -= times
    return shares


def _weighed(counts: Column, weights: list[int]) -> Column:
    """Sum of counts times weights."""
    terms = F.zip_with(counts, F.array(*(F.lit(w).cast("bigint") for w in weights)), lambda n, w: n * w)
    return F.aggregate(terms, F.lit(0).cast("bigint"), lambda total, term: total + term)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of the step, for each of the 120 orders."""
    counts = survivors(labelled(failed_filters(docs), labels)).groupBy("part", "kind")
    sums = counts.agg(F.array(*(F.sum(f"s{s}") for s in range(SUBSETS))).alias("counts"))
    kinds = [F.max(F.when(F.col("kind") == kind, F.col("counts"))).alias(kind) for kind in KINDS]
    # Checkpointed, or the sums would be planned into each of the 600 steps.
    parts = keep(sums.groupBy("part").agg(*kinds))
    everyone, every = F.col("everyone"), SUBSETS - 1
    letters = [1 << i for i in range(len(FILTERS))]
    alone = F.array(*(F.get(everyone, F.lit(every ^ bit)) - F.get(everyone, F.lit(every)) for bit in letters))
    over_orders = F.array(*(_weighed(everyone, _shares(bit)) for bit in letters))
    steps = F.from_json(F.lit(json.dumps(_steps())), "array<struct<filter_order:string,step:int,filter:int,before:int,after:int>>")
    at = parts.withColumns({"alone": alone, "over_orders": over_orders}).select("*", F.inline(steps))

    def lost(name: str) -> Column:
        return F.get(F.col(name), F.col("before")) - F.get(F.col(name), F.col("after"))

    failing = F.get(everyone, F.lit(0)) - F.get(everyone, F.col("before").bitwiseXOR(F.col("after")))
    return at.select(
        "part", "filter_order", "step",
        F.get(everyone, "after").alias("kept"),
        lost("everyone").alias("removed"),
        (failing - lost("everyone")).alias("redundant"),
        F.get("alone", "filter").alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("over_orders", "filter").alias("shapley"),
    )
