"""Mixing sources to target weights by Poisson replication.

A source of volume v that should make up weight w of a mix of volume t is to be
repeated w * t / v times on average. A document's number of copies is the
Poisson quantile, with that mean, of a uniform number from a hash of seed and
id, so it is the same in every run and engine. Copies are dealt to partitions
and sorted by another hash: a global shuffle whose cost is one exchange,
whatever the skew of the sources.

Volume is characters plus one per document, so no source has volume 0. The
quantile table is one array per source; a source holding a third of all rows
meets it in a broadcast join, if the table is measured small.

Defined results: a null source is a source of its own; a null text has no
characters; a null id hashes as the empty text; rows that repeat an id get the
same number of copies each; sources without a given weight get weight 0 where
weights are given, and are then left out by the caller's own choice; an empty
table gives no rows. Columns of the input keep their names; `copy` and `mix_key`
of the input are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.guards import broadcast_if_small
from .shared import text_of

SEED = "mix-1"
FLATTEN = 0.5  # weights as volume to this power, where none are given: 1 keeps shares, 0 evens them out
_SPAN = 1 << 52


def hashed_unit(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts' texts, joined by colons."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(_SPAN))


def rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, repetition: float = 1.0) -> DataFrame:
    """source, volume, rate (mean copies of a document): the mix has `repetition` times the input's volume."""
    volumes = docs.groupBy("source").agg(F.sum(F.char_length(text_of(docs)) + F.lit(1).cast("bigint")).alias("volume"))
    if weights is None:
        volumes = volumes.withColumn("_weight", F.pow(F.col("volume").cast("double"), F.lit(FLATTEN)))
    else:
        given = docs.sparkSession.createDataFrame(
            [(source, float(weight)) for source, weight in weights.items()], "_source string, _weight double"
        )
        volumes = volumes.join(F.broadcast(given), volumes["source"].eqNullSafe(given["_source"]), "left").drop("_source")
        volumes = volumes.withColumn("_weight", F.coalesce("_weight", F.lit(0.0)))
    totals = volumes.agg(F.sum("volume").alias("_all"), F.sum("_weight").alias("_weights"))
    rate = F.col("_weight") / F.nullif(F.col("_weights"), F.lit(0.0)) * F.col("_all") * repetition / F.col("volume")
    return volumes.join(F.broadcast(totals)).select("source", "volume", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def steps(rate: Column) -> Column:
    """The Poisson distribution function at 0, 1, ... so far that the rest is below 2^-52; empty for rate 0."""
    far = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    empty = F.struct(F.lit(0.0).alias("log"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("all"))

    def add(acc: Column, k: Column) -> Column:
        log = F.when(k == 0, -rate).otherwise(acc["log"] + F.log(rate) - F.log(k.cast("double")))
        total = acc["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(acc["all"], F.array(total)).alias("all"))

    made = F.aggregate(F.sequence(F.lit(0), far), empty, add, lambda acc: acc["all"])
    return F.when(rate > 0, made).otherwise(F.array(F.lit(1.0)))


def copies(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    repetition: float = 1.0,
    seed: str = SEED,
) -> DataFrame:
    """The documents, each as often as its quantile says, with `copy` (from 1) and `mix_key`; not yet shuffled."""
    table = rates(docs, weights, repetition).select(F.col("source").alias("_source"), steps(F.col("rate")).alias("_steps"))
    table = broadcast_if_small(table)
    drawn = hashed_unit(F.lit(seed), F.col("doc_id"))
    own = [name for name in docs.columns if name not in ("copy", "mix_key")]
    rows = docs.select("doc_id", "source", drawn.alias("_drawn"), F.struct(*own).alias("_row"))
    count = F.size(F.filter("_steps", lambda step: step <= F.col("_drawn")))
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "copy")
    return (
        rows.join(table, rows["source"].eqNullSafe(table["_source"]), "left")
        .withColumn("_count", count)
        .where("_count > 0")
        .select("doc_id", "_row", F.explode(F.sequence(F.lit(1), F.col("_count"))).alias("copy"))
        .select("_row.*", "copy", F.md5(key).alias("mix_key"))
    )


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, repetition: float = 1.0, seed: str = SEED) -> DataFrame:
    """The shuffled mix: dealt to partitions by `mix_key` and sorted by it within each."""
    return copies(docs, weights, repetition, seed).repartition("mix_key").sortWithinPartitions("mix_key")
