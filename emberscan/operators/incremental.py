"""Incremental maintenance of date-partitioned tables.

Parquet has no row updates; every operation here rewrites whole day
partitions and only those. All are idempotent: a run repeated after a failure
gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..session import saved_copy
from ..sources import lake
from .directory import BUCKETS, KeyDirectory
from .guards import broadcast_if_small, fits_broadcast, require_single_date, require_unique
from .ledger import BatchLedger


def unseen_rows(incoming: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key the target lacks (null keys are always unseen).

    While the incoming keys are measurably few, the much larger target is cut
    down to them by a broadcast, and what is left is no larger than they are:
    neither side is shuffled. Otherwise it is a plain anti join.
    """
    wanted = incoming.select(key).distinct()
    if not fits_broadcast(wanted):
        return incoming.join(target.select(key), key, "left_anti")
    seen = target.select(key).join(F.broadcast(wanted), key, "left_semi").distinct()
    return incoming.join(F.broadcast(seen), key, "left_anti")


def merged(target: DataFrame, incoming: DataFrame, key: str, partition: str) -> DataFrame:
    """Target with incoming rows replacing or joining those of the same key.

    Rows without a key cannot be told apart: those of a day replace that day's.
    """
    replaced = broadcast_if_small(incoming.select(key))
    keyless = _dates(incoming.where(F.col(key).isNull()), partition)
    left = target.join(replaced, key, "left_anti").select(*incoming.columns)
    if keyless:
        left = left.where(F.col(key).isNotNull() | ~F.coalesce(_within(partition, keyless), F.lit(False)))
    return left.unionByName(incoming)


def _dates(df: DataFrame, column: str) -> set:
    """Distinct partition values: at most one per calendar day reach the driver."""
    return {row[0] for row in df.select(column).distinct().collect()}


def _within(column: str, dates: set):
    known = sorted(d for d in dates if d is not None)
    condition = F.col(column).isin(known) if known else F.lit(False)
    return condition | F.col(column).isNull() if None in dates else condition


def upsert(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    key: str = "detection_id",
    partition: str = "acquisition_date",
    cluster_by: list[str] | None = None,
    key_pins_partition: bool = False,
    saved: bool = False,
    buckets: int = BUCKETS,
) -> int:
    """Merge by key; rows absent from the input stay. Returns partitions rewritten.

    A key may sit in another day than its new row. The days that hold incoming keys come from the
    table's key directory, so of history only those days are read; `key_pins_partition`
    promises that a key never changes its day, and no directory is kept. The input is read several
    times: it is written out first unless it is `saved`, that is cheap to read again.
    """
    if not saved:
        with saved_copy(incoming, "upsert") as copy:
            return upsert(spark, path, copy, key, partition, cluster_by, key_pins_partition, True, buckets)
    arriving = _dates(incoming, partition)
    if not arriving:
        return 0
    require_unique(incoming, key)
    directory = None if key_pins_partition else KeyDirectory.of(spark, path, incoming, key, partition, buckets)
    if not storage.has_table(spark, path):
        if directory:
            directory.record(incoming)
        lake.write_partitioned(incoming, path, [partition], cluster_by)
        return len(arriving)
    touched = set(arriving)
    if directory:
        directory.ensure()
        with saved_copy(directory.found(incoming), "found") as known:
            touched |= _dates(known, partition)
            directory.record(incoming, known)
    target = spark.read.schema(incoming.schema).parquet(path).where(_within(partition, touched))
    result = merged(target, incoming, key, partition)
    emptied = touched - _dates(result, partition) if touched - arriving else set()
    lake.write_partitioned(result, path, [partition], cluster_by, only_touched=True)
    lake.drop_partitions(spark, path, partition, emptied - {None})
    return len(touched)


def overwrite_dates(
    df: DataFrame, path: str, partition: str = "acquisition_date", cluster_by: list[str] | None = None
) -> None:
    """Replace exactly the days present in the input."""
    lake.write_partitioned(df, path, [partition], cluster_by, only_touched=True)


def replace_date(spark: SparkSession, path: str, df: DataFrame, partition: str = "acq_date") -> int:
    """Load one day in place of what the table holds for it. Returns rows loaded.

    The input must hold exactly one date. Rows without a date ride along in the undated
    partition, where they take the place of equal rows, so a reload adds none. Empty input changes nothing.
    """
    clustered = ["regency_id"] if "regency_id" in df.columns else []
    with saved_copy(df, "load") as copy:
        loaded = copy.count()
        if loaded:
            require_single_date(copy, partition)
            undated = copy.where(F.col(partition).isNull())
            dated = copy.where(F.col(partition).isNotNull())
            lake.write_partitioned(dated, path, [partition], clustered, only_touched=True)
            if not undated.isEmpty():
                digest = F.sha2(F.to_json(F.struct(*copy.columns)), 256)
                before = spark.read.schema(copy.schema).parquet(path).where(F.col(partition).isNull())
                loads = broadcast_if_small(undated.select(digest.alias("_digest")))
                kept = before.withColumn("_digest", digest).join(loads, "_digest", "left_anti").drop("_digest")
                with saved_copy(kept.unionByName(undated), "undated") as whole:
                    lake.write_partitioned(whole, path, [partition], clustered, only_touched=True)
        return loaded


def append_unseen(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    key: str,
    partition: str = "acquisition_date",
    prepare: Callable[[DataFrame], DataFrame] = lambda fresh: fresh,
    batch: str | None = None,
    key_pins_partition: bool = True,
    saved: bool = False,
) -> int:
    """Append the rows whose key is new to the table, creating it if missing. Returns rows appended.

    Keys are looked for in the days of the incoming rows alone, as an event's id is made from its
    date; without that promise (`key_pins_partition=False`) also in the days that the table's key
    directory names. Either way history is not scanned. A `batch` by name is taken in once.
    `prepare` runs on the new rows only, on their way into the table. The input is read several times:
    it is written out first unless it is `saved`, that is cheap to read again.
    """
    ledger = BatchLedger(spark, path)
    if batch is not None and ledger.holds(batch):
        return 0
    if not saved:
        with saved_copy(incoming, "batch") as copy:
            return append_unseen(spark, path, copy, key, partition, prepare, batch, key_pins_partition, True)
    days, fresh, appended = _dates(incoming, partition), incoming, 0
    if days:
        within, known_table = set(days), storage.has_table(spark, path)
        if not key_pins_partition:
            directory = KeyDirectory.of(spark, path, incoming, key, partition)
            if known_table:
                directory.ensure()
            with saved_copy(directory.found(incoming), "found") as known:
                within |= _dates(known, partition)
                directory.record(incoming, known)
        if known_table:
            ids = T.StructType([incoming.schema[key], incoming.schema[partition]])
            fresh = unseen_rows(incoming, spark.read.schema(ids).parquet(path).where(_within(partition, within)), key)
        made, seen = prepare(fresh), Observation()
        clustered = ["regency_id"] if "regency_id" in made.columns else []
        # The files read were listed before; those this write adds are not among them.
        lake.write_partitioned(made, path, [partition], clustered, mode="append", seen=seen)
        appended = seen.get["rows"]
    if batch is not None:
        ledger.enter(batch, days, appended)
    return appended
