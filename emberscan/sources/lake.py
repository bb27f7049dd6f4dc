"""Date-partitioned parquet tables.

Writes spread every day over as many tasks as its size asks for (a rebalance
on the partition column, split by adaptive execution), so one hot day never
becomes one task; inside a file rows are sorted by the cluster column, which
gives parquet row groups tight statistics. Replacing a day is a dynamic
partition overwrite: files are staged, then swapped in at job commit, and days
absent from the input keep their files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..constants import LANDING_TABLES
from ..functions.coerce import lenient_date
from .files import write_snapshot

ROWS_PER_FILE = 5_000_000


def drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable[object]) -> None:
    for value in values:
        storage.delete(spark, f"{path}/{column}={value}")


def _laid_out(df: DataFrame, partition_by: list[str], cluster_by: list[str], seen: Observation | None) -> DataFrame:
    dealt = df.hint("rebalance", *partition_by)
    if seen:
        # Behind the shuffle, where a task that runs again does not count again.
        dealt = dealt.observe(seen, F.count(F.lit(1)).alias("rows"))
    return dealt.sortWithinPartitions(*partition_by, *cluster_by)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    cluster_by: list[str] | None = None,
    mode: str = "overwrite",
    only_touched: bool = False,
    seen: Observation | None = None,
) -> None:
    """Write a partitioned table; `only_touched` keeps the partitions not in the input. `seen` counts the `rows` written."""
    writer = (
        _laid_out(df, partition_by, cluster_by or [], seen)
        .write.mode(mode)
        .partitionBy(*partition_by)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
    )
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if only_touched else "static")
    writer.parquet(path)


def write_plain(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


# --- landing ---------------------------------------------------------------


def landing_day(df: DataFrame) -> Column:
    """The day a row lands under; null for an undated row."""
    return lenient_date(df, "acq_date")


def split_by_day(df: DataFrame, root: str, kind: str, table: str) -> int:
    """Land a source table as year/month/day partitions.

    Dates are coerced; rows without one belong to no day and are not written.
    Returns how many those were, counted while writing.
    """
    dated = df.withColumn("acq_date", landing_day(df))
    seen = Observation()
    kept = (
        dated.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("acq_date").isNull()).alias("undated"),
        )
        .where("acq_date is not null")
        .withColumn("year", F.date_format("acq_date", "yyyy"))
        .withColumn("month", F.date_format("acq_date", "MM"))
    )
    if df.isEmpty():
        return 0
    write_partitioned(kept, landing_path(root, kind, table), ["year", "month", "acq_date"], only_touched=True)
    return seen.get["undated"]


def landing_path(root: str, kind: str, table: str) -> str:
    return f"{root}/{kind}/{table}"


def land_tables(
    read: Callable[[str], DataFrame],
    root: str,
    tables: Mapping[str, list[str]] = LANDING_TABLES,
) -> dict[str, int]:
    """Land every configured table; returns the undated-row count of each."""
    undated = {}
    for kind, names in tables.items():
        for name in names:
            if kind == "reference":
                write_snapshot(read(name), root, name)
                undated[name] = 0
            else:
                undated[name] = split_by_day(read(name), root, kind, name)
    return undated


def read_days(
    spark: SparkSession, root: str, kind: str, table: str, start: str, end: str
) -> DataFrame:
    """Rows of a date range, files of other days pruned; missing days add nothing."""
    path = landing_path(root, kind, table)
    day = F.col("acq_date")
    return spark.read.parquet(path).where(
        day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
