"""Which sources hold data for a date."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage


class AmbiguousSource(ValueError):
    """More than one batch object holds the date."""


class MissingSource(FileNotFoundError):
    """Neither batch nor stream holds the date."""


@dataclass(frozen=True)
class SourceReport:
    date: str
    batch_exists: bool
    batch_source: str | None
    stream_exists: bool


def batch_objects(spark: SparkSession, root: str, day: str, kind: str = "archive") -> list[str]:
    """Day partitions, and single-file objects with the date in their name."""
    when = Date.fromisoformat(day)
    partitioned = storage.glob(spark, f"{root}/{kind}/*/year={when:%Y}/month={when:%m}/acq_date={day}")
    single = storage.glob(spark, f"{root}/{kind}/{when:%Y}/{when:%m}/*{day}*.parquet")
    return partitioned + single


def has_rows_for(table: DataFrame, day: str, column: str = "acquisition_date") -> bool:
    """Partition-pruned existence test; stops at the first row."""
    return not table.where(F.col(column) == F.lit(day).cast("date")).limit(1).isEmpty()


def discover(
    spark: SparkSession, root: str, day: str, stream_table: DataFrame | None, kind: str = "archive"
) -> SourceReport:
    found = batch_objects(spark, root, day, kind)
    if len(found) > 1:
        raise AmbiguousSource(f"several batch objects hold {day}: {found}")
    streaming = stream_table is not None and has_rows_for(stream_table, day)
    if not found and not streaming:
        raise MissingSource(f"no batch object and no stream rows for {day}")
    return SourceReport(day, bool(found), found[0] if found else None, streaming)


def day_sources(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """The same for every day at once: which days each source holds."""
    days = batch.select(
        F.col("acq_date").cast("date").alias("day"), F.lit(True).alias("batch"), F.lit(False).alias("stream")
    ).unionByName(
        stream.select(
            F.col("acquisition_date").alias("day"), F.lit(False).alias("batch"), F.lit(True).alias("stream")
        )
    )
    return days.where("day is not null").groupBy("day").agg(
        F.bool_or("batch").alias("batch_exists"), F.bool_or("stream").alias("stream_exists")
    )
