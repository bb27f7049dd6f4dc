"""What was landed, day by day: one small entry per table and day, written with the landing.

Discovery then needs neither to list partitions nor to count rows: the entries of a day
have its name. An entry says how many rows the day has and which files hold them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from . import lake
from .discovery import AmbiguousSource, MissingSource, SourceReport, has_rows_for

SCHEMA = "kind string, table string, day date, rows long, files array<string>"
AMBIGUOUS, MISSING = "AMBIGUOUS_SOURCE", "MISSING_SOURCE"


class LandingCatalogue:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, kind: str, table: str, day: str) -> str:
        return f"{self.root}/_catalogue/{kind}/{table}/{day}.json"

    def land(self, df: DataFrame, kind: str, table: str) -> int:
        """Land a table by day and enter its days. Returns how many rows were undated."""
        undated = lake.split_by_day(df, self.root, kind, table)
        self.enter(kind, table, df)
        return undated

    def enter(self, kind: str, table: str, df: DataFrame) -> None:
        """Enter the days of `df` as they lie in the lake now; a day's row per table reaches the driver."""
        days = [r[0] for r in df.select(lake.landing_day(df).alias("d")).where("d is not null").distinct().collect()]
        if not days:
            return
        landed = self.spark.read.parquet(lake.landing_path(self.root, kind, table)).where(F.col("acq_date").isin(days))
        found = landed.groupBy("acq_date", F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
        found = found.groupBy("acq_date").agg(F.sum("n").alias("rows"), F.array_sort(F.collect_list("file")).alias("files"))
        for row in found.collect():
            day = str(row["acq_date"])
            entry = {"kind": kind, "table": table, "day": day, "rows": row["rows"], "files": row["files"]}
            storage.write_text(self.spark, self._path(kind, table, day), json.dumps(entry))

    def forget(self, kind: str, table: str, day: str) -> None:
        """Take a day's entry away, before its files go."""
        storage.delete(self.spark, self._path(kind, table, day))

    def entries(self) -> DataFrame:
        """kind, table, day, rows, files of everything landed."""
        if not storage.exists(self.spark, f"{self.root}/_catalogue"):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).json(f"{self.root}/_catalogue")

    def discover(self, day: str, stream: DataFrame | None, kind: str = "archive") -> SourceReport:
        """Which sources hold a day: the entry of its name, and one row of the stream table."""
        held = storage.glob(self.spark, self._path(kind, "*", day))
        tables = [json.loads(storage.read_text(self.spark, path)) for path in held]
        tables = [entry for entry in tables if entry["rows"]]
        if len(tables) > 1:
            raise AmbiguousSource(f"several batch tables hold {day}: {sorted(entry['table'] for entry in tables)}")
        streaming = stream is not None and has_rows_for(stream, day)
        if not tables and not streaming:
            raise MissingSource(f"no batch table and no stream rows for {day}")
        source = f"{lake.landing_path(self.root, kind, tables[0]['table'])}" if tables else None
        return SourceReport(day, bool(tables), source, streaming)

    def discovered(self, days: DataFrame, stream: DataFrame, kind: str = "archive") -> DataFrame:
        """The same for many days at once: day, batch_tables, batch_rows, stream_exists, error (the two errors as rows)."""
        batch = self.entries().where((F.col("kind") == kind) & (F.col("rows") > 0)).groupBy("day").agg(
            F.count(F.lit(1)).alias("batch_tables"), F.sum("rows").alias("batch_rows")
        )
        streaming = stream.select(F.col("acquisition_date").alias("day")).distinct().withColumn("stream_exists", F.lit(True))
        joined = days.select("day").distinct().join(batch, "day", "left").join(streaming, "day", "left")
        known = joined.na.fill(0, ["batch_tables", "batch_rows"]).na.fill(False, ["stream_exists"])
        error = F.when(F.col("batch_tables") > 1, AMBIGUOUS).when((F.col("batch_tables") == 0) & ~F.col("stream_exists"), MISSING)
        return known.withColumn("error", error)


def land_all(catalogue: LandingCatalogue, tables: Iterable[tuple[str, str, DataFrame]]) -> dict[str, int]:
    """Land and enter several tables (kind, name, rows); the undated rows of each."""
    return {name: catalogue.land(rows, kind, name) for kind, name, rows in tables}
