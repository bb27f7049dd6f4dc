"""Where keys are: a hash-bucketed directory (key, day) kept beside a date-partitioned table.

An upsert must find the days that hold the incoming keys. Searching the table's key column
reads all history; the directory reads the buckets of the incoming keys and nothing else.
It is a log: pairs are only ever added, before the table itself is written. A job that
dies in between leaves a pair too many, never one too few, so a lookup gives all days a key
may be in, and a day too many costs a rewrite, no more. `compact` folds a bucket's repeats,
`rebuild` reads the table once and leaves what is true.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..session import scratch_path

BUCKETS = 16  # more for tables of many billions of keys


class KeyDirectory:
    """The directory of the table at `path`. Null keys are in no directory."""

    def __init__(
        self, spark: SparkSession, path: str, key: T.StructField, partition: T.StructField, buckets: int = BUCKETS
    ) -> None:
        self.spark, self.table, self.buckets = spark, path, buckets
        self.key, self.partition = key.name, partition.name
        self.root = f"{path.rstrip('/')}.keys/{key.name}-{buckets}"
        self.schema = T.StructType([T.StructField(key.name, key.dataType), T.StructField(partition.name, partition.dataType)])

    @classmethod
    def of(cls, spark: SparkSession, path: str, rows: DataFrame, key: str, partition: str, buckets: int = BUCKETS) -> KeyDirectory:
        return cls(spark, path, rows.schema[key], rows.schema[partition], buckets)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _pairs(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col(self.key).isNotNull()).select(self.key, self.partition, self._bucket().alias("_bucket"))

    def _write(self, pairs: DataFrame, mode: str, path: str | None = None) -> None:
        writer = pairs.repartition("_bucket").sortWithinPartitions("_bucket", self.key).write.mode(mode)
        writer.partitionBy("_bucket").parquet(path or self.root)

    def exists(self) -> bool:
        return storage.exists(self.spark, f"{self.root}/_SUCCESS")

    def bucket(self, numbers: Iterable[int]) -> DataFrame:
        """The pairs of some buckets: only their folders are listed and read."""
        paths = [p for p in (f"{self.root}/_bucket={n}" for n in sorted(numbers)) if storage.exists(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def found(self, rows: DataFrame) -> DataFrame:
        """The pairs on record for the keys of some rows; a pair recorded twice comes twice."""
        asked = self._pairs(rows).select(self.key, "_bucket")
        # At most `buckets` numbers reach the driver.
        numbers = [row[0] for row in asked.select("_bucket").distinct().collect()]
        return self.bucket(numbers).join(asked.select(self.key), self.key, "left_semi")

    def record(self, rows: DataFrame, known: DataFrame | None = None) -> None:
        """Add the pairs of some rows that are not among `known`. Repeats do no harm."""
        pairs = self._pairs(rows)
        if known is not None:
            same = [pairs[self.key] == known[self.key], pairs[self.partition].eqNullSafe(known[self.partition])]
            pairs = pairs.join(known, same, "left_anti")
        self._write(pairs, "append")

    def rebuild(self) -> None:
        """From the table's two columns; switched in whole, so a job that dies leaves the old directory or none."""
        table = self.spark.read.schema(self.schema).parquet(self.table)
        fresh = scratch_path(self.spark, "directory")
        self._write(self._pairs(table).distinct(), "overwrite", fresh)
        storage.delete(self.spark, self.root)
        storage.move(self.spark, fresh, self.root)

    def ensure(self) -> None:
        if not self.exists():
            self.rebuild()

    def compact(self, numbers: Iterable[int] | None = None) -> None:
        """Fold the repeats and small files of some buckets, all by default."""
        numbers = range(self.buckets) if numbers is None else numbers
        fresh = scratch_path(self.spark, "directory")
        self._write(self._pairs(self.bucket(numbers)).distinct(), "overwrite", fresh)
        pairs = self.spark.read.schema(T.StructType([*self.schema, T.StructField("_bucket", T.IntegerType())])).parquet(fresh)
        writer = pairs.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("_bucket").parquet(self.root)
        storage.delete(self.spark, fresh)
