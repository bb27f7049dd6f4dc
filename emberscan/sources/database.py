"""Relational sources and sinks over JDBC. The driver jar comes with the deployment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

INSERT_BATCH = 5000


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str | None = None,
    bounds: tuple[object, object] | None = None,
    splits: int = 64,
    **options: str,
) -> DataFrame:
    """Whole table; with a split column it is read by parallel range queries."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if split_on and bounds:
        reader = (
            reader.option("partitionColumn", split_on)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", splits)
        )
    return reader.load()


def write_table(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace a database table, inserting in batches."""
    (
        df.write.format("jdbc").mode("overwrite")
        .option("url", url).option("dbtable", table).option("batchsize", INSERT_BATCH)
        .options(**options).save()
    )
