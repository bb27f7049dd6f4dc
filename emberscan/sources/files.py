"""CSV and parquet scans and simple sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import LANDING


def read_csv(spark: SparkSession, path: str, schema: T.StructType = LANDING) -> DataFrame:
    """Header CSV under a declared schema: one pass, no inference scan."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def write_snapshot(df: DataFrame, root: str, table: str) -> str:
    """Reference table as one overwritten parquet location; empty input writes nothing."""
    path = f"{root}/reference/{table}.parquet"
    if not df.isEmpty():
        df.write.mode("overwrite").parquet(path)
    return path


def truncate_and_load(spark: SparkSession, source_path: str, target_path: str) -> DataFrame:
    """Replace a raw table by the content of a parquet location."""
    spark.read.parquet(source_path).write.mode("overwrite").parquet(target_path)
    return spark.read.parquet(target_path)


def write_locations(df: DataFrame, path: str, append: bool = False) -> None:
    """Resolved coordinates as header CSV files."""
    df.write.mode("append" if append else "overwrite").option("header", True).csv(path)
