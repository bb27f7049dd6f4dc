"""Existence, listing and deletion through the Hadoop file system, so any store works."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target must not exist."""
    fs, start = _at(spark, source)
    _, end = _at(spark, target)
    fs.mkdirs(end.getParent())
    if not fs.rename(start, end):
        raise OSError(f"cannot move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, visible once it is whole; an existing one is replaced."""
    fs, target = _at(spark, path)
    draft = target.suffix(f".{uuid.uuid4().hex}.tmp")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(draft, target):
        raise OSError(f"cannot write {path}")


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that must not be there yet, visible once it is whole."""
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    write_text(spark, draft, text)
    if exists(spark, path):
        delete(spark, draft)
        raise FileExistsError(path)
    move(spark, draft, path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's content."""
    fs, target = _at(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a pattern, in name order."""
    fs, target = _at(spark, pattern)
    found = fs.globStatus(target)
    return sorted(status.getPath().toString() for status in found) if found else []


def has_table(spark: SparkSession, path: str) -> bool:
    """Whether any committed parquet file lies at the path or in its partitions."""
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return False
    entries = fs.listFiles(target, True)
    while entries.hasNext():
        if entries.next().getPath().getName().endswith(".parquet"):
            return True
    return False
