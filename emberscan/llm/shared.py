"""Helpers of several operators: saved copies, words, span columns."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root

WORD = r"[^\x20\x09-\x0D]+"
SLICE_ROWS = 256  # texts that a Python worker holds as objects at a time
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def keep(df: DataFrame) -> DataFrame:
    """Cut lineage by a checkpoint in the shared folder, so that lost executors cost no recomputation.

    Files go when the frame is garbage collected, if the session sets
    spark.cleaner.referenceTracking.cleanCheckpoints.
    """
    context = df.sparkSession.sparkContext
    root = checkpoint_root(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return df.checkpoint()


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches: a worker keeps the memory it once took, for every stage after."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """All runs of characters other than ASCII white space, in order; null for null."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def count_of(text: Column, pattern: str) -> Column:
    """How many characters of the text match a one-character pattern."""
    return F.regexp_count(text, F.lit(pattern))


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(df[column], F.lit(""))
