"""Checks that stop a job, and size checks that decide on a broadcast."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 * 1024 * 1024


class DuplicateKey(ValueError):
    """A key that must be unique is not."""


class DateGuardError(ValueError):
    """Input that must hold exactly one date does not."""


def require_unique(df: DataFrame, *keys: str) -> None:
    """Fail, naming up to five offenders, if a non-null key occurs twice."""
    present = df
    for key in keys:
        present = present.where(F.col(key).isNotNull())
    repeated = present.groupBy(*keys).count().where("count > 1").orderBy(*keys).limit(5).collect()
    if repeated:
        shown = [tuple(row[k] for k in keys) for row in repeated]
        raise DuplicateKey(f"duplicate {', '.join(keys)}: {shown}")


def require_single_date(df: DataFrame, column: str = "acq_date") -> object:
    """The one date of the input; nulls do not count. At most two rows reach the driver."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(2).collect()
    if len(found) != 1:
        raise DateGuardError(f"expected exactly one {column}, found {[str(r[0]) for r in found]}")
    return found[0][0]


def _value_bytes(kind: T.DataType, value: Column) -> Column:
    """Estimated in-memory bytes of one value."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.StructType):
        return reduce(add, (_value_bytes(f.dataType, value.getField(f.name)) for f in kind), F.lit(16))
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        flat = not isinstance(inner, T.StructType) or all(
            isinstance(f.dataType, (T.NumericType, T.DateType, T.BooleanType)) for f in inner
        )
        if flat and not isinstance(inner, (T.StringType, T.BinaryType, T.ArrayType)):
            per_item = 8 + 8 * len(inner) + 16 if isinstance(inner, T.StructType) else 8
            return F.lit(24) + F.coalesce(F.size(value), F.lit(0)) * per_item
        sizes = F.transform(value, lambda v: _value_bytes(inner, v).cast("bigint"))
        total = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda acc, v: acc + v)
        return F.lit(24) + F.coalesce(total, F.lit(0))
    return F.lit(16)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure the whole frame by partial sums: two numbers per task move."""
    row = reduce(add, (_value_bytes(f.dataType, F.col(f.name)) for f in df.schema), F.lit(16)).cast("bigint")
    size = (
        df.select(row.alias("bytes"))
        .agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
        .first()
    )
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for a frame measured to be small; else Spark shuffles."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df
