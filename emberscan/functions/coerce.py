"""Strict and lenient conversions.

Staging casts strictly (bad input fails the job); landing coerces (bad input
becomes null). The two never mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import NUMBER_SENTINEL, TEXT_SENTINEL

_DECIMAL_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number_or_sentinel(col: Column, data_type: T.DataType) -> Column:
    return F.coalesce(col.cast(data_type), F.lit(NUMBER_SENTINEL).cast(data_type))


def text_or_sentinel(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(TEXT_SENTINEL))


def lenient_double(df: DataFrame, name: str) -> Column:
    """Number or null. Text like '2d' or 'NaN' is not a number here."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.when(col.rlike(_DECIMAL_TEXT), F.trim(col).try_cast("double"))
    number = col.cast("double")
    return F.when(~F.isnan(number), number)


def lenient_long(df: DataFrame, name: str) -> Column:
    """Whole number or null; fractions count as bad input."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("bigint")
    number = lenient_double(df, name)
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def lenient_date(df: DataFrame, name: str) -> Column:
    """Date or null, from text, dates or timestamps."""
    return F.col(name).try_cast("date")
