"""Acquisition date and time rules. Times of day are 'HH:mm:ss' text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DAY_NAMES, MONTH_NAMES, TEXT_SENTINEL


def _padded(acq_time: Column) -> Column:
    return F.lpad(acq_time.cast("string"), 4, "0")


def is_clock_time(acq_time: Column) -> Column:
    return _padded(acq_time).rlike(r"^([01][0-9]|2[0-3])[0-5][0-9]\z")


def clock_time(acq_time: Column) -> Column:
    """HHMM, padded or not, as 'HH:mm:00'. Null stays null; a bad time fails."""
    digits = _padded(acq_time)
    text = F.concat(F.substring(digits, 1, 2), F.lit(":"), F.substring(digits, 3, 2), F.lit(":00"))
    problem = F.raise_error(F.concat(F.lit("not an HHMM time: "), digits)).cast("string")
    return F.when(acq_time.isNull(), F.lit(None).cast("string")).when(is_clock_time(acq_time), text).otherwise(problem)


def _second_of_day(time: Column) -> Column:
    def part(start: int) -> Column:
        return F.substring(time, start, 2).cast("int")

    return part(1) * 3600 + part(4) * 60 + part(7)


def detection_datetime(day: Column, time: Column) -> Column:
    """Date and 'HH:mm:ss' as a zone-less timestamp, by arithmetic rather than parsing."""
    return F.timestamp_add("SECOND", _second_of_day(time), day.cast("timestamp_ntz"))


def detection_timestamp(day: Column, time: Column) -> Column:
    """The same moment read as UTC, whatever the session zone is."""
    return F.timestamp_seconds(F.unix_date(day).cast("bigint") * 86400 + _second_of_day(time))


def hour_of(time: Column) -> Column:
    return F.substring(time, 1, 2).cast("int")


def month_name(month: Column) -> Column:
    return F.coalesce(F.get(F.array(*map(F.lit, MONTH_NAMES)), month - 1), F.lit(TEXT_SENTINEL))


def day_name(day_of_week: Column) -> Column:
    """Name for the Sunday = 1 weekday."""
    return F.coalesce(F.get(F.array(*map(F.lit, DAY_NAMES)), day_of_week - 1), F.lit(TEXT_SENTINEL))
