"""Marts and the dashboard's queries."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CONFIDENCE_DISPLAY, DAYNIGHT_DISPLAY, ROLLING_MART_DAYS, TYPE_DISPLAY
from ..functions.labels import display
from .star import on_date

MART_KEYS = [
    "acquisition_date", "province_name", "regency_name", "confidence_level",
    "day_night", "detection_type_label", "ingestion_source",
]


def mart_scope(
    fact: DataFrame, date: str | None = None, as_of: str | Date | None = None, incremental: bool = False
) -> DataFrame:
    """Days a mart run rebuilds: all at first, then the given day or the last few."""
    if not incremental:
        return fact
    if date:
        return on_date(fact, date)
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return fact.where(F.col("acquisition_date") >= F.date_sub(today, ROLLING_MART_DAYS))


def daily_detection(fact: DataFrame, classification: DataFrame, location: DataFrame) -> DataFrame:
    """Detections per day, place and class.

    The fact collapses to its own keys before meeting the dimensions: the
    labels depend on those keys alone, and counts, sums and maxima combine. So
    the joins see one row per group instead of one per detection, and no
    dimension needs to be broadcast against the fact.
    """
    frp, heat = F.col("fire_radiative_power"), F.col("brightness")
    grouped = fact.groupBy("acquisition_date", "regency_id", "classification_id", "ingestion_source").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(frp).alias("sf"), F.max(frp).alias("mf"),
        F.sum(heat).alias("sb"), F.max(heat).alias("mb"),
    )
    classes = classification.select(
        "classification_id", "confidence_level_label", "daynight",
        F.col("detection_type_label").alias("type_label"),
    )
    places = location.select("regency_id", "regency_name", "province_name")
    starred = grouped.join(classes, "classification_id", "left").join(places, "regency_id", "left")
    return starred.groupBy(
        "acquisition_date", "province_name", "regency_name",
        display(F.col("confidence_level_label"), CONFIDENCE_DISPLAY).alias("confidence_level"),
        display(F.col("daynight"), DAYNIGHT_DISPLAY).alias("day_night"),
        display(F.col("type_label"), TYPE_DISPLAY).alias("detection_type_label"),
        "ingestion_source",
    ).agg(
        F.sum("n").alias("detection_count"),
        F.sum("sf").cast(fact.schema["fire_radiative_power"].dataType).alias("total_frp"),
        F.max("mf").alias("max_frp"),
        F.sum("sb").cast(fact.schema["brightness"].dataType).alias("total_brightness"),
        F.max("mb").alias("max_brightness"),
    )


def _ranking(mart: DataFrame, name: str) -> DataFrame:
    return mart.groupBy(name).agg(F.count(F.lit(1)).alias("total_detection")).orderBy(
        F.desc("total_detection"), F.asc(name)
    )


def top_province(mart: DataFrame) -> DataFrame:
    """Provinces by number of mart rows (not detections: see severity_ranking)."""
    return _ranking(mart, "province_name")


def top_regency(mart: DataFrame) -> DataFrame:
    return _ranking(mart, "regency_name")


def trend(mart: DataFrame) -> DataFrame:
    """Detections per day, month, year and calendar month (season), in one pass."""
    day = F.col("acquisition_date")
    daily = mart.groupBy("acquisition_date").agg(F.sum("detection_count").alias("n"), F.sum("total_frp").alias("frp"))
    grains = F.array(
        F.struct(F.lit("day").alias("grain"), F.date_format(day, "yyyy-MM-dd").alias("period")),
        F.struct(F.lit("month").alias("grain"), F.date_format(day, "yyyy-MM").alias("period")),
        F.struct(F.lit("year").alias("grain"), F.date_format(day, "yyyy").alias("period")),
        F.struct(F.lit("season").alias("grain"), F.date_format(day, "MM").alias("period")),
    )
    return daily.select(F.inline(grains), "n", "frp").groupBy("grain", "period").agg(
        F.sum("n").alias("detection_count"), F.sum("frp").alias("total_frp")
    )


def severity_ranking(mart: DataFrame, by: str = "province_name", top: int | None = None) -> DataFrame:
    """True ranking: detections, total and peak radiative power."""
    ranked = mart.groupBy(by).agg(
        F.sum("detection_count").alias("detection_count"),
        F.sum("total_frp").alias("total_frp"),
        F.max("max_frp").alias("max_frp"),
    ).orderBy(F.desc("detection_count"), F.desc("total_frp"), F.asc(by))
    return ranked.limit(top) if top else ranked


def _grid(degrees: Column, cell: float) -> Column:
    return F.floor(degrees.cast("double") / F.lit(cell)).cast("bigint")


def density_grid(detections: DataFrame, cell: float = 0.5) -> DataFrame:
    """Detections per grid cell, for a heat map."""
    return detections.groupBy(
        _grid(F.col("latitude"), cell).alias("cell_row"), _grid(F.col("longitude"), cell).alias("cell_col")
    ).agg(F.count(F.lit(1)).alias("detection_count"))


def type_breakdown(mart: DataFrame) -> DataFrame:
    return mart.groupBy("detection_type_label").agg(
        F.sum("detection_count").alias("detection_count"), F.sum("total_frp").alias("total_frp")
    )
