"""Dimensions and fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import CLASSIFICATION_KEY, PROCESS_KEY, SATELLITE_KEY, surrogate_key


def on_date(df: DataFrame, date: str | None, column: str = "acquisition_date") -> DataFrame:
    """Restrict to one day; no date (or an empty one) means all."""
    return df.where(F.col(column) == F.lit(date).cast("date")) if date else df


def dim_location(regencies: DataFrame, provinces: DataFrame) -> DataFrame:
    return regencies.join(provinces, "province_id", "left").select(
        "regency_id", "regency_name", "province_id", "province_name"
    )


def _dimension(detections: DataFrame, key_name: str, key: tuple[str, ...], columns: list[str]) -> DataFrame:
    """Distinct combinations first, so keys are hashed once per combination."""
    return detections.select(*columns).distinct().select(surrogate_key(*key).alias(key_name), *columns)


def dim_satellite(detections: DataFrame) -> DataFrame:
    return _dimension(detections, "satellite_id", SATELLITE_KEY, ["satellite", "satellite_label", "instrument"])


def dim_detection_classification(detections: DataFrame) -> DataFrame:
    return _dimension(detections, "classification_id", CLASSIFICATION_KEY, list(CLASSIFICATION_KEY))


def dim_collecting_process(detections: DataFrame) -> DataFrame:
    return _dimension(detections, "processing_id", PROCESS_KEY, list(PROCESS_KEY))


def fct_detection(detections: DataFrame, date: str | None = None) -> DataFrame:
    return on_date(detections, date).select(
        "detection_id",
        "ingestion_source",
        "regency_id",
        surrogate_key(*SATELLITE_KEY).alias("satellite_id"),
        surrogate_key(*CLASSIFICATION_KEY).alias("classification_id"),
        surrogate_key(*PROCESS_KEY).alias("processing_id"),
        "brightness", "scan", "track", "confidence",
        "brightness_temperature_t31", "fire_radiative_power",
        "acquisition_date", "acquisition_time",
        "detection_datetime", "detection_timestamp",
    )
