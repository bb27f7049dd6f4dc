"""Intermediate models: time enrichment, labels, quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import QUARANTINE_ISSUE, UNMATCHED_REGION
from ..functions import labels, times

BUSINESS_COLUMNS = [
    "confidence_level_label", "detection_period", "detection_type_label",
    "satellite_label", "collection_version", "processing_type",
]


def matched(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("regency_id") != UNMATCHED_REGION)


def quarantine(staged: DataFrame, at: Column | None = None) -> DataFrame:
    """Detections in no known regency, with the issue and the time of the run."""
    return staged.where(F.col("regency_id") == UNMATCHED_REGION).withColumns(
        {
            "quarantine_issue": F.lit(QUARANTINE_ISSUE),
            "quarantined_at": F.current_timestamp() if at is None else at,
        }
    )


def _temporal_columns() -> dict[str, Column]:
    day, time = F.col("acquisition_date"), F.col("acquisition_time")
    return {
        "detection_datetime": times.detection_datetime(day, time),
        "detection_timestamp": times.detection_timestamp(day, time),
        "detection_year": F.year(day),
        "detection_month": F.month(day),
        "detection_day_of_week": F.dayofweek(day),
        "detection_hour": times.hour_of(time),
        "detection_month_name": times.month_name(F.month(day)),
        "detection_day_name": times.day_name(F.dayofweek(day)),
    }


def _business_columns() -> dict[str, Column]:
    return {
        "confidence_level_label": labels.confidence_label(F.col("confidence")),
        "detection_period": labels.period_label(F.col("daynight")),
        "detection_type_label": labels.type_label(F.col("detection_type")),
        "satellite_label": labels.satellite_label(F.col("satellite")),
        "collection_version": labels.leading_version(F.col("version")),
        "processing_type": labels.processing_label(F.col("version")),
    }


def enrich_time(staged: DataFrame) -> DataFrame:
    return matched(staged).withColumns(_temporal_columns())


def label_business(staged: DataFrame) -> DataFrame:
    return matched(staged).withColumns(_business_columns())


def join_detections(enriched: DataFrame, business: DataFrame) -> DataFrame:
    """Literal join of labels to enriched rows; repeated ids multiply."""
    return enriched.join(business.select("detection_id", *BUSINESS_COLUMNS), "detection_id", "left")


def describe(staged: DataFrame) -> DataFrame:
    """Time and labels in one projection.

    Equals the join above wherever ids are unique and not null, without
    shuffling every detection twice to meet itself.
    """
    return matched(staged).withColumns({**_temporal_columns(), **_business_columns()})
