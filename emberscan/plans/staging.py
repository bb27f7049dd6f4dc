"""Staging: one typed, null-free relation out of batch and stream detections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import NUMERIC
from ..functions.coerce import number_or_sentinel, text_or_sentinel
from ..functions.keys import detection_id
from ..functions.times import clock_time
from ..operators.dedup import keep_latest
from ..schemas import STAGING_COLUMNS

_CODE = T.LongType()


def _measures(names: dict[str, str], numeric: T.DataType) -> list:
    return [number_or_sentinel(F.col(source), numeric).alias(name) for name, source in names.items()]


def stage_batch(raw: DataFrame, numeric: T.DataType = NUMERIC) -> DataFrame:
    """Raw detections as 18 staging columns. A feed without `type` has none known."""
    kind = F.col("type") if "type" in raw.columns else F.lit(None)
    return raw.select(
        detection_id().alias("detection_id"),
        *_measures({n: n for n in ("latitude", "longitude", "brightness", "scan", "track")}, numeric),
        F.col("acq_date").cast("date").alias("acquisition_date"),
        clock_time(F.col("acq_time")).alias("acquisition_time"),
        *[text_or_sentinel(F.col(n)).alias(n) for n in ("satellite", "instrument", "confidence", "version")],
        *_measures({"brightness_temperature_t31": "bright_t31", "fire_radiative_power": "frp"}, numeric),
        text_or_sentinel(F.col("daynight")).alias("daynight"),
        number_or_sentinel(kind, _CODE).alias("detection_type"),
        number_or_sentinel(F.col("regency_id"), _CODE).alias("regency_id"),
        F.lit("batch").alias("ingestion_source"),
    )


def batch_ids(points: DataFrame) -> DataFrame:
    """The ids that staging gives raw detections with usable coordinates, wherever they lie."""
    return points.select(detection_id().alias("detection_id"))


def stage_stream(enriched: DataFrame, numeric: T.DataType = NUMERIC) -> DataFrame:
    """Enriched stream rows as staging columns, latest copy of every event.

    Copies of one event share date and time, so ingest and publish time decide.
    The type stays null: the stream does not carry one.
    """
    latest = keep_latest(
        enriched,
        "event_id",
        [
            F.col(c).desc()
            for c in ("acquisition_date", "acquisition_time", "ingested_timestamp", "published_timestamp")
        ],
    )
    return latest.select(
        F.col("event_id").alias("detection_id"),
        *_measures({n: n for n in ("latitude", "longitude", "brightness", "scan", "track")}, numeric),
        "acquisition_date",
        "acquisition_time",
        *[text_or_sentinel(F.col(n)).alias(n) for n in ("satellite", "instrument", "confidence", "version")],
        *_measures({n: n for n in ("brightness_temperature_t31", "fire_radiative_power")}, numeric),
        text_or_sentinel(F.col("daynight")).alias("daynight"),
        F.lit(None).cast(_CODE).alias("detection_type"),
        number_or_sentinel(F.col("regency_id"), _CODE).alias("regency_id"),
        F.lit("stream").alias("ingestion_source"),
    )


def stage_union(
    batch: DataFrame, stream: DataFrame, prefer_batch: bool = False, batch_ids: DataFrame | None = None
) -> DataFrame:
    """Both staging relations, duplicates across them kept.

    `prefer_batch` drops stream rows whose id the batch also has. `batch_ids` are the batch's detection ids
    where they are cheaper to get than by staging it a second time; repeats do no harm.
    """
    if prefer_batch:
        ids = batch.select("detection_id") if batch_ids is None else batch_ids
        stream = stream.join(ids, "detection_id", "left_anti")
    return batch.select(*STAGING_COLUMNS).unionByName(stream.select(*STAGING_COLUMNS))


def stage_regency(raw: DataFrame) -> DataFrame:
    return raw.select(
        number_or_sentinel(F.col("regency_id"), _CODE).alias("regency_id"),
        number_or_sentinel(F.col("province_id"), _CODE).alias("province_id"),
        text_or_sentinel(F.col("regency_name")).alias("regency_name"),
    )


def stage_province(raw: DataFrame) -> DataFrame:
    return raw.select(
        number_or_sentinel(F.col("province_id"), _CODE).alias("province_id"),
        text_or_sentinel(F.col("province_name")).alias("province_name"),
    )
