"""Detection rows to events and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import labels, times
from ..functions.keys import detection_id
from ..functions.times import is_clock_time
from ..schemas import EVENT, STREAM_RAW

# The API names its brightness bands by channel; archive files already use ours.
API_NAMES = {"brightness": "bright_ti4", "bright_t31": "bright_ti5"}

_CORRUPT = "_corrupt_record"
_MESSAGE = T.StructType([*EVENT.fields, T.StructField(_CORRUPT, T.StringType(), True)])


def to_events(rows: DataFrame, names: dict[str, str] | None = None, published_at: Column | None = None) -> DataFrame:
    """Feed or archive rows as 19-field events. `names` maps our columns to theirs."""
    names = names or {}
    at = F.current_timestamp() if published_at is None else published_at
    made = {
        "event_id": detection_id(),
        "source": F.lit(C.EVENT_SOURCE),
        "source_table": F.lit(C.EVENT_SOURCE_TABLE),
        "schema_version": F.lit(C.EVENT_SCHEMA_VERSION),
        "published_timestamp": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "acq_date": F.date_format(F.col("acq_date").cast("date"), "yyyy-MM-dd"),
    }
    return rows.select(
        *[
            made.get(f.name, F.col(names.get(f.name, f.name))).cast(f.dataType).alias(f.name)
            for f in EVENT
        ]
    )


# Texts whose absence does not make an event unusable: staging gives them their sentinel.
OPTIONAL = ("satellite", "instrument", "confidence", "version", "daynight")


def encode(events: DataFrame) -> DataFrame:
    """Events as messages: key and JSON value, the shape file and broker sinks take.

    Null fields are written as nulls, so a message always names every field.
    """
    value = F.to_json(F.struct(*EVENT.names), {"ignoreNullFields": "false"})
    return events.select(F.col("event_id").alias("key"), value.alias("value"))


def decode(messages: DataFrame) -> DataFrame:
    """Messages as (value, event, problem); a problem is null for a usable event.

    Text that describes the instrument or the reading may be null, as in the batch
    path; all else is required. JSON decoding reports broken text but not absent
    fields or impossible dates, so those are tested here.
    """
    text = F.col("value").cast("string")
    event = F.from_json(text, _MESSAGE, {"columnNameOfCorruptRecord": _CORRUPT})
    # A generator, through which nothing is pushed: else every use of a field would parse the message again.
    parsed = messages.select(text.alias("value"), F.inline(F.array(F.struct(event.alias("event")))))
    event = F.col("event")
    missing = F.lit(False)
    for field in (name for name in EVENT.names if name not in OPTIONAL):
        missing = missing | event.getField(field).isNull()
    unusable = (
        event.getField("acq_date").try_cast("date").isNull()
        | ~is_clock_time(event.getField("acq_time"))
        | event.getField("published_timestamp").try_cast("timestamp").isNull()
    )
    return parsed.withColumn(
        "problem",
        F.when(event.isNull() | event.getField(_CORRUPT).isNotNull(), "MALFORMED_JSON")
        .when(missing, "MISSING_FIELD")
        .when(unusable, "INVALID_VALUE"),
    )


def usable_events(decoded: DataFrame) -> DataFrame:
    return decoded.where("problem is null").select(
        *[F.col(f"event.{name}").alias(name) for name in EVENT.names]
    )


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where("problem is not null").select("value", "problem")


def to_stream_rows(events: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Events as 31-column stream rows: typed, time-enriched and labelled."""
    day = F.col("acq_date").cast("date")
    time = times.clock_time(F.col("acq_time"))
    version = F.col("version")
    made = {
        "published_timestamp": F.col("published_timestamp").cast("timestamp"),
        "ingested_timestamp": F.current_timestamp() if ingested_at is None else ingested_at,
        "acquisition_date": day,
        "acquisition_time": time,
        "brightness_temperature_t31": F.col("bright_t31"),
        "fire_radiative_power": F.col("frp"),
        "detection_datetime": times.detection_datetime(day, time),
        "detection_timestamp": times.detection_timestamp(day, time),
        "detection_year": F.year(day),
        "detection_month": F.month(day),
        "detection_day_of_week": F.dayofweek(day),
        "detection_hour": times.hour_of(time),
        "confidence_level_label": labels.confidence_label(F.col("confidence")),
        "detection_period": labels.period_label(F.col("daynight")),
        "satellite_label": labels.satellite_label(F.col("satellite")),
        "collection_version": labels.stream_version(version),
        "processing_type": labels.stream_processing_label(version),
    }
    return events.select(
        *[made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in STREAM_RAW]
    )
