"""Fixed table and message schemas."""

from pyspark.sql import types as T

_D, _S, _L, _I = T.DoubleType(), T.StringType(), T.LongType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


LANDING = _struct(
    ("latitude", _D), ("longitude", _D), ("brightness", _D), ("scan", _D), ("track", _D),
    ("acq_date", T.DateType()), ("acq_time", _I), ("satellite", _S), ("instrument", _S),
    ("confidence", _S), ("version", _S), ("bright_t31", _D), ("frp", _D),
    ("daynight", _S), ("type", _I),
)

# The near-real-time feed names its two brightness bands differently and has no type.
API_CSV = T.StructType(
    [
        T.StructField({"brightness": "bright_ti4", "bright_t31": "bright_ti5"}.get(f.name, f.name), f.dataType)
        for f in LANDING
        if f.name != "type"
    ]
)

EVENT = _struct(
    ("event_id", _S), ("source", _S), ("source_table", _S), ("schema_version", _S),
    ("published_timestamp", _S), ("latitude", _D), ("longitude", _D), ("brightness", _D),
    ("scan", _D), ("track", _D), ("acq_date", _S), ("acq_time", _I), ("satellite", _S),
    ("instrument", _S), ("confidence", _S), ("version", _S), ("bright_t31", _D),
    ("frp", _D), ("daynight", _S),
)

STREAM_RAW = _struct(
    ("event_id", _S), ("source", _S), ("source_table", _S), ("schema_version", _S),
    ("published_timestamp", T.TimestampType()), ("ingested_timestamp", T.TimestampType()),
    ("latitude", _D), ("longitude", _D), ("brightness", _D), ("scan", _D), ("track", _D),
    ("acquisition_date", T.DateType()), ("acquisition_time", _S), ("satellite", _S),
    ("instrument", _S), ("confidence", _S), ("version", _S),
    ("brightness_temperature_t31", _D), ("fire_radiative_power", _D), ("daynight", _S),
    ("detection_datetime", T.TimestampNTZType()), ("detection_timestamp", T.TimestampType()),
    ("detection_year", _L), ("detection_month", _L), ("detection_day_of_week", _L),
    ("detection_hour", _L), ("confidence_level_label", _S), ("detection_period", _S),
    ("satellite_label", _S), ("collection_version", _S), ("processing_type", _S),
)

STREAM_ENRICHED = T.StructType(STREAM_RAW.fields + [T.StructField("regency_id", _L, True)])

REGENCY = _struct(("regency_id", _L), ("province_id", _L), ("regency_name", _S))
PROVINCE = _struct(("province_id", _L), ("province_name", _S))

STAGING_COLUMNS = [
    "detection_id", "latitude", "longitude", "brightness", "scan", "track",
    "acquisition_date", "acquisition_time", "satellite", "instrument", "confidence",
    "version", "brightness_temperature_t31", "fire_radiative_power", "daynight",
    "detection_type", "regency_id", "ingestion_source",
]

# GeoJSON: coordinates stay text until the geometry type says how deep they nest.
GEOJSON = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("properties", _struct(("WADMKK", _S), ("WADMPR", _S))),
                        T.StructField("geometry", _struct(("type", _S), ("coordinates", _S))),
                    ]
                )
            ),
        ),
        T.StructField(
            "crs",
            T.StructType([T.StructField("properties", _struct(("name", _S)))]),
        ),
    ]
)

RING = "array<struct<x:double,y:double>>"
