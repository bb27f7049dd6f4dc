"""Declared data tests per model, as data.

`warn` names checks that valid input can break: day/night and type codes whose
sentinel is outside the accepted list, and versions without a leading number.
"""

from ..operators.quality import Rules

# --- Fixed values -----------------------------------------------------------
CONFIDENCES = ("HIGH", "NOMINAL", "LOW", "UNKNOWN")
PERIODS = ("DAY", "NIGHT", "UNKNOWN")
TYPES = ("VEGETATION_FIRE", "ACTIVE_VOLCANO", "STATIC_LAND_SOURCE", "OFFSHORE", "UNKNOWN")
SATELLITES = ("SUOMI NPP", "NOAA-20", "NOAA-21", "UNKNOWN")
PROCESSING = ("NEAR_REAL_TIME", "ULTRA_REAL_TIME", "REAL_TIME", "STANDARD", "UNKNOWN")
MONTHS = (
    "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY",
    "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER", "UNKNOWN",
)
DAYS = ("SUNDAY", "MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "UNKNOWN")

DECLARED: dict[str, Rules] = {
    "stg_detection_batch": Rules(
        not_null=("ingestion_source",), accepted={"ingestion_source": ("batch",)}
    ),
    "stg_detection_stream": Rules(
        not_null=("ingestion_source",), accepted={"ingestion_source": ("stream",)}
    ),
    "stg_detection": Rules(
        not_null=(
            "detection_id", "latitude", "longitude", "brightness", "scan", "track",
            "acquisition_date", "acquisition_time", "satellite", "instrument", "confidence",
            "version", "brightness_temperature_t31", "fire_radiative_power", "daynight",
            "regency_id", "ingestion_source",
        ),
        accepted={"ingestion_source": ("batch", "stream")},
    ),
    "stg_regency": Rules(not_null=("regency_id", "province_id"), unique=("regency_id",)),
    "stg_province": Rules(not_null=("province_id",), unique=("province_id",)),
    "dim_collecting_process": Rules(
        not_null=("processing_id", "version", "collection_version", "processing_type"),
        unique=("processing_id",),
        accepted={"processing_type": PROCESSING},
        warn=("not_null:collection_version",),
    ),
    "dim_detection_classification": Rules(
        not_null=(
            "classification_id", "confidence_level_label", "daynight", "detection_period", "detection_type_label",
        ),
        unique=("classification_id",),
        accepted={
            "confidence_level_label": CONFIDENCES,
            "daynight": ("D", "N"),
            "detection_period": PERIODS,
            "detection_type": (0, 1, 2, 3),
            "detection_type_label": TYPES,
        },
        warn=("accepted:daynight", "accepted:detection_type"),
    ),
    "dim_location": Rules(
        not_null=("regency_id", "regency_name", "province_id", "province_name"), unique=("regency_id",)
    ),
    "dim_satellite": Rules(
        not_null=("satellite_id", "satellite", "satellite_label", "instrument"),
        unique=("satellite_id",),
        accepted={"satellite_label": SATELLITES},
    ),
    "fct_detection": Rules(
        not_null=(
            "detection_id", "ingestion_source", "regency_id", "satellite_id", "classification_id",
            "processing_id", "acquisition_date", "acquisition_time", "detection_datetime", "detection_timestamp",
        ),
        unique=("detection_id",),
        relationships={
            "regency_id": ("dim_location", "regency_id"),
            "satellite_id": ("dim_satellite", "satellite_id"),
            "classification_id": ("dim_detection_classification", "classification_id"),
            "processing_id": ("dim_collecting_process", "processing_id"),
        },
    ),
    "int_detection_business": Rules(
        not_null=(
            "detection_id", "confidence_level_label", "detection_period",
            "detection_type_label", "satellite_label", "processing_type",
        ),
        unique=("detection_id",),
        accepted={
            "confidence_level_label": CONFIDENCES,
            "detection_period": PERIODS,
            "detection_type_label": TYPES,
            "satellite_label": SATELLITES,
            "processing_type": PROCESSING,
        },
    ),
    "int_detection_enrich": Rules(
        not_null=(
            "detection_id", "detection_datetime", "detection_timestamp", "detection_year", "detection_month",
            "detection_month_name", "detection_day_of_week", "detection_day_name", "detection_hour",
        ),
        unique=("detection_id",),
        accepted={
            "detection_month": tuple(range(1, 13)),
            "detection_month_name": MONTHS,
            "detection_day_of_week": tuple(range(1, 8)),
            "detection_day_name": DAYS,
            "detection_hour": tuple(range(24)),
        },
    ),
    "int_detection_join": Rules(
        not_null=(
            "detection_id", "confidence_level_label", "detection_period",
            "detection_type_label", "satellite_label", "processing_type",
        ),
        unique=("detection_id",),
    ),
    "int_detection_quarantine": Rules(
        not_null=("detection_id", "regency_id", "acquisition_date", "quarantine_issue", "quarantined_at"),
        unique=("detection_id",),
        accepted={"quarantine_issue": ("REGION_NOT_MATCHED",)},
    ),
    "daily_detection": Rules(
        not_null=(
            "acquisition_date", "province_name", "regency_name", "confidence_level", "day_night",
            "ingestion_source", "detection_count", "total_frp", "max_frp", "total_brightness", "max_brightness",
        )
    ),
}

# Gates between layers: the table a layer is judged by, and the rules it must pass.
GATES: dict[str, tuple[str, Rules]] = {
    "staging": ("stg_detection", Rules(not_null=("regency_id",))),
    "intermediate": (
        "int_detection_join",
        Rules(
            not_null=("regency_id",),
            invalid={"null_regency_id": "regency_id IS NULL", "invalid_regency_id": "regency_id = -999"},
        ),
    ),
    "mart": ("daily_detection", Rules()),
}
# ----------------------------------------------------------------------------
