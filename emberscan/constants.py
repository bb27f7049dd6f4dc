"""Values that results depend on: sentinels, code labels, schema tags."""

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
NUMBER_SENTINEL = -999
TEXT_SENTINEL = "UNKNOWN"
UNMATCHED_REGION = -999
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"

CONFIDENCE_LABELS = {"h": "HIGH", "n": "NOMINAL", "l": "LOW"}
PERIOD_LABELS = {"D": "DAY", "N": "NIGHT"}
TYPE_LABELS = {
    0: "VEGETATION_FIRE",
    1: "ACTIVE_VOLCANO",
    2: "STATIC_LAND_SOURCE",
    3: "OFFSHORE",
}
SATELLITE_LABELS = {"SNPP": "SUOMI NPP", "N20": "NOAA-20", "N21": "NOAA-21"}
PROCESSING_LABELS = {
    "NRT": "NEAR_REAL_TIME",
    "URT": "ULTRA_REAL_TIME",
    "RT": "REAL_TIME",
}
STANDARD_PROCESSING = "STANDARD"

CONFIDENCE_DISPLAY = {"HIGH": "High", "NOMINAL": "Nominal", "LOW": "Low"}
DAYNIGHT_DISPLAY = {"D": "Day", "N": "Night"}
TYPE_DISPLAY = {
    "VEGETATION_FIRE": "Vegetation Fire",
    "ACTIVE_VOLCANO": "Active Volcano",
    "STATIC_LAND_SOURCE": "Static Land Source",
    "OFFSHORE": "Offshore",
}
DISPLAY_UNKNOWN = "Unknown"

MONTH_NAMES = [
    "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE",
    "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER",
]
DAY_NAMES = [
    "SUNDAY", "MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY",
]

REGENCY_ALIASES = {"KEPSIAUTAGULANDANGBIARO": "SIAUTAGULANDANGBIARO"}
LOCATION_COUNTRY = "Indonesia"

EVENT_SOURCE = "NASA_FIRMS"
EVENT_SOURCE_TABLE = "fire_detection_nrt"
EVENT_SCHEMA_VERSION = "1.0"

QUARANTINE_ISSUE = "REGION_NOT_MATCHED"
REJECT_REASON = "INVALID_COORDINATE"
ROLLING_MART_DAYS = 3

LANDING_TABLES = {
    "archive": ["fire_detections_archive"],
    "nrt": ["fire_detections_nrt"],
    "reference": ["regency", "province"],
}
# ----------------------------------------------------------------------------

# The warehouse's exact decimal: order-independent sums, nine decimals.
NUMERIC = T.DecimalType(38, 9)
