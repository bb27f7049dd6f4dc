"""Deterministic keys: detection ids, surrogate keys and administrative-name keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import REGENCY_ALIASES, SURROGATE_NULL


def coordinate_text(col: Column) -> Column:
    """Text of a coordinate in the form both ingestion paths hash.

    The JVM switches to scientific notation below 1e-3; the publishers only do
    so below 1e-4 and write the exponent with two digits. Points that close to
    the equator are real, so the small range is rewritten.
    """
    text = col.cast("string")
    size = F.abs(col)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E-", -1)
    digits = F.regexp_replace(mantissa, r"[-.]", "")
    sign = F.when(col < 0, "-").otherwise("")
    return (
        F.when((size >= 1e-3) | (size == 0) | col.isNull(), text)
        .when(size >= 1e-4, F.concat(sign, F.lit("0.000"), digits))
        .otherwise(F.concat(mantissa, F.lit("e-"), F.lpad(exponent, 2, "0")))
    )


def detection_id(
    latitude: str = "latitude",
    longitude: str = "longitude",
    acq_date: str = "acq_date",
    acq_time: str = "acq_time",
    satellite: str = "satellite",
    instrument: str = "instrument",
) -> Column:
    """md5 over the grain. A null in the first four parts makes the id null."""
    parts = [
        coordinate_text(F.col(latitude).cast("double")),
        coordinate_text(F.col(longitude).cast("double")),
        F.col(acq_date).cast("date").cast("string"),
        F.col(acq_time).cast("string"),
        F.coalesce(F.col(satellite), F.lit("")),
        F.coalesce(F.col(instrument), F.lit("")),
    ]
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("|"), part] if pieces else [part]
    return F.md5(F.concat(*pieces))


def surrogate_key(*columns: str) -> Column:
    """md5 over dash-joined values, nulls replaced by a marker."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in columns]
    return F.md5(F.concat_ws("-", *values))


SATELLITE_KEY = ("satellite", "instrument")
CLASSIFICATION_KEY = (
    "confidence_level_label", "daynight", "detection_period", "detection_type", "detection_type_label",
)
PROCESS_KEY = ("version", "collection_version", "processing_type")


def _squeezed(name: Column) -> Column:
    return F.regexp_replace(F.upper(F.regexp_replace(name, r"^\s+|\s+$", "")), r"\s+", " ")


def admin_name_key(name: Column, aliases: Mapping[str, str] = REGENCY_ALIASES) -> Column:
    """Comparable key of a regency or city name; cities keep a KOTA_ prefix."""
    text = _squeezed(F.coalesce(name, F.lit("")))
    marked = (
        F.when(text.startswith("KABUPATEN "), F.substr(text, F.lit(len("KABUPATEN ") + 1)))
        .when(text.startswith("KOTA "), F.concat(F.lit("KOTA_"), F.substr(text, F.lit(len("KOTA ") + 1))))
        .otherwise(text)
    )
    bare = F.regexp_replace(marked, "[^A-Z0-9_]", "")
    renamed = bare
    for written, canonical in aliases.items():
        renamed = F.when(bare == written, F.lit(canonical)).otherwise(renamed)
    return renamed


def loose_name_key(name: Column) -> Column:
    """Name without its administrative prefix; a city and a regency may collide."""
    text = F.upper(F.regexp_replace(name, r"^\s+|\s+$", ""))
    for prefix in ("KABUPATEN ", "KOTA "):
        text = F.when(text.startswith(prefix), F.substr(text, F.lit(len(prefix) + 1))).otherwise(text)
    return _squeezed(text)
