"""Code-to-label rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def label_of(code: Column, labels: Mapping, default: str = C.TEXT_SENTINEL) -> Column:
    branches = None
    for key, value in labels.items():
        branches = (F if branches is None else branches).when(code == F.lit(key), F.lit(value))
    return branches.otherwise(F.lit(default))


def confidence_label(confidence: Column) -> Column:
    return label_of(F.lower(confidence), C.CONFIDENCE_LABELS)


def period_label(daynight: Column) -> Column:
    return label_of(F.upper(daynight), C.PERIOD_LABELS)


def type_label(detection_type: Column) -> Column:
    return label_of(detection_type, C.TYPE_LABELS)


def satellite_label(satellite: Column) -> Column:
    return label_of(F.upper(satellite), C.SATELLITE_LABELS)


def leading_version(version: Column) -> Column:
    """Warehouse rule: any leading number counts; null when there is none."""
    return F.regexp_substr(version, F.lit(r"^[0-9]+(\.[0-9]+)?"))


def processing_label(version: Column) -> Column:
    """Warehouse rule: the suffix alone decides; longest suffix first."""
    text = F.upper(version)
    branches = None
    for suffix, label in C.PROCESSING_LABELS.items():
        branches = (F if branches is None else branches).when(text.endswith(suffix), F.lit(label))
    return branches.when(version.rlike(r"^[0-9]+(\.[0-9]+)?\z"), F.lit(C.STANDARD_PROCESSING)).otherwise(
        F.lit(C.TEXT_SENTINEL)
    )


_STREAM_VERSION = r"^(\d+(?:\.\d+)?)(NRT|URT|RT)?\z"


def stream_version(version: Column) -> Column:
    """Stream rule: number plus known suffix must be the whole text, else null."""
    return F.nullif(F.regexp_extract(F.upper(version), _STREAM_VERSION, 1), F.lit(""))


def stream_processing_label(version: Column) -> Column:
    text = F.upper(version)
    suffix = F.regexp_extract(text, _STREAM_VERSION, 2)
    return F.when(
        text.rlike(_STREAM_VERSION), label_of(suffix, C.PROCESSING_LABELS, C.STANDARD_PROCESSING)
    ).otherwise(F.lit(C.TEXT_SENTINEL))


def display(label: Column, names: Mapping[str, str]) -> Column:
    return label_of(label, names, C.DISPLAY_UNKNOWN)
