"""Coordinate work-lists, profiles and location ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.places import rounded_degrees
from .guards import require_unique
from .region import valid_points

WORKLIST_PLACES = 2


def distinct_coordinates(raw: DataFrame) -> DataFrame:
    return valid_points(raw).select("latitude", "longitude").distinct()


def coordinate_profile(raw: DataFrame, precisions: Sequence[int] = tuple(range(6))) -> DataFrame:
    """Distinct rounded coordinates per precision and the reduction against exact ones.

    Exact duplicates go first, so only distinct points are multiplied by the
    number of precisions. The exact count rides along as one more precision.
    """
    exact = -1
    variants = [
        F.struct(
            F.lit(p).alias("precision"),
            rounded_degrees(F.col("latitude"), p).alias("lat"),
            rounded_degrees(F.col("longitude"), p).alias("lon"),
        )
        for p in precisions
    ]
    variants.append(
        F.struct(F.lit(exact).alias("precision"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    )
    counts = (
        distinct_coordinates(raw).select(F.inline(F.array(*variants))).distinct()
        .groupBy("precision").agg(F.count(F.lit(1)).alias("unique_count"))
    )
    # One row per precision from here on, so the unpartitioned window is tiny.
    everything = Window.partitionBy()
    total = F.max(F.when(F.col("precision") == exact, F.col("unique_count"))).over(everything)
    kept_share = F.try_divide(F.col("unique_count").cast("double"), F.col("exact_count").cast("double"))
    return (
        counts.withColumn("exact_count", total)
        .where(F.col("precision") != exact)
        .select("precision", "unique_count", "exact_count", ((1 - kept_share) * 100).alias("reduction_pct"))
    )


def rounded_coordinates(raw: DataFrame, places: int = WORKLIST_PLACES) -> DataFrame:
    """Distinct coordinates at a coarse precision; what is no number or lies outside the globe is dropped.

    So there are at most 180 * 10 ** places + 1 latitudes, whatever the input.
    """
    on_globe = F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)
    return (
        valid_points(raw).where(on_globe)
        .select(
            rounded_degrees(F.col("latitude"), places).alias("latitude"),
            rounded_degrees(F.col("longitude"), places).alias("longitude"),
        )
        .distinct()
    )


def worklist(raw: DataFrame, limit: int, start: int = 0) -> DataFrame:
    """Slice [start, start + limit) of the distinct coordinates in (lat, lon) order."""
    ordered = rounded_coordinates(raw).orderBy("latitude", "longitude")
    return (ordered.offset(start) if start else ordered).limit(limit)


def unresolved(coordinates: DataFrame, known: DataFrame) -> DataFrame:
    """Coordinates not among the resolved ones (latitude_key, longitude_key)."""
    done = known.select(
        F.col("latitude_key").alias("latitude"), F.col("longitude_key").alias("longitude")
    ).distinct()
    return coordinates.join(done, ["latitude", "longitude"], "left_anti")


def assign_location_ids(coordinates: DataFrame, known: DataFrame) -> DataFrame:
    """Consecutive ids for new coordinates in (lat, lon) order, after the highest known id.

    Coordinates are two-decimal degrees, which bounds everything here: at most
    18,001 latitudes to accumulate over and 36,001 longitudes in each. So ids
    need no global sort and no single-task pass over the points.
    """
    fresh = unresolved(rounded_coordinates(coordinates), known)
    per_latitude = fresh.groupBy("latitude").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("latitude").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_latitude.select(
        "latitude", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    top = known.agg(F.coalesce(F.max("location_id"), F.lit(0)).cast("bigint")).scalar()
    within = F.row_number().over(Window.partitionBy("latitude").orderBy("longitude"))
    return (
        fresh.withColumn("_n", within)
        .join(offsets, "latitude")
        .select(
            (top + F.col("_offset") + F.col("_n")).cast("bigint").alias("location_id"),
            F.col("latitude").alias("latitude_key"),
            F.col("longitude").alias("longitude_key"),
        )
    )


def record_locations(known: DataFrame, resolved: DataFrame) -> DataFrame:
    """Known plus newly resolved locations; an id used twice is an error."""
    together = known.unionByName(resolved)
    require_unique(together, "location_id")
    return together
