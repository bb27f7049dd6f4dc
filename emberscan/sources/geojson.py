"""Administrative boundaries from GeoJSON folders.

One boundary is one feature: `boundary_id`, its names, and `rings`, the rings
of all its parts in one list. Even-odd counting over that list treats holes
and separate parts alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.keys import admin_name_key
from ..operators.validity import geometry_problems
from ..schemas import GEOJSON

FILES = "*.geojson"
_POLYGON = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"


def _as_rings(coordinates: Column) -> Column:
    return F.transform(
        coordinates,
        lambda ring: F.transform(
            ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
        ),
    )


def _parts(geometry_type: Column, coordinates: Column) -> Column:
    """The polygons of a geometry, each a list of rings."""
    return F.when(geometry_type == "Polygon", F.array(_as_rings(F.from_json(coordinates, _POLYGON)))).when(
        geometry_type == "MultiPolygon", F.transform(F.from_json(coordinates, _MULTI), _as_rings)
    )


def _features(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    if not storage.glob(spark, f"{folder}/{pattern}"):
        raise FileNotFoundError(f"no {pattern} files in {folder}")
    return (
        spark.read.schema(GEOJSON)
        .option("multiLine", True)
        .json(f"{folder}/{pattern}")
        .select(
            F.input_file_name().alias("file"),
            F.coalesce("crs.properties.name", F.lit("EPSG:4326")).alias("crs"),
            F.posexplode_outer("features").alias("position", "feature"),
        )
        .select(
            "file",
            "crs",
            "position",
            F.col("feature.properties.WADMKK").alias("WADMKK"),
            F.col("feature.properties.WADMPR").alias("WADMPR"),
            F.col("feature.geometry.type").alias("geometry_type"),
            _parts(F.col("feature.geometry.type"), F.col("feature.geometry.coordinates")).alias("parts"),
        )
        .withColumn("rings", F.flatten("parts"))
    )


def read_boundaries(spark: SparkSession, folder: str, pattern: str = FILES) -> DataFrame:
    """Features with a name and a geometry, with a stable id and the name key."""
    return _features(spark, folder, pattern).where("WADMKK is not null and rings is not null").select(
        F.xxhash64("file", "position").alias("boundary_id"),
        "WADMKK",
        "WADMPR",
        admin_name_key(F.col("WADMKK")).alias("regency_key"),
        "rings",
    )


def write_boundaries(boundaries: DataFrame, folder: str) -> None:
    """Boundaries as feature collections of one feature, a file each. Open rings are closed."""

    def closed(ring: Column) -> Column:
        ends_meet = F.element_at(ring, 1) == F.element_at(ring, -1)
        return F.when(ends_meet, ring).otherwise(F.array_append(ring, F.element_at(ring, 1)))

    ring = F.transform("rings", lambda r: F.transform(closed(r), lambda p: F.array(p.x, p.y)))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("WADMKK", "WADMPR").alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), ring.alias("coordinates")).alias("geometry"),
    )
    collection = F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))
    boundaries.select(F.to_json(collection)).write.mode("overwrite").option("maxRecordsPerFile", 1).text(folder)


def profile_boundaries(spark: SparkSession, folder: str, pattern: str = FILES) -> DataFrame:
    """Per file: features, geometry types, whether every geometry is valid, CRS.

    A feature without a geometry, or of another kind than polygons, is not valid; see `operators.validity`.
    """
    features = _features(spark, folder, pattern).withColumn("geometry", F.xxhash64("file", "position"))
    present = F.col("position").isNotNull()
    bad = geometry_problems(features.where(present)).select("geometry").distinct().withColumn("bad", F.lit(True))
    return features.join(bad, "geometry", "left").groupBy("file").agg(
        F.count_if(present).alias("rows"),
        F.array_sort(F.collect_set("geometry_type")).alias("geometry_types"),
        F.coalesce(F.bool_and(F.when(present, F.col("bad").isNull())), F.lit(True)).alias("all_valid"),
        F.max("crs").alias("crs"),
    )
