"""Queries over the given tables: (spark, sf_dir) to DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import adapter
from ..functions.keys import coordinate_text
from ..functions.places import location_parts
from ..operators import audit, coordinates, incremental, quality, validity
from ..operators.ledger import BatchLedger
from ..operators.region import (
    attach_regency,
    normalise_types,
    region_index,
    rejected_points,
    valid_points,
)
from ..operators.spatial import build_cell_index, locate_points
from ..plans import intermediate, marts, staging, star
from ..operators.quality import Rules
from ..plans.declared_checks import DECLARED, GATES
from ..plans.release import Release, audit_and_publish, audited
from ..session import apply_runtime_conf, materialise, scratch_path
from ..sources import discovery, files, geojson, lake
from ..sources.catalogue import LandingCatalogue, land_all
from ..sources.versions import VersionedTable
from ..streaming import events, jobs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

STREAM_START = "2024-02-01 00:00:00"
BASE_UNTIL = "2024-01-20"
CHANGES_FROM = "2024-01-15"
ROLLING_AS_OF = "2024-01-30"


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime_conf(spark)
        return comparable(build(spark, sf_dir))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    REGISTRY[build.__name__] = run
    return run


def comparable(df: DataFrame) -> DataFrame:
    """Types another engine prints alike: text dates, doubles, 64-bit integers."""
    columns = []
    for field in df.schema:
        kind, col = field.dataType, F.col(field.name)
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        elif isinstance(kind, T.DecimalType):
            col = col.cast("double")
        elif isinstance(kind, T.IntegralType):
            col = col.cast("bigint")
        columns.append(col.alias(field.name))
    return df.select(*columns)


# --- inputs --------------------------------------------------------------------


def located(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Raw detections with regency ids."""
    index, grid = region_index(adapter.boundaries(spark, sf_dir), adapter.regencies(spark, sf_dir))
    return attach_regency(adapter.detections(spark, sf_dir), index, grid, **options)


def copied_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every detection as one to three event copies; later copies burn hotter."""
    rows = events.to_events(adapter.detections(spark, sf_dir), published_at=F.lit(STREAM_START).cast("timestamp"))
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("acq_time") % 3)))
    return copies.withColumn("frp", F.col("frp") + F.col("copy"))


def stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    started = F.lit(STREAM_START).cast("timestamp")
    made = copied_events(spark, sf_dir).withColumn("at", F.timestamp_add("HOUR", F.col("copy"), started))
    return events.to_stream_rows(made, ingested_at=F.col("at"))


def enriched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, grid = region_index(adapter.boundaries(spark, sf_dir), adapter.regencies(spark, sf_dir))
    return jobs.enrich_rows(stream_rows(spark, sf_dir), index, grid)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_batch(located(spark, sf_dir))


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intermediate.describe(staged(spark, sf_dir))


def saved_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The described detections as the table they are in a warehouse: built once, read by many."""
    return materialise(described(spark, sf_dir), "detections")


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_location(
        staging.stage_regency(adapter.regencies(spark, sf_dir)),
        staging.stage_province(adapter.provinces(spark, sf_dir)),
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fct_detection(described(spark, sf_dir))


def mart(spark: SparkSession, sf_dir: str, scope: Callable[[DataFrame], DataFrame] = lambda f: f) -> DataFrame:
    detections = saved_detections(spark, sf_dir)
    return marts.daily_detection(
        scope(star.fct_detection(detections)),
        star.dim_detection_classification(detections),
        locations(spark, sf_dir),
    )


def rounded(df: DataFrame, *names: str, places: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), places) for n in names})


_SUMS = ("total_frp", "total_brightness")


# --- staging ---------------------------------------------------------------------


@query
def stage_batch(spark, sf_dir):
    return staged(spark, sf_dir)


@query
def stage_stream_dedup(spark, sf_dir):
    return staging.stage_stream(enriched_stream(spark, sf_dir))


@query
def stage_union(spark, sf_dir):
    return staging.stage_union(staged(spark, sf_dir), staging.stage_stream(enriched_stream(spark, sf_dir)))


@query
def stage_union_prefer_batch(spark, sf_dir):
    # A point keeps its id whether or not a region holds it, so ids need no location.
    ids = staging.batch_ids(valid_points(adapter.detections(spark, sf_dir)))
    stream = staging.stage_stream(enriched_stream(spark, sf_dir))
    return staging.stage_union(staged(spark, sf_dir), stream, prefer_batch=True, batch_ids=ids)


@query
def stage_province(spark, sf_dir):
    return staging.stage_province(adapter.provinces(spark, sf_dir))


@query
def stage_regency(spark, sf_dir):
    return staging.stage_regency(adapter.regencies(spark, sf_dir))


# --- events ----------------------------------------------------------------------


@query
def event_projection(spark, sf_dir):
    feed = adapter.detections(spark, sf_dir).withColumnsRenamed(events.API_NAMES)
    return events.to_events(feed, events.API_NAMES).drop("published_timestamp")


@query
def event_projection_archive(spark, sf_dir):
    return events.to_events(adapter.detections(spark, sf_dir)).drop("published_timestamp")


@query
def stream_transform_batch(spark, sf_dir):
    return stream_rows(spark, sf_dir)


def _damaged_messages(spark, sf_dir):
    """Messages, some cut short, some without an id, some with a number in quotes."""
    rows = adapter.detections(spark, sf_dir)
    sound = events.to_events(rows, published_at=F.lit(STREAM_START).cast("timestamp"))
    text = F.to_json(F.struct(*sound.columns))
    kind = F.col("confidence")
    return sound.select(
        F.when(kind == "h", F.substring(text, 1, 60))
        .when(kind == "l", F.regexp_replace(text, '"event_id"', '"id"'))
        .when(kind == "x", F.regexp_replace(text, '"acq_time":[0-9]+', '"acq_time":2460'))
        .otherwise(text)
        .alias("value")
    )


@query
def decode_problems(spark, sf_dir):
    decoded = events.decode(_damaged_messages(spark, sf_dir))
    return decoded.groupBy(F.coalesce("problem", F.lit("NONE")).alias("problem")).agg(
        F.count(F.lit(1)).alias("messages")
    )


@query
def decode_events(spark, sf_dir):
    return events.usable_events(events.decode(_damaged_messages(spark, sf_dir)))


# --- landing and types --------------------------------------------------------------


@query
def normalize_types(spark, sf_dir):
    return normalise_types(adapter.detections(spark, sf_dir))


def _text_coordinates(spark, sf_dir):
    """Coordinates as the publishers write them, some unusable."""
    kind, text = F.col("confidence"), {name: coordinate_text(F.col(name)) for name in ("latitude", "longitude")}
    return adapter.detections(spark, sf_dir).select(
        "event_id",
        F.when(kind == "x", F.lit("n/a")).otherwise(text["latitude"]).alias("latitude"),
        F.when(kind == "h", F.lit(None)).otherwise(text["longitude"]).alias("longitude"),
    )


@query
def invalid_coordinates(spark, sf_dir):
    return rejected_points(_text_coordinates(spark, sf_dir))


@query
def valid_coordinates(spark, sf_dir):
    return valid_points(_text_coordinates(spark, sf_dir))


@query
def csv_scan(spark, sf_dir):
    """Detections written as CSV and scanned under the landing schema."""
    path = scratch_path(spark, "csv")
    columns = [f.name for f in files.LANDING]
    files.write_locations(adapter.detections(spark, sf_dir).select(*columns), path)
    return files.read_csv(spark, path)


@query
def reference_load(spark, sf_dir):
    root = scratch_path(spark, "reference")
    snapshot = files.write_snapshot(adapter.regencies(spark, sf_dir), root, "regency")
    return files.truncate_and_load(spark, snapshot, f"{root}/raw_regencies")


@query
def daily_split_counts(spark, sf_dir):
    root = scratch_path(spark, "lake")
    lake.split_by_day(adapter.detections(spark, sf_dir), root, "archive", "fire_detections_archive")
    landed = spark.read.parquet(lake.landing_path(root, "archive", "fire_detections_archive"))
    return landed.groupBy("year", "month", "acq_date").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("frp"), 4).alias("total_frp")
    )


@query
def date_range_scan(spark, sf_dir):
    root = scratch_path(spark, "lake")
    lake.split_by_day(adapter.detections(spark, sf_dir), root, "nrt", "fire_detections_nrt")
    days = lake.read_days(spark, root, "nrt", "fire_detections_nrt", CHANGES_FROM, "2024-02-15")
    return days.drop("year", "month")


@query
def source_discovery(spark, sf_dir):
    """A day in three came by batch alone, one in three by stream alone, the others by both."""
    batch = adapter.detections(spark, sf_dir).where("day(acq_date) % 3 <> 1")
    stream = stream_rows(spark, sf_dir).where("day(acquisition_date) % 3 <> 2")
    return discovery.day_sources(batch, stream)


@query
def landing_catalogue(spark, sf_dir):
    """Rows of every landed day and table, from the catalogue alone."""
    catalogue = LandingCatalogue(spark, scratch_path(spark, "lake"))
    archive = adapter.detections(spark, sf_dir)
    for table, rows in (("snpp", archive.where("satellite = 'SNPP'")), ("others", archive.where("coalesce(satellite, '') <> 'SNPP'"))):
        catalogue.land(rows, "archive", table)
    return catalogue.entries().select("table", "day", "rows")


@query
def discovery_report(spark, sf_dir):
    """Every day's sources: some days lie in two batch tables, some in one, some in none and of these some not in the stream."""
    catalogue = LandingCatalogue(spark, scratch_path(spark, "lake"))
    rows = adapter.detections(spark, sf_dir)
    land_all(catalogue, [
        ("archive", "first", rows.where("day(acq_date) % 3 <> 2")), ("archive", "second", rows.where("day(acq_date) % 3 = 1")),
    ])
    stream = stream_rows(spark, sf_dir).where("day(acquisition_date) % 2 = 0")
    return catalogue.discovered(rows.select(F.col("acq_date").alias("day")), stream)


# --- spatial -----------------------------------------------------------------------


@query
def enrich_point_in_polygon(spark, sf_dir):
    return located(spark, sf_dir).select("event_id", "latitude", "longitude", "regency_id")


@query
def enrich_shuffled(spark, sf_dir):
    """The same with the plan for an index too big to broadcast."""
    return located(spark, sf_dir, strategy="shuffle", hot_rows=20_000).select(
        "event_id", "latitude", "longitude", "regency_id"
    )


@query
def enrich_all_matches(spark, sf_dir):
    return located(spark, sf_dir, on_multiple="all").select("event_id", "regency_id")


@query
def enrich_overlaps(spark, sf_dir):
    """Every match of each point among overlapping multipolygons with holes and islands, in cells of few edges."""
    index, grid = build_cell_index(adapter.overlapping_boundaries(spark, sf_dir), ["boundary_id", "province_name"], budget=8)
    points = adapter.detections(spark, sf_dir).select("event_id", "latitude", "longitude")
    return locate_points(points, index, grid, on_multiple="all").select("event_id", "boundary_id", "province_name")


@query
def point_lookup(spark, sf_dir):
    """Boundaries that hold the centre of each day-and-confidence group."""

    def centre(name: str) -> str:
        return f"floor(sum(cast(round({name} * 1000) as bigint)) / count(*)) / 1000e0"

    centres = adapter.detections(spark, sf_dir).groupBy("acq_date", "confidence").agg(
        F.expr(centre("latitude")).alias("latitude"), F.expr(centre("longitude")).alias("longitude")
    )
    index, grid = build_cell_index(adapter.boundaries(spark, sf_dir), ["WADMKK", "WADMPR"])
    return locate_points(centres, index, grid, keep_unmatched=False)


@query
def geojson_boundaries(spark, sf_dir):
    folder = scratch_path(spark, "geojson")
    geojson.write_boundaries(adapter.boundaries(spark, sf_dir), folder)
    return geojson.read_boundaries(spark, folder, "*.txt").select(
        "WADMKK", "WADMPR", "regency_key",
        F.expr("size(rings[0])").alias("vertices"),
        F.expr("array_min(transform(rings[0], p -> p.x))").alias("west"),
        F.expr("array_max(transform(rings[0], p -> p.y))").alias("north"),
    )


@query
def boundary_profile(spark, sf_dir):
    """Some rings have two corners swapped, so that they cross themselves."""
    folder = scratch_path(spark, "geojson")
    ring = F.get("rings", F.lit(0))
    swapped = F.concat(F.array(F.get(ring, F.lit(1)), F.get(ring, F.lit(0))), F.slice(ring, 3, 6))
    crossed = F.when(F.col("boundary_id") % 11 == 5, F.array(swapped)).otherwise(F.col("rings"))
    geojson.write_boundaries(adapter.boundaries(spark, sf_dir).withColumn("rings", crossed), folder)
    return geojson.profile_boundaries(spark, folder, "*.txt").groupBy("all_valid", "crs").agg(
        F.sum("rows").alias("features"), F.max(F.array_join("geometry_types", ",")).alias("geometry_types")
    )


@query
def geometry_validity(spark, sf_dir):
    return validity.geometry_problems(adapter.supplier_geometries(spark, sf_dir))


# --- intermediate and star -------------------------------------------------------------


@query
def quarantine(spark, sf_dir):
    return intermediate.quarantine(staged(spark, sf_dir)).drop("quarantined_at")


@query
def temporal_enrich(spark, sf_dir):
    return intermediate.enrich_time(staged(spark, sf_dir)).select(
        "detection_id", "acquisition_date", "acquisition_time", *intermediate._temporal_columns()
    )


@query
def business_labels(spark, sf_dir):
    return intermediate.label_business(staged(spark, sf_dir)).select("detection_id", *intermediate.BUSINESS_COLUMNS)


_JOINED = [
    "detection_id", "regency_id", "detection_datetime", "detection_month_name", *intermediate.BUSINESS_COLUMNS
]


@query
def detection_join(spark, sf_dir):
    stage = staged(spark, sf_dir)
    return intermediate.join_detections(
        intermediate.enrich_time(stage), intermediate.label_business(stage)
    ).select(*_JOINED)


@query
def detection_describe(spark, sf_dir):
    return described(spark, sf_dir).select(*_JOINED)


@query
def dim_location(spark, sf_dir):
    return locations(spark, sf_dir)


@query
def dim_satellite(spark, sf_dir):
    return star.dim_satellite(described(spark, sf_dir))


@query
def dim_classification(spark, sf_dir):
    return star.dim_detection_classification(described(spark, sf_dir))


@query
def dim_process(spark, sf_dir):
    return star.dim_collecting_process(described(spark, sf_dir))


@query
def fct_detection(spark, sf_dir):
    return fact(spark, sf_dir)


# --- marts -------------------------------------------------------------------------


@query
def daily_detection(spark, sf_dir):
    return rounded(mart(spark, sf_dir), *_SUMS)


@query
def daily_detection_rolling(spark, sf_dir):
    return rounded(
        mart(spark, sf_dir, lambda f: marts.mart_scope(f, as_of=ROLLING_AS_OF, incremental=True)), *_SUMS
    )


@query
def top_province(spark, sf_dir):
    return marts.top_province(mart(spark, sf_dir))


@query
def top_regency(spark, sf_dir):
    return marts.top_regency(mart(spark, sf_dir))


@query
def trend(spark, sf_dir):
    return rounded(marts.trend(mart(spark, sf_dir)), "total_frp")


@query
def severity_ranking(spark, sf_dir):
    return rounded(marts.severity_ranking(mart(spark, sf_dir)), "total_frp")


@query
def severity_ranking_regency(spark, sf_dir):
    return rounded(marts.severity_ranking(mart(spark, sf_dir), "regency_name", top=10), "total_frp")


@query
def density_grid(spark, sf_dir):
    return marts.density_grid(adapter.detections(spark, sf_dir))


@query
def type_breakdown(spark, sf_dir):
    return rounded(marts.type_breakdown(mart(spark, sf_dir)), "total_frp")


# --- incremental --------------------------------------------------------------------


def _base_and_changes(df: DataFrame, day: str, measure: str) -> tuple[DataFrame, DataFrame]:
    """An older table and newer rows; the overlapping days come with changed values."""
    base = df.where(F.col(day) <= F.lit(BASE_UNTIL).cast("date"))
    changes = df.where(F.col(day) >= F.lit(CHANGES_FROM).cast("date")).withColumn(
        measure, (F.col(measure) + 1).cast(df.schema[measure].dataType)
    )
    return base, changes


_FACT_SLICE = ["detection_id", "regency_id", "fire_radiative_power", "acquisition_date"]


@query
def upsert_fact(spark, sf_dir):
    rows = materialise(fact(spark, sf_dir).select(*_FACT_SLICE), "fact_rows")
    base, changes = _base_and_changes(rows, "acquisition_date", "fire_radiative_power")
    path = scratch_path(spark, "fact")
    incremental.upsert(spark, path, base, cluster_by=["regency_id"], saved=True)
    incremental.upsert(spark, path, changes, cluster_by=["regency_id"], saved=True)
    return spark.read.parquet(path)


@query
def partition_overwrite(spark, sf_dir):
    daily = mart(spark, sf_dir)
    base, changes = _base_and_changes(daily, "acquisition_date", "detection_count")
    path = scratch_path(spark, "mart")
    incremental.overwrite_dates(base, path, cluster_by=["province_name"])
    incremental.overwrite_dates(changes, path, cluster_by=["province_name"])
    return spark.read.parquet(path).groupBy("acquisition_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("detection_count").alias("detections")
    )


@query
def date_scoped_replace(spark, sf_dir):
    """Reload one day with changed values; every other day stays."""
    rows = normalise_types(located(spark, sf_dir))
    path = scratch_path(spark, "raw")
    lake.write_partitioned(rows, path, ["acq_date"], ["regency_id"])
    day = rows.where(F.col("acq_date") == CHANGES_FROM).withColumn("frp", F.col("frp") + 1)
    incremental.replace_date(spark, path, day)
    return spark.read.parquet(path).select("event_id", "acq_date", "regency_id", "version", "type", "frp")


@query
def versioned_reload(spark, sf_dir):
    """A table of versions: one day loaded twice with all undated rows, and its rejects, of which the second load has none."""
    undated = F.when(F.col("confidence") != "x", F.col("acq_date"))
    rows = materialise(adapter.detections(spark, sf_dir).withColumn("acq_date", undated), "rows")
    root = scratch_path(spark, "versions")
    raw = VersionedTable(spark, f"{root}/raw", "acq_date")
    raw.overwrite(rows.where("acq_date is not null"))
    day = F.col("acq_date") == F.lit(CHANGES_FROM).cast("date")
    load = rows.where(day | F.col("acq_date").isNull()).withColumn("frp", F.when(day, F.col("frp") + 1).otherwise(F.col("frp")))
    rejects = VersionedTable(spark, f"{root}/rejects")
    for rejected in (load, load.where("false")):
        raw.load(load, CHANGES_FROM)
        rejects.replace_part(rejected, CHANGES_FROM)
    return raw.read().unionByName(rejects.read()).select("event_id", "acq_date", "frp")


@query
def append_unseen(spark, sf_dir):
    """Append a stream whose events are partly in the table already."""
    columns = ["event_id", "acquisition_date", "fire_radiative_power", "regency_id"]
    rows = materialise(enriched_stream(spark, sf_dir).select(*columns), "stream_rows")
    base, changes = _base_and_changes(rows, "acquisition_date", "fire_radiative_power")
    path = scratch_path(spark, "enriched")
    incremental.append_unseen(spark, path, base, "event_id")
    incremental.append_unseen(spark, path, changes, "event_id")
    return spark.read.parquet(path)


@query
def upsert_moved_days(spark, sf_dir):
    """Corrected rows move to the next day: the key directory names the days they leave."""
    rows = materialise(fact(spark, sf_dir).select(*_FACT_SLICE), "fact_rows")
    moved = rows.where(F.col("acquisition_date") >= F.lit(CHANGES_FROM).cast("date")).withColumn(
        "acquisition_date", F.date_add("acquisition_date", 1)
    )
    path = scratch_path(spark, "fact")
    for part in (rows, moved, moved):
        incremental.upsert(spark, path, part, cluster_by=["regency_id"], saved=True)
    return spark.read.parquet(path)


@query
def append_replayed(spark, sf_dir):
    """Three batches, sent again in another order, and once more without their names."""
    columns = ["event_id", "acquisition_date", "fire_radiative_power", "regency_id"]
    rows = materialise(enriched_stream(spark, sf_dir).select(*columns), "stream_rows")
    path = scratch_path(spark, "enriched")
    for name in (0, 1, 0, 2, 1, None):
        batch = rows if name is None else rows.where(F.dayofmonth("acquisition_date") % 3 == name)
        incremental.append_unseen(spark, path, batch, "event_id", batch=name if name is None else f"part {name}", saved=True)
    return spark.read.parquet(path)


@query
def unseen_events(spark, sf_dir):
    rows = stream_rows(spark, sf_dir).select("event_id", "acquisition_date", "fire_radiative_power")
    base, changes = _base_and_changes(rows, "acquisition_date", "fire_radiative_power")
    return incremental.unseen_rows(changes, base, "event_id")


# --- quality -------------------------------------------------------------------------


def _models(spark, sf_dir, detections: DataFrame | None = None) -> dict[str, DataFrame]:
    detections = saved_detections(spark, sf_dir) if detections is None else detections
    return {
        "fct_detection": star.fct_detection(detections),
        "dim_location": locations(spark, sf_dir),
        "dim_satellite": star.dim_satellite(detections),
        "dim_detection_classification": star.dim_detection_classification(detections),
        "dim_collecting_process": star.dim_collecting_process(detections),
    }


def _reported(models: dict[str, DataFrame], name: str) -> DataFrame:
    return quality.report(models[name], DECLARED[name], models)


@query
def quality_staging(spark, sf_dir):
    return quality.report(staged(spark, sf_dir), DECLARED["stg_detection"])


@query
def quality_fact(spark, sf_dir):
    return _reported(_models(spark, sf_dir), "fct_detection")


@query
def quality_classification(spark, sf_dir):
    return _reported(_models(spark, sf_dir), "dim_detection_classification")


@query
def quality_process(spark, sf_dir):
    return _reported(_models(spark, sf_dir), "dim_collecting_process")


@query
def quality_declared(spark, sf_dir):
    """Every declared check of every model."""
    stage = materialise(staged(spark, sf_dir), "staged")
    stream = materialise(staging.stage_stream(enriched_stream(spark, sf_dir)), "stream")
    # Detections are located and staged once, for the staging checks and for the star's.
    detections = materialise(intermediate.describe(stage), "detections")
    models = _models(spark, sf_dir, detections) | {
        "stg_detection_batch": stage,
        "stg_detection_stream": stream,
        "stg_detection": staging.stage_union(stage, stream),
        "stg_regency": staging.stage_regency(adapter.regencies(spark, sf_dir)),
        "stg_province": staging.stage_province(adapter.provinces(spark, sf_dir)),
        "int_detection_enrich": intermediate.enrich_time(stage),
        "int_detection_business": intermediate.label_business(stage),
        "int_detection_join": detections,
        "int_detection_quarantine": intermediate.quarantine(stage),
    }
    models["daily_detection"] = marts.daily_detection(
        models["fct_detection"], models["dim_detection_classification"], models["dim_location"]
    )
    parts = [_reported(models, name).withColumn("model", F.lit(name)) for name in DECLARED]
    return reduce(DataFrame.unionByName, parts)


@query
def quality_gate(spark, sf_dir):
    """The intermediate gate's rules, run on staging, where unmatched rows still are."""
    _, rules = GATES["intermediate"]
    staged(spark, sf_dir).createOrReplaceTempView("gated_detection")
    return quality.quality_group(
        spark, "gated_detection", rules.not_null, rules.invalid, ("acquisition_date", ROLLING_AS_OF)
    )


@query
def relationship_violations(spark, sf_dir):
    return quality.orphans(staged(spark, sf_dir), "regency_id", locations(spark, sf_dir), "regency_id")


@query
def duplicated_events(spark, sf_dir):
    return quality.duplicated(stream_rows(spark, sf_dir), "event_id")


@query
def audited_release(spark, sf_dir):
    """Two tables released together: rows readers see before a bad day, after it failed its audit, and after its repair."""
    rows = materialise(adapter.detections(spark, sf_dir).select("event_id", "acq_date", "frp"), "rows")
    release = Release(spark, scratch_path(spark, "published"))
    audit = audited({"raw": Rules(not_null=("event_id", "frp"), unique=("event_id",))})
    day = F.col("acq_date") == F.lit(CHANGES_FROM).cast("date")
    broken = rows.withColumn("frp", F.when(F.col("event_id") % 2 == 0, F.col("frp")))
    seen = []
    for step, given in enumerate((rows.where(~day), broken.where(day), rows.where(day)), 1):
        raw = release.table("raw", "acq_date")
        draft = raw.stage_overwrite(given) if step == 1 else raw.stage_load(given, CHANGES_FROM)
        daily = release.table("daily").stage_overwrite(draft.read().groupBy("acq_date").agg(F.count(F.lit(1)).alias("n")))
        with suppress(quality.QualityError):
            audit_and_publish(release, {"raw": draft, "daily": daily}, audit)
        counts = release.read("raw").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("frp").isNull()).alias("broken"))
        days = release.read("daily").agg(F.count(F.lit(1)).alias("days"), F.sum("n").alias("counted"))
        seen.append(counts.join(days).select(F.lit(step).alias("step"), "rows", "broken", "days", "counted"))
    return reduce(DataFrame.unionByName, seen)


# --- coordinates and names ---------------------------------------------------------------


@query
def distinct_coordinates(spark, sf_dir):
    return coordinates.distinct_coordinates(adapter.detections(spark, sf_dir))


@query
def coordinate_profile(spark, sf_dir):
    return rounded(coordinates.coordinate_profile(adapter.detections(spark, sf_dir)), "reduction_pct")


@query
def coordinate_worklist(spark, sf_dir):
    return coordinates.worklist(adapter.detections(spark, sf_dir), limit=1000)


@query
def coordinate_slice(spark, sf_dir):
    return coordinates.worklist(adapter.detections(spark, sf_dir), limit=500, start=250)


def _known_locations(spark, sf_dir):
    """Locations resolved by an earlier run: those seen up to a date."""
    early = adapter.detections(spark, sf_dir).where(F.col("acq_date") <= F.lit(BASE_UNTIL).cast("date"))
    nothing = spark.createDataFrame([], "location_id bigint, latitude_key double, longitude_key double")
    return coordinates.assign_location_ids(early, nothing)


@query
def assign_location_ids(spark, sf_dir):
    return coordinates.assign_location_ids(adapter.detections(spark, sf_dir), _known_locations(spark, sf_dir))


@query
def unresolved_coordinates(spark, sf_dir):
    rounded_pairs = coordinates.rounded_coordinates(adapter.detections(spark, sf_dir))
    return coordinates.unresolved(rounded_pairs, _known_locations(spark, sf_dir))


@query
def name_match_audit(spark, sf_dir):
    return audit.name_matches(adapter.boundaries(spark, sf_dir), adapter.regencies(spark, sf_dir))


@query
def name_match_counts(spark, sf_dir):
    return audit.match_counts(audit.name_matches(adapter.boundaries(spark, sf_dir), adapter.regencies(spark, sf_dir)))


@query
def unmatched_names(spark, sf_dir):
    return audit.unmatched_names(audit.name_matches(adapter.boundaries(spark, sf_dir), adapter.regencies(spark, sf_dir)))


@query
def parse_location(spark, sf_dir):
    """Customer segment, nation and region as a comma-separated place, split again."""
    nation = adapter.table(spark, sf_dir, "nation")
    region = adapter.table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    place = F.when(F.col("c_mktsegment") == "BUILDING", F.concat_ws(", ", "n_name", "r_name")).when(
        F.col("c_mktsegment") == "MACHINERY", F.lit("")
    ).otherwise(F.concat_ws(" , ", "c_name", "c_mktsegment", "n_name", "r_name"))
    text = (
        adapter.table(spark, sf_dir, "customer")
        .join(nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
        .join(region, "n_regionkey")
        .select("c_custkey", place.alias("location"))
    )
    return text.select("c_custkey", location_parts(F.col("location")).alias("l")).select("c_custkey", "l.*")


# --- streams ---------------------------------------------------------------------------


def _streamed_raw(spark, sf_dir) -> tuple[str, str]:
    """Publish every event copy as files and run the raw sink over them once."""
    root = scratch_path(spark, "stream")
    messages = copied_events(spark, sf_dir).drop("copy")
    events.encode(messages).select("value").write.text(f"{root}/messages")
    raw_path = f"{root}/raw"
    jobs.start_raw_sink(jobs.message_files(spark, f"{root}/messages"), raw_path, f"{root}/cp_raw").awaitTermination()
    return root, raw_path


@query
def stream_end_to_end(spark, sf_dir):
    _, raw_path = _streamed_raw(spark, sf_dir)
    return spark.read.parquet(raw_path).drop("ingested_timestamp")


@query
def stream_enrichment(spark, sf_dir):
    root, raw_path = _streamed_raw(spark, sf_dir)
    index, grid = region_index(adapter.boundaries(spark, sf_dir), adapter.regencies(spark, sf_dir))
    target = f"{root}/enriched"
    jobs.start_enrichment(spark, raw_path, target, f"{root}/cp_enriched", index, grid).awaitTermination()
    return spark.read.parquet(target).select("event_id", "fire_radiative_power", "regency_id", "acquisition_date")


@query
def stream_outcomes(spark, sf_dir):
    """Sound and damaged messages through the one-pass sink, in several batches: what was sent, and what became of it."""
    root = scratch_path(spark, "stream")
    _damaged_messages(spark, sf_dir).select("value").repartition(6).write.text(f"{root}/messages")
    for _ in range(2):
        source = jobs.message_files(spark, f"{root}/messages", files_per_trigger=2)
        jobs.start_outcome_sink(spark, source, f"{root}/raw", f"{root}/dead", f"{root}/cp").awaitTermination()
    sent = BatchLedger(spark, f"{root}/raw").entries().select(F.lit("SENT").alias("outcome"), (F.col("rows") + F.col("dead")).alias("n"))
    letters = jobs.committed_letters(spark, f"{root}/raw", f"{root}/dead").select("problem", F.lit(1).cast("bigint"))
    rows = jobs.committed_rows(spark, f"{root}/raw").select(F.lit("ROW"), F.lit(1).cast("bigint"))
    return sent.union(letters).union(rows).groupBy("outcome").agg(F.sum("n").alias("messages"))


@query
def stream_latest(spark, sf_dir):
    """The latest copy of each event, kept in state over batches whose borders fall anywhere."""
    root = scratch_path(spark, "latest")
    # Three batches, of as many files each as there are tasks to write and read them; copies of an event lie in any.
    each = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stream_rows(spark, sf_dir).repartition(3 * each, "event_id", "ingested_timestamp").write.parquet(f"{root}/raw")
    query = jobs.start_latest(spark, f"{root}/raw", f"{root}/latest", f"{root}/cp", late_after="60 days", files_per_trigger=each)
    query.awaitTermination()
    latest = spark.read.parquet(f"{root}/latest")
    return latest.select("event_id", "acquisition_date", "acquisition_time", "ingested_timestamp", "fire_radiative_power")
