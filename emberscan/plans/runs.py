"""Whole runs over a warehouse folder: landing a day, building the layers, gating them."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators import incremental, quality
from ..operators.guards import require_single_date
from ..operators.region import attach_regency, normalise_types, rejected_points
from ..operators.spatial import Grid
from ..schemas import STREAM_ENRICHED
from ..session import saved_copy
from ..sources import discovery, lake
from ..sources.versions import Draft, VersionedTable
from . import intermediate, marts, staging, star
from .declared_checks import DECLARED, GATES
from .release import Release, audit_and_publish, audited

@dataclass(frozen=True)
class Warehouse:
    """Table locations under one root."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"


GRID = "west double, south double, side double, depths array<int>"
RAW, STREAM, CORE, MART = "raw", "streaming", "intermediate", "mart"


def load_references(spark: SparkSession, house: Warehouse, lake_root: str) -> None:
    for source, table in (("regency", "raw_regencies"), ("province", "raw_provinces")):
        raw_table(spark, house, table).overwrite(spark.read.parquet(f"{lake_root}/reference/{source}.parquet"))


def raw_table(spark: SparkSession, house: Warehouse, table: str) -> VersionedTable:
    """A raw table: a failed load leaves it as it was, and a load run again takes its own place."""
    dated = table == "raw_detections"
    return VersionedTable(spark, house.path(RAW, table), "acq_date" if dated else None, ["regency_id"] if dated else ())


def run_batch(
    spark: SparkSession,
    house: Warehouse,
    lake_root: str,
    day: str,
    index: DataFrame,
    grid: Grid,
    on_multiple: str = "first",
    version_mode: str = "int",
) -> discovery.SourceReport:
    """Discover the day's sources and load its batch detections with their regency."""
    stream_path = house.path(STREAM, "fire_detection_nrt_raw")
    stream = spark.read.parquet(stream_path) if storage.has_table(spark, stream_path) else None
    found = discovery.discover(spark, lake_root, day, stream)
    if found.batch_exists:
        rows = spark.read.option("basePath", _table_root(found.batch_source)).parquet(found.batch_source)
        located = attach_regency(rows.drop("year", "month"), index, grid, on_multiple)
        with saved_copy(normalise_types(located, version_mode), "load") as loaded:
            if not loaded.isEmpty():
                require_single_date(loaded, "acq_date")
            raw_table(spark, house, "raw_detections").load(loaded, day)
        rejected = rejected_points(rows.drop("year", "month"))
        raw_table(spark, house, "rejected_detections").replace_part(rejected, day)
    return found


def _table_root(object_path: str) -> str:
    """Folder above the year/month/day partitions, or the object itself."""
    return object_path.split("/year=")[0]


def build_staging(spark: SparkSession, house: Warehouse) -> dict[str, DataFrame]:
    """Staging relations as temporary views; an absent stream table counts as empty."""
    raw = raw_table(spark, house, "raw_detections").read()
    enriched_path = house.path(STREAM, "fire_detection_nrt_enriched")
    if storage.has_table(spark, enriched_path):
        enriched = spark.read.schema(STREAM_ENRICHED).parquet(enriched_path)
    else:
        enriched = spark.createDataFrame([], STREAM_ENRICHED)
    tables = {
        "stg_detection_batch": staging.stage_batch(raw),
        "stg_detection_stream": staging.stage_stream(enriched),
        "stg_regency": staging.stage_regency(raw_table(spark, house, "raw_regencies").read()),
        "stg_province": staging.stage_province(raw_table(spark, house, "raw_provinces").read()),
    }
    tables["stg_detection"] = staging.stage_union(tables["stg_detection_batch"], tables["stg_detection_stream"])
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


def _saved(spark: SparkSession, df: DataFrame, path: str, by_day: bool) -> DataFrame:
    if by_day:
        lake.write_partitioned(df, path, ["acquisition_date"], ["regency_id"])
    else:
        lake.write_plain(df, path)
    return spark.read.schema(df.schema).parquet(path)


def build_intermediate(
    spark: SparkSession, house: Warehouse, stages: dict[str, DataFrame], date: str | None = None
) -> dict[str, DataFrame]:
    """Rebuild the detection table, quarantine and dimensions; upsert the fact.

    Labels and times come from one projection; the enriched and labelled
    relations on their own stay views.
    """
    staged = stages["stg_detection"]
    tables = {
        "int_detection_enrich": intermediate.enrich_time(staged),
        "int_detection_business": intermediate.label_business(staged),
        "int_detection_quarantine": _saved(
            spark, intermediate.quarantine(staged), house.path(CORE, "int_detection_quarantine"), True
        ),
        "int_detection_join": _saved(
            spark, intermediate.describe(staged), house.path(CORE, "int_detection_join"), True
        ),
        "dim_location": _saved(
            spark, star.dim_location(stages["stg_regency"], stages["stg_province"]),
            house.path(CORE, "dim_location"), False,
        ),
    }
    detections = tables["int_detection_join"]
    for name, build in (
        ("dim_satellite", star.dim_satellite),
        ("dim_detection_classification", star.dim_detection_classification),
        ("dim_collecting_process", star.dim_collecting_process),
    ):
        tables[name] = _saved(spark, build(detections), house.path(CORE, name), False)
    fact_path = house.path(CORE, "fct_detection")
    scope = date if storage.has_table(spark, fact_path) else None
    fact = star.fct_detection(detections, scope)
    # The fact is a projection of a table just saved: no further copy is needed.
    incremental.upsert(spark, fact_path, fact, cluster_by=["regency_id"], saved=True)
    tables["fct_detection"] = spark.read.schema(fact.schema).parquet(fact_path)
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


def build_marts(
    spark: SparkSession, house: Warehouse, core: dict[str, DataFrame], date: str | None = None, as_of=None
) -> dict[str, DataFrame]:
    """Replace the mart's days in scope, then rebuild the rankings."""
    path = house.path(MART, "daily_detection")
    scope = marts.mart_scope(core["fct_detection"], date, as_of, incremental=storage.has_table(spark, path))
    daily = marts.daily_detection(scope, core["dim_detection_classification"], core["dim_location"])
    incremental.overwrite_dates(daily, path, cluster_by=["province_name"])
    tables = {"daily_detection": spark.read.schema(daily.schema).parquet(path)}
    for name, build in (("top_province", marts.top_province), ("top_regency", marts.top_regency)):
        tables[name] = _saved(spark, build(tables["daily_detection"]), house.path(MART, name), False)
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


def run_declared(tables: dict[str, DataFrame], parents: dict[str, DataFrame] | None = None) -> list[str]:
    """Declared tests of the given models. Raises on errors, returns warnings."""
    warnings = []
    for name, table in tables.items():
        if name in DECLARED:
            rules = DECLARED[name]
            result = quality.report(table, rules, parents or tables)
            warnings += [f"{name}.{check}" for check in quality.enforce(result, name, rules.warn)]
    return warnings


def gate(spark: SparkSession, layer: str) -> None:
    table, rules = GATES[layer]
    quality.enforce(quality.quality_group(spark, table, rules.not_null, rules.invalid), table)


def run_transform(
    spark: SparkSession, house: Warehouse, date: str | None = None, as_of=None, declared: bool = True
) -> list[str]:
    """Staging, intermediate and marts, each gated before the next starts."""
    warnings = []
    stages = build_staging(spark, house)
    if declared:
        warnings += run_declared(stages)
    gate(spark, "staging")
    core = build_intermediate(spark, house, stages, date)
    if declared:
        warnings += run_declared(core)
    gate(spark, "intermediate")
    built = build_marts(spark, house, core, date, as_of)
    if declared:
        warnings += run_declared(built)
    gate(spark, "mart")
    return warnings


def run_published(spark: SparkSession, house: Warehouse, date: str | None = None) -> int:
    """Staging to marts as one release: staged, audited by all declared checks and gates, then switched together.

    With a date, that day's part of the dated tables is built anew and the others are kept. Returns the release's number;
    a failed check leaves the last release as it is.
    """
    release = Release(spark, f"{house.root}/published")
    stages = build_staging(spark, house)
    staged = stages["stg_detection"]
    in_scope = staged if date is None else staged.where(F.col("acquisition_date") == F.lit(date).cast("date"))

    def dated(name: str, rows: DataFrame, cluster: str) -> Draft:
        table = release.table(name, "acquisition_date", (cluster,))
        return table.stage_overwrite(rows) if date is None or not release.versions() else table.stage_load(rows, date)

    drafts = {
        "int_detection_quarantine": dated("int_detection_quarantine", intermediate.quarantine(in_scope), "regency_id"),
        "int_detection_join": dated("int_detection_join", intermediate.describe(in_scope), "regency_id"),
        "dim_location": release.table("dim_location").stage_overwrite(star.dim_location(stages["stg_regency"], stages["stg_province"])),
    }
    detections = drafts["int_detection_join"].read()
    for name, build in (
        ("dim_satellite", star.dim_satellite),
        ("dim_detection_classification", star.dim_detection_classification),
        ("dim_collecting_process", star.dim_collecting_process),
    ):
        drafts[name] = release.table(name).stage_overwrite(build(detections))
    fact = star.fct_detection(detections)
    drafts["fct_detection"] = release.table("fct_detection", "acquisition_date", ("regency_id",)).stage_overwrite(fact)
    daily = marts.daily_detection(
        drafts["fct_detection"].read(), drafts["dim_detection_classification"].read(), drafts["dim_location"].read()
    )
    drafts["daily_detection"] = release.table("daily_detection", "acquisition_date", ("province_name",)).stage_overwrite(daily)

    def audit(tables: dict[str, DataFrame]) -> None:
        audited(DECLARED)(stages | tables)
        for layer, (name, rules) in GATES.items():
            checked = (stages | tables)[name]
            quality.enforce(quality.check_columns(checked, rules), f"{layer} gate of {name}")

    return audit_and_publish(release, drafts, audit)


def save_region_index(index: DataFrame, grid: Grid, path: str) -> None:
    """Keep the cell index and its grid: boundaries change rarely, points arrive daily."""
    lake.write_plain(index, f"{path}/cells")
    lake.write_plain(index.sparkSession.createDataFrame([asdict(grid)], GRID), f"{path}/grid")


def load_region_index(spark: SparkSession, path: str) -> tuple[DataFrame, Grid]:
    kept = spark.read.parquet(f"{path}/grid").first()
    return spark.read.parquet(f"{path}/cells"), Grid(kept["west"], kept["south"], kept["side"], tuple(kept["depths"]))
