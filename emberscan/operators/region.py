"""From raw detections to detections with a regency id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import REJECT_REASON
from ..functions.coerce import lenient_date, lenient_double, lenient_long
from ..functions.keys import admin_name_key
from .guards import BROADCAST_ROWS, require_unique
from .spatial import EDGES_PER_CELL, Grid, build_cell_index, locate_points


def coerce_coordinates(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {name: lenient_double(raw, name) for name in ("latitude", "longitude")}
    )


FINE_EDGES_PER_CELL = 8
_LOCATED = "latitude is not null and longitude is not null"


def valid_points(raw: DataFrame) -> DataFrame:
    """Rows with both coordinates; the others are what `rejected_points` returns."""
    return coerce_coordinates(raw).where(_LOCATED)


def rejected_points(raw: DataFrame) -> DataFrame:
    """Rows without a usable coordinate, as they came in, with the reason."""
    checked = {name: lenient_double(raw, name) for name in ("latitude", "longitude")}
    return raw.where(checked["latitude"].isNull() | checked["longitude"].isNull()).withColumn(
        "reject_reason", F.lit(REJECT_REASON)
    )


def normalise_types(raw: DataFrame, version_mode: str = "int") -> DataFrame:
    """Column types before a raw load; bad values become null.

    `int` keeps a version only if it is a whole number; `string` keeps it as is.
    """
    if "acq_date" not in raw.columns:
        raise ValueError("input has no acq_date column")
    changes = {
        "acq_date": F.date_format(lenient_date(raw, "acq_date"), "yyyy-MM-dd"),
        "acq_time": F.col("acq_time").cast("string"),
        "version": lenient_long(raw, "version") if version_mode == "int" else F.col("version").cast("string"),
    }
    for name in ("type", "regency_id"):
        if name in raw.columns:
            changes[name] = lenient_long(raw, name)
    return raw.withColumns(changes)


def resolve_boundaries(boundaries: DataFrame, regencies: DataFrame) -> DataFrame:
    """Give every boundary its regency id by name key; a key naming two regencies fails.

    Done once on the boundary side, so points never join the reference table.
    """
    keyed = regencies.select("regency_id", admin_name_key(F.col("regency_name")).alias("regency_key"))
    require_unique(keyed, "regency_key")
    return boundaries.join(keyed, "regency_key", "left")


def edge_budget(boundaries: DataFrame) -> int:
    """Small cells, in which a point tests few edges, while their names are sure to fit a broadcast."""
    corners = F.aggregate("rings", F.lit(0).cast("bigint"), lambda n, ring: n + F.coalesce(F.size(ring), F.lit(0)))
    edges = boundaries.agg(F.sum(corners)).first()[0] or 0
    return FINE_EDGES_PER_CELL if edges <= BROADCAST_ROWS // 2 else EDGES_PER_CELL


def region_index(
    boundaries: DataFrame, regencies: DataFrame, path: str | None = None, budget: int | None = None
) -> tuple[DataFrame, Grid]:
    """Cell index with regency ids, written to `path` or a scratch folder, and its grid.

    Boundaries change rarely, points arrive daily: the index is written once and joined often, so
    its cells are small unless `budget` says otherwise.
    """
    budget = budget or edge_budget(boundaries)
    return build_cell_index(resolve_boundaries(boundaries, regencies), ["regency_id"], budget=budget, path=path)


def attach_regency(
    raw: DataFrame, index: DataFrame, grid: Grid, on_multiple: str = "first", **options
) -> DataFrame:
    """Valid points with `regency_id`, null where no boundary or no regency matches."""
    return locate_points(valid_points(raw.drop("regency_id")), index, grid, on_multiple, **options)
