"""Hotspot inputs derived from the given tables.

Each event becomes a detection, each nation a regency with an octagonal boundary
(some under a name no regency has), each region a province. The detection expressions are SQL text that
means the same in Spark and in DuckDB, so results can be compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.keys import admin_name_key

# --- Fixed values: the fixture's definition ----------------------------------
DETECTION_SQL = {
    "event_id": "event_id",
    "latitude": "-10e0+((event_id*7919)%15000)/1000e0",
    "longitude": "95e0+((event_id*10473)%45000)/1000e0",
    "brightness": "300e0+value",
    "scan": "0.32e0+(user_id%40)/100e0",
    "track": "0.36e0+(event_id%40)/100e0",
    "bright_t31": "280e0+value/10e0",
    "acq_date": "cast(ts as date)",
    "acq_time": "hour(ts)*100+minute(ts)",
    "satellite": "case event_id%5 when 0 then 'SNPP' when 1 then 'N20' when 2 then 'N21' when 3 then 'n20' end",
    "instrument": "'VIIRS'",
    "confidence": "case event_type when 'click' then 'h' when 'view' then 'N' when 'purchase' then 'l' else 'x' end",
    "version": (
        "case user_id%6 when 0 then '2.0NRT' when 1 then '2.0URT' when 2 then '2.0RT'"
        " when 3 then '2' when 4 then '2.0' else 'beta' end"
    ),
    "frp": "value",
    "daynight": "case when hour(ts) between 6 and 17 then 'D' else 'N' end",
    "type": "case when event_id%5<4 then event_id%5 end",
}
BOUNDARY_NAME_SQL = (
    "concat(case when n_nationkey % 2 = 1 then '' else 'Kota ' end, n_name,"
    " case when n_nationkey % 7 = 6 then '_LAMA' else '' end)"
)
# Octagon corners as fractions of a 9 by 3 degree cell, counter-clockwise.
CORNERS = [
    (0.25, 0.0), (0.75, 0.0), (1.0, 0.25), (1.0, 0.75),
    (0.75, 1.0), (0.25, 1.0), (0.0, 0.75), (0.0, 0.25),
]
# -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw detections, one per event, dealt evenly over tasks whatever the layout of the file."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    events = table(spark, sf_dir, "events").drop("props").repartition(tasks, "event_id")
    return events.selectExpr(*[f"{sql} as {name}" for name, sql in DETECTION_SQL.items()])


def regencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as bigint) as regency_id",
        "cast(n_regionkey as bigint) as province_id",
        "case when n_nationkey % 2 = 1 then concat('KABUPATEN ', n_name) else concat('KOTA ', n_name) end as regency_name",
    )


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr(
        "cast(r_regionkey as bigint) as province_id", "r_name as province_name"
    )


def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One octagon per nation; every seventh bears a name that no regency has."""
    ring = ", ".join(f"named_struct('x', x0 + 9 * {x!r}d, 'y', y0 + 3 * {y!r}d)" for x, y in CORNERS)
    return (
        table(spark, sf_dir, "nation")
        .selectExpr(
            "cast(n_nationkey as bigint) as boundary_id",
            f"{BOUNDARY_NAME_SQL} as WADMKK",
            "cast(n_regionkey as string) as WADMPR",
            "95e0 + 9 * (n_nationkey % 5) as x0",
            "-10e0 + 3 * floor(n_nationkey / 5) as y0",
        )
        .select(
            "boundary_id", "WADMKK", "WADMPR",
            admin_name_key(F.col("WADMKK")).alias("regency_key"),
            F.expr(f"array(array({ring}))").alias("rings"),
        )
    )


def overlapping_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per region a multipolygon: a rectangle that reaches into the next one's, with a hole, and an island in the hole."""
    def box(west: str, south: str, east: str, north: str) -> str:
        corners = ((west, south), (east, south), (east, north), (west, north))
        return "array(" + ", ".join(f"named_struct('x', cast({x} as double), 'y', cast({y} as double))" for x, y in corners) + ")"

    rings = [box("x0", "-10", "x0 + 11", "5"), box("x0 + 3", "-6", "x0 + 7", "1"), box("x0 + 4", "-4", "x0 + 6", "-2")]
    return (
        table(spark, sf_dir, "region")
        .selectExpr("cast(r_regionkey as bigint) as boundary_id", "r_name as province_name", "95e0 + 9 * r_regionkey as x0")
        .selectExpr("boundary_id", "province_name", f"array({', '.join(rings)}) as rings")
    )


def _box(west: float, south: float, east: float, north: float) -> list[tuple[float, float]]:
    return [(west, south), (east, south), (east, north), (west, north), (west, south)]


# Geometries in a unit square, as parts of rings; what is wrong with each stands beside it.
GEOMETRIES: list[tuple[list[list[list[tuple[float, float]]]], list[str]]] = [
    ([[_box(0, 0, 1, 1)]], []),
    ([[[(0, 0), (1, 1), (1, 0), (0, 1), (0, 0)]]], ["CROSSING"]),
    ([[_box(0, 0, 1, 1), _box(0.25, 0.25, 0.75, 0.75)]], []),
    ([[_box(0, 0, 1, 1), _box(0.5, 0.25, 1.25, 0.75)]], ["CROSSING", "HOLE_OUTSIDE"]),
    ([[_box(0, 0, 1, 1), _box(1.125, 0.25, 1.25, 0.75)]], ["HOLE_OUTSIDE"]),
    ([[_box(0, 0, 1, 1), _box(0.125, 0.125, 0.875, 0.875), _box(0.25, 0.25, 0.75, 0.75)]], ["NESTED_HOLES"]),
    ([[_box(0, 0, 0.375, 1)], [_box(0.625, 0, 1, 1)]], []),
    ([[_box(0, 0, 1, 1)], [_box(0.25, 0.25, 0.75, 0.75)]], ["OVERLAPPING_PARTS"]),
    ([[_box(0, 0, 1, 1), _box(0.125, 0.125, 0.875, 0.875)], [_box(0.25, 0.25, 0.75, 0.75)]], []),
    ([[_box(0, 0, 1, 1), [(0, 0.5), (0.375, 0.25), (0.625, 0.5), (0.375, 0.75), (0, 0.5)]]], []),
    ([[_box(0, 0, 1, 1)], [_box(0, 0, 1, 1)]], ["CROSSING", "OVERLAPPING_PARTS"]),
    ([[[(0, 0), (1, 0), (0.5, 0.5), (1, 1), (0, 1), (0.5, 0.5), (0, 0)]]], ["SELF_TOUCH"]),
    ([[_box(0, 0, 1, 1)[:-1]]], ["OPEN_RING"]),
]


def supplier_geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(geometry, parts): for each supplier one of the geometries, at a place of its own."""

    def text(parts) -> str:
        point = "named_struct('x', x0 + {0!r}d, 'y', y0 + {1!r}d)"
        rings = [[f"array({', '.join(point.format(float(x), float(y)) for x, y in ring)})" for ring in part] for part in parts]
        return f"array({', '.join(f'array({", ".join(part)})' for part in rings)})"

    chosen = " ".join(f"when {k} then {text(parts)}" for k, (parts, _) in enumerate(GEOMETRIES))
    return (
        table(spark, sf_dir, "supplier")
        .selectExpr(
            "cast(s_suppkey as bigint) as geometry",
            "-75e0 + 1.5e0 * (s_suppkey % 100) as x0",
            "-40e0 + 1.5e0 * (floor(s_suppkey / 100) % 50) as y0",
        )
        .selectExpr("geometry", f"case geometry % {len(GEOMETRIES)} {chosen} end as parts")
    )
