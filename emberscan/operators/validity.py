"""Validity of polygons and multipolygons, near-linear in their edges.

Edges are brought to quadtree cells that hold few of them, so every pair of edges that meet
is found within one cell, and a cell tests a bounded number of pairs. That settles crossings.
Where the rings of a geometry do not cross, it is left to say which contains which: a point
on every edge is located among the rings, in the cell that holds the edge. Each geometry has cells of its own, so that
many in one place do not crowd each other's; nothing is broadcast for it, and no point travels.

Problems, in the order of their names in `PROBLEMS`:

* NO_RING: no geometry, or a part without a ring;
* OPEN_RING, FEW_VERTICES, OUT_OF_RANGE: the last vertex is not the first, fewer than four, or one is no place;
* CROSSING: two edges cross, or lie on each other (a spike, a repeated ring, rings sharing a side);
* SELF_TOUCH: a ring meets itself in a vertex;
* HOLE_OUTSIDE: some of a hole is not inside its part's outer ring;
* NESTED_HOLES: some of a hole is inside another hole of its part;
* OVERLAPPING_PARTS: some of a part lies in another part.

Rings may touch each other in single points. Repeated vertices are no problem. Not looked for: an interior cut in
pieces by rings that touch each other in a chain. Sides are computed in doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, saved_copy
from .spatial import EDGES_PER_CELL, Grid, build_cell_index, points_in_their_cell

PROBLEMS = (
    "NO_RING", "OPEN_RING", "FEW_VERTICES", "OUT_OF_RANGE", "CROSSING", "SELF_TOUCH",
    "HOLE_OUTSIDE", "NESTED_HOLES", "OVERLAPPING_PARTS",
)
_SAMPLE = 0.381966  # where on an edge its point lies: hardly where another ring touches it


def ring_problem(ring: Column) -> Column:
    """What is wrong with a ring by itself, or null."""
    placed = F.forall(ring, lambda p: F.coalesce(p.x.between(-180, 180) & p.y.between(-90, 90), F.lit(False)))
    closed = F.element_at(ring, 1) == F.element_at(ring, -1)
    return (
        F.when(F.size(ring) < 4, "FEW_VERTICES")
        .when(~placed, "OUT_OF_RANGE")
        .when(~F.coalesce(closed, F.lit(False)), "OPEN_RING")
    )


def _rings(geometries: DataFrame) -> DataFrame:
    """geometry, part, ring (0 is the outer one) and its vertices."""
    parts = geometries.select("geometry", F.posexplode_outer("parts").alias("part", "rings"))
    return parts.select("geometry", "part", F.posexplode_outer("rings").alias("ring", "vertices"))


def _edges(rings: DataFrame) -> DataFrame:
    """Edges between different vertices, numbered around their ring; south to north."""
    # Repeated vertices go, the closing one among them: what is left goes round.
    moving = "filter(vertices, (p, i) -> p <> vertices[(i + 1) % size(vertices)])"
    turned = rings.selectExpr("geometry", "part", "ring", f"{moving} as v").where("size(v) > 1")
    ends = turned.selectExpr("geometry", "part", "ring", "size(v) as around", "posexplode(v) as (at, a)", "v")
    ends = ends.selectExpr("geometry", "part", "ring", "around", "at", "a", "v[(at + 1) % around] as b")
    ends = ends.withColumn("north", F.expr("a.y < b.y or (a.y = b.y and a.x <= b.x)"))
    ordered = {f"{axis}{end}": f"if(north, {first}.{axis}, {second}.{axis})" for axis in "xy" for end, first, second in ((1, "a", "b"), (2, "b", "a"))}
    return ends.selectExpr("geometry", "part", "ring", "around", "at", *(f"{sql} as {name}" for name, sql in ordered.items()))


def _side(a: str, b: str, x: str, y: str) -> str:
    """On which side of the line from a to b a point lies."""
    return f"sign(({b[0]} - {a[0]}) * ({y} - {a[1]}) - ({b[1]} - {a[1]}) * ({x} - {a[0]}))"


def _meeting(a: str, b: str) -> str:
    """How two edges meet: 'CROSSING', 'SELF_TOUCH' or null."""
    ends = {e: ((f"{e}.x1", f"{e}.y1"), (f"{e}.x2", f"{e}.y2")) for e in (a, b)}
    b1, b2 = (_side(*ends[a], *p) for p in ends[b])
    a1, a2 = (_side(*ends[b], *p) for p in ends[a])
    apart = (
        f"greatest(least({a}.x1, {a}.x2), least({b}.x1, {b}.x2)) > least(greatest({a}.x1, {a}.x2), greatest({b}.x1, {b}.x2))"
        f" or greatest({a}.y1, {b}.y1) > least({a}.y2, {b}.y2)"
    )
    # On one line they overlap if the shared stretch is longer than a point.
    longer = (
        f"greatest(least({a}.x1, {a}.x2), least({b}.x1, {b}.x2)) < least(greatest({a}.x1, {a}.x2), greatest({b}.x1, {b}.x2))"
        f" or greatest({a}.y1, {b}.y1) < least({a}.y2, {b}.y2)"
    )
    neighbours = f"abs({a}.at - {b}.at) in (1, {a}.around - 1)"
    return f"""case when {apart} then null
        when {b1} = 0 and {b2} = 0 then case when {longer} then 'CROSSING'
          when {a}.part = {b}.part and {a}.ring = {b}.ring and not {neighbours} then 'SELF_TOUCH' end
        when {b1} * {b2} < 0 and {a1} * {a2} < 0 then 'CROSSING'
        when {b1} * {b2} <= 0 and {a1} * {a2} <= 0 and {a}.part = {b}.part and {a}.ring = {b}.ring
          and not {neighbours} then 'SELF_TOUCH' end"""


def _cells(rings: DataFrame, edges: DataFrame, budget: int) -> tuple[DataFrame, Grid]:
    """Cells of few edges, each of one geometry, whose rings are the candidates."""
    ring = F.struct("geometry", "part", "ring").alias("ring_id")
    # The edges name their ring twice: once for the index, once for the tests within a cell.
    return build_cell_index(
        rings.select(ring, "geometry", "part", "ring"), ["geometry", "part", "ring"], "ring_id", budget,
        edges=edges.select("*", ring), within="geometry",
    )


def crossings(index: DataFrame) -> DataFrame:
    """geometry, problem: crossings and self-touches, found cell by cell."""
    found = f"""array_distinct(flatten(transform(edges, a -> transform(
        filter(edges, b -> (a.part, a.ring, a.at) < (b.part, b.ring, b.at)), b -> {_meeting('a', 'b')}))))"""
    cells = index.selectExpr("geometry", "flatten(candidates.edges) as edges")
    return cells.select("geometry", F.explode(F.expr(found)).alias("problem")).where("problem is not null").distinct()


def nesting(index: DataFrame, grid: Grid) -> DataFrame:
    """geometry, problem: holes and parts that are not where they should be.

    The point of an edge lies in a cell that holds the edge, so that cell's row tells which other rings hold it.
    """
    points = index.select("*", F.explode(F.expr("flatten(candidates.edges)")).alias("e")).selectExpr(
        "*", "e.part", "e.ring",
        f"e.x1 + (e.x2 - e.x1) * {_SAMPLE}d as longitude", f"e.y1 + (e.y2 - e.y1) * {_SAMPLE}d as latitude",
    )
    located = points_in_their_cell(points, grid).withColumn(
        "own", F.expr("filter(matches, m -> not (m.part = part and m.ring = ring))")
    )
    mine = "filter(own, m -> m.part = part)"
    others = "filter(own, m -> m.part <> part and m.ring = 0)"
    in_part = f"exists({others}, s -> not exists(own, m -> m.part = s.part and m.ring > 0))"
    problems = {
        "HOLE_OUTSIDE": f"ring > 0 and not exists({mine}, m -> m.ring = 0)",
        "NESTED_HOLES": f"ring > 0 and exists({mine}, m -> m.ring > 0)",
        "OVERLAPPING_PARTS": in_part,
    }
    named = F.array(*(F.when(F.expr(sql), name) for name, sql in problems.items()))
    return located.select("geometry", F.explode(named).alias("problem")).where("problem is not null").distinct()


def geometry_problems(geometries: DataFrame, budget: int = EDGES_PER_CELL) -> DataFrame:
    """geometry, problem for every problem found in (geometry, parts); a sound geometry has no row.

    `parts` holds polygons, each a list of rings, the outer one first. Crossings and nesting are looked for in geometries
    whose rings are sound by themselves.
    """
    with saved_copy(geometries.select("geometry", "parts"), "geometries") as saved:
        rings = _rings(saved)
        alone = rings.select(
            "geometry", F.when(F.col("vertices").isNull(), "NO_RING").otherwise(ring_problem(F.col("vertices"))).alias("problem")
        ).where("problem is not null").distinct()
        sound = saved.join(alone.select("geometry").distinct(), "geometry", "left_anti")
        with saved_copy(_rings(sound), "rings") as whole:
            index, grid = _cells(whole, _edges(whole), budget)
            found = alone.union(crossings(index)).union(nesting(index, grid))
            # The rows themselves, so that the copies may go; at most nine a geometry, and none for sound ones.
            return materialise(found.distinct(), "problems")
