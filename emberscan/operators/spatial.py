"""Point-in-polygon join over an adaptive grid.

Boundaries become an index of quadtree cells. A cell with more than `budget` edges
is split until its parts have few enough, so a ragged shore gets small cells and
open land large ones. Cells are named by Z-order codes with a leading one, which
holds their depth: the code of the cell above is the code shifted right.

For every boundary that touches it, a cell holds only what a point *inside it* needs.
Take the eastward ray of the point. Edges that do not pass through the cell matter
only where they cross the cell's eastern line above its north-eastern corner, and
how often they do, odd or even, is the same for all points in the cell: one bit
(`parity`). Edges that pass through it are kept (`edges`): each toggles
the answer if the ray meets it, and once more for each of its ends that lies east
of the cell and above the point, for there the ring goes on unseen. When a cell is split, the
bits of its parts follow from its own bit and its own edges, so nothing outside it is
looked at again.

Each point lies in at most one cell of the index, at one of a few depths: an equi-join per
depth, no aggregation, and nothing about a point is shuffled unless the index is too big
to broadcast.

Border points count as inside. Edges are stored south-to-north, so that two
boundaries sharing an edge judge a point next to it identically.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..session import scratch_path
from .guards import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast
from .skew import HOT_ROWS, salted_left_join

EDGES_PER_CELL = 32
FIRST_SPLIT, SPLIT = 3, 2  # depths gained by the first split of a cell and by later ones
MAX_DEPTH = 28
_SLACK = 1e-9


@dataclass(frozen=True)
class Grid:
    """The square that a quadtree divides, and the depths at which it has cells."""

    west: float
    south: float
    side: float
    depths: tuple[int, ...] = (0,)

    def size(self, depth: int) -> float:
        return self.side / 2**depth


# --- geometry as expressions -------------------------------------------------


def boundary_edges(boundaries: DataFrame, *keep: str) -> DataFrame:
    """One row per edge (x1, y1) (x2, y2), south to north. Unclosed rings are closed.

    A ring with a vertex that is null or not a finite number is no ring and is left out.
    """
    finite = "forall(ring, p -> coalesce(abs(p.x) < 1e300d and abs(p.y) < 1e300d, false))"
    rings = boundaries.select(*keep, F.explode("rings").alias("ring")).where(f"size(ring) > 0 and {finite}")
    ends = rings.select(
        *keep,
        F.explode(F.expr("transform(sequence(0, size(ring) - 1), i -> struct(ring[i] as a, ring[(i + 1) % size(ring)] as b))")).alias("e"),
    )
    edge = _northward("e.a.x", "e.a.y", "e.b.x", "e.b.y")
    return ends.select(*keep, F.expr(edge).alias("edge")).select(*keep, "edge.*")


def _northward(x1: str, y1: str, x2: str, y2: str) -> str:
    return f"""case when {y1} < {y2} or ({y1} = {y2} and {x1} <= {x2})
        then named_struct('x1', {x1}, 'y1', {y1}, 'x2', {x2}, 'y2', {y2})
        else named_struct('x1', {x2}, 'y1', {y2}, 'x2', {x1}, 'y2', {y1}) end"""


def _beyond(lon: str, e: str = "") -> str:
    """Where an edge meets a latitude: whether that is east of a longitude. Only for latitudes the edge spans."""
    return f"{lon} < ({e}x2 - {e}x1) * ({{lat}} - {e}y1) / ({e}y2 - {e}y1) + {e}x1"


def _met(lon: str, lat: str, e: str = "") -> str:
    """Whether the eastward ray meets an edge; an edge holds its southern end only."""
    return f"({lat} >= {e}y1 and {lat} < {e}y2 and {_beyond(lon, e).format(lat=lat)})"


def _toggles(lon: str, lat: str, east: str, e: str = "") -> str:
    """How often an edge that passes through a cell toggles the answer for a point in it."""
    unseen = [f"cast({lat} < {e}y{end} and {east} < {e}x{end} as int)" for end in (1, 2)]
    return f"(cast({_met(lon, lat, e)} as int) + {unseen[0]} + {unseen[1]})"


def _crosses_above(lon: str, lat: str) -> str:
    """Whether an edge crosses a meridian north of a latitude."""
    return f"""case when {lat} < y1 then ({lon} < x1) <> ({lon} < x2)
        when {lat} < y2 then ({_beyond(lon).format(lat=lat)}) <> ({lon} < x2) else false end"""


def _passes(west: str, south: str, east: str, north: str) -> str:
    """Whether an edge may pass through a rectangle; sure to be true if it does."""

    def at(lat: str) -> str:
        return f"(x1 + (x2 - x1) * ({lat} - y1) / nullif(y2 - y1, 0d))"

    low, high = at(f"greatest(y1, {south} - {_SLACK!r}d)"), at(f"least(y2, {north} + {_SLACK!r}d)")
    # Flat edges magnify the error of the longitude.
    slack = f"({_SLACK!r}d + coalesce(abs(x2 - x1) * 1e-12d / nullif(y2 - y1, 0d), 0d))"
    return f"""(y2 >= {south} - {_SLACK!r}d and y1 <= {north} + {_SLACK!r}d
        and least(x1, x2) <= {east} + {_SLACK!r}d and greatest(x1, x2) >= {west} - {_SLACK!r}d
        and coalesce(least({low}, {high}) <= {east} + {slack} and greatest({low}, {high}) >= {west} - {slack}, true))"""


def _crossings(lon: str, lat: str, east: str, edges: str, parity: str) -> str:
    """Toggles of a candidate's edges on top of its parity, or -1 when the point lies on one.

    What `_toggles` says, in the order that settles most edges by one comparison: those south of the point,
    then those north of it, of which only the ends east of the cell count.
    """
    unseen = [f"cast({east} < e.x{end} as int)" for end in (1, 2)]
    return f"""aggregate({edges}, {parity}, (n, e) -> case
        when n < 0 or {lat} > e.y2 then n
        when {lat} < e.y1 then n + {unseen[0]} + {unseen[1]}
        when (e.x2 - e.x1) * ({lat} - e.y1) = (e.y2 - e.y1) * ({lon} - e.x1)
             and {lon} between least(e.x1, e.x2) and greatest(e.x1, e.x2) then -1
        when {lat} < e.y2 then n + cast({_beyond(lon, "e.").format(lat=lat)} as int) + {unseen[1]}
        else n end)"""


def _interleaved(col: str, row: str) -> str:
    """Z-order code of a column and row below 2**28."""

    def spread(value: str) -> str:
        out = f"cast({value} as bigint)"
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            out = f"(({out} | shiftleft({out}, {shift})) & {mask}L)"
        return out

    return f"({spread(col)} | shiftleft({spread(row)}, 1))"


# --- building the index ------------------------------------------------------


def _square(edges: DataFrame) -> tuple[Grid, int]:
    """A square around all edges, its side a power of two, so that cell lines are exact numbers; and how many edges."""
    box = edges.agg(
        F.count(F.lit(1)).alias("edges"),
        F.min(F.least("x1", "x2")).alias("west"), F.max(F.greatest("x1", "x2")).alias("east"),
        F.min("y1").alias("south"), F.max("y2").alias("north"),
    ).first()
    if box["west"] is None:
        return Grid(0.0, 0.0, 1.0), 0
    west, south = math.floor(box["west"]) - 1.0, math.floor(box["south"]) - 1.0
    extent = max(box["east"] - west, box["north"] - south)
    return Grid(west, south, 2.0 ** math.ceil(math.log2(extent + 1))), box["edges"]


class _Saved:
    """Intermediate tables, written once and removed at the end."""

    def __init__(self, spark) -> None:
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame) -> DataFrame:
        self.paths.append(scratch_path(self.spark, "quadtree"))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def remove(self) -> None:
        for path in self.paths:
            storage.delete(self.spark, path)


def _parts(depths: int) -> Column:
    """The Z-order codes, within it, of the parts of a cell split so many depths down; one row each."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(4**depths - 1).cast("bigint")))


def _bits(code: str, depths: int, odd: int) -> str:
    """Column (even bits) or row (odd bits) of a part by its code."""
    return "(" + " | ".join(f"(shiftright({code}, {b + odd}) & {1 << b}L)" for b in range(depths)) + ")"


def build_cell_index(
    boundaries: DataFrame,
    payload: Sequence[str],
    id_col: str = "boundary_id",
    budget: int = EDGES_PER_CELL,
    path: str | None = None,
    edges: DataFrame | None = None,
    within: str | None = None,
) -> tuple[DataFrame, Grid]:
    """The index (cell, depth, east, candidates), written to `path`, and its grid.

    `edges` may be given with columns of their own, which candidates then carry; by default
    they are made from the boundaries' `rings`. `within` names a column of those edges and of the index: boundaries
    that differ in it have cells of their own and crowd no others, wherever they lie.

    Edges are never gathered before their cell is within the budget; until then they are
    rows that are filtered and copied down, and only counts and bits are aggregated. A boundary that
    covers a cell whole, without edges in it, goes down with the cell as one row, so that a
    point needs one cell only. At `MAX_DEPTH` cells are no longer split: that many edges
    within a ten-millionth of the extent meet in one vertex or repeat each other.
    """
    spark = boundaries.sparkSession
    saved = _Saved(spark)
    edges = boundary_edges(boundaries, id_col) if edges is None else edges
    edges = saved(edges.withColumnRenamed(id_col, "_id"))
    scope = [within] if within else []
    fields = [name for name in edges.columns if name not in ("_id", within)]
    grid, count = _square(edges)
    west, south = f"{grid.west!r}d", f"{grid.south!r}d"
    one = F.lit(1).cast("bigint")
    live = edges.withColumns({"cell": one, "col": F.lit(0).cast("bigint"), "row": F.lit(0).cast("bigint")})
    bits = edges.select(*scope, "_id").distinct().withColumns({"cell": one, "parity": F.lit(0)})
    covers = bits.where("false").select(*scope, "_id", "cell")
    depth, done, step, dense = 0, [], FIRST_SPLIT, None
    split = count > budget  # the cells to split: the square itself, or the rows of `dense`
    if scope and split:
        dense = saved(live.groupBy(*scope, "cell").count().where(F.col("count") > budget).select(*scope, "cell"))
        split = dense.count()
    while True:
        divided, carried_on = live, covers
        if dense is not None and split:
            marked = F.broadcast(dense) if split <= BROADCAST_ROWS else dense
            divided, carried_on = (f.join(marked, [*scope, "cell"], "left_semi") for f in (live, covers))
            done.append((depth, *(f.join(marked, [*scope, "cell"], "left_anti") for f in (live, covers)), bits))
        elif not split:
            done.append((depth, live, covers, bits))
            break
        size, part = grid.size(depth), grid.size(depth + step)
        corner = {
            "west": f"{west} + col * {part!r}d", "south": f"{south} + row * {part!r}d",
            "east": f"{west} + (col + 1) * {part!r}d", "north": f"{south} + (row + 1) * {part!r}d",
        }
        line = f"({west} + (above_col + 1) * {size!r}d)"
        parts = divided.select(
            *scope, "_id", *fields, F.col("cell").alias("above"), F.col("col").alias("above_col"),
            "row", "col", _parts(step).alias("z"),
        ).selectExpr(
            *scope, "_id", *fields, "above", "above_col", f"shiftleft(above, {2 * step}) + z as cell",
            f"col * {2**step} + {_bits('z', step, 0)} as col", f"row * {2**step} + {_bits('z', step, 1)} as row",
        )
        parts = parts.selectExpr("*", *(f"{sql} as {name}" for name, sql in corner.items()))
        inside = parts.withColumn("inside", F.expr(_passes("west", "south", "east", "north")))
        toggles = f"{_toggles('east', 'north', line)} + cast(inside and {_crosses_above('east', 'north')} as int)"
        sums = inside.groupBy(*scope, "_id", "above", "cell").agg(
            F.sum(F.expr(toggles)).alias("toggles"), F.bool_or("inside").alias("inside")
        )
        # The square has no bit to pass on: every edge is inside it.
        before = bits.select(*scope, "_id", F.col("cell").alias("above"), "parity")
        known = sums.join(before, [*scope, "_id", "above"]) if depth else sums.withColumn("parity", F.lit(0))
        placed = saved(known.selectExpr(*scope, "_id", "cell", "inside", "cast((parity + toggles) % 2 as int) as parity"))
        fresh = placed.where("not inside and parity = 1").select(*scope, "_id", "cell")
        if depth:
            lower = carried_on.select(*scope, "_id", _parts(step).alias("z"), "cell")
            fresh = saved(lower.selectExpr(*scope, "_id", f"shiftleft(cell, {2 * step}) + z as cell").union(fresh))
        covers = fresh
        live = saved(inside.where("inside").select(*scope, "_id", *fields, "cell", "col", "row"))
        bits, depth, step = placed.where("inside").select(*scope, "_id", "cell", "parity"), depth + step, SPLIT
        dense = live.groupBy(*scope, "cell").count().where(F.col("count") > budget).select(*scope, "cell")
        split = dense.count() if depth + step <= MAX_DEPTH else 0
        dense = saved(dense) if split else dense
    leaves = None
    for depth, kept, whole, parity in done:
        size = grid.size(depth)
        gathered = kept.groupBy(*scope, "_id", "cell", "col").agg(F.collect_list(F.struct(*fields)).alias("edges"))
        bordered = gathered.join(parity, [*scope, "_id", "cell"]).selectExpr(*scope, "_id", "cell", "parity", "edges")
        nothing = F.array().cast(gathered.schema["edges"].dataType)
        plain = whole.select(*scope, "_id", "cell", F.lit(1).alias("parity"), nothing.alias("edges"))
        both = bordered.union(plain).withColumn("depth", F.lit(depth)).withColumn("size", F.lit(size))
        leaves = both if leaves is None else leaves.union(both)
    carried = boundaries.groupBy(F.col(id_col).alias("_id")).agg(F.first(F.struct(*payload)).alias("payload"))
    index = leaves.join(carried, "_id").groupBy(*scope, "cell", "depth", "size").agg(
        F.collect_list(F.struct("payload", "parity", "edges")).alias("candidates")
    )
    column = _column_of("cell")
    index = index.select(*scope, "cell", "depth", F.expr(f"{west} + ({column} + 1) * size").alias("east"), "candidates")
    path = path or scratch_path(spark, "index")
    index.write.mode("overwrite").parquet(path)
    saved.remove()
    return spark.read.schema(index.schema).parquet(path), replace(grid, depths=tuple(depth for depth, *_ in done))


def _column_of(cell: str) -> str:
    """Column of a cell within its depth: the even bits of its code, without the leading one."""
    # The leading one stands at an even place, twice the depth; among the even bits it is 2**depth.
    out = f"({cell} & {0x5555555555555555}L)"
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        out = f"(({out} | shiftrightunsigned({out}, {shift})) & {mask}L)"
    return f"({out} - shiftleft(1L, depth))"


# --- joining points ------------------------------------------------------------


def _hits(lon: str, lat: str) -> Column:
    """Payloads of the candidates that hold the point."""
    crossed = _crossings(lon, lat, "east", "c.edges", "c.parity")
    return F.expr(
        f"""transform(
              filter(candidates, c -> case when size(c.edges) = 0 then c.parity = 1
                else exists(array({crossed}), n -> n < 0 or n % 2 = 1) end),
              c -> c.payload)"""
    )


def _with_codes(points: DataFrame, grid: Grid, lon: str, lat: str) -> DataFrame:
    """Points with `_code`, their cell at the deepest depth; null outside the grid."""
    deepest = max(grid.depths)
    size = f"{grid.size(deepest)!r}d"
    col, row = f"floor(({lon} - {grid.west!r}d) / {size})", f"floor(({lat} - {grid.south!r}d) / {size})"
    inside = (
        f"{lon} >= {grid.west!r}d and {lon} < {grid.west + grid.side!r}d"
        f" and {lat} >= {grid.south!r}d and {lat} < {grid.south + grid.side!r}d"
    )
    code = f"case when {inside} then {_interleaved(col, row)} + {1 << 2 * deepest}L end"
    return points.withColumn("_code", F.expr(code))


def _probed(points: DataFrame, index: DataFrame, grid: Grid, columns: Sequence[str]) -> DataFrame:
    """Points with the columns of their cell, by a broadcast join per depth; null where there is no cell."""
    found = points
    for depth in grid.depths:
        here = index.where(F.col("depth") == depth).select(
            F.col("cell").alias(f"_cell{depth}"), F.struct(*columns).alias(f"_at{depth}")
        )
        key = F.shiftright("_code", 2 * (max(grid.depths) - depth))
        found = found.join(F.broadcast(here), key == F.col(f"_cell{depth}"), "left").drop(f"_cell{depth}")
    place = F.coalesce(*(F.col(f"_at{depth}") for depth in grid.depths))
    return found.withColumn("_at", place).select(*points.columns, *(F.col(f"_at.{c}").alias(c) for c in columns))


def _locate(
    points: DataFrame, index: DataFrame, grid: Grid, lon: str, lat: str,
    strategy: str, hot_rows: int, max_rows: int, max_bytes: int,
) -> DataFrame:
    """Points with `candidates` and `east` of their cell (null when it is empty)."""
    keyed = _with_codes(points, grid, lon, lat)
    if strategy in ("auto", "broadcast") and fits_broadcast(index, max_rows, max_bytes):
        return _probed(keyed, index, grid, ["candidates", "east"]).drop("_code")

    # The whole index is too big: settle cells without edges by a broadcast of
    # just those cells, and shuffle only the points near a border.
    plain = F.forall("candidates", lambda c: F.size(c.edges) == 0)
    directory = index.select(
        "cell", "depth", "east", (~plain).alias("bordered"),
        F.when(plain, F.col("candidates")).alias("candidates"), F.col("cell").alias("leaf"),
    )
    if not fits_broadcast(directory, max_rows, max_bytes):
        return _shuffled(keyed, index, grid, hot_rows).drop("_code")
    placed = _probed(keyed, directory, grid, ["bordered", "leaf", "candidates", "east"]).drop("_code")
    settled = placed.where("not coalesce(bordered, false)").drop("bordered", "leaf")
    near = placed.where("bordered").drop("bordered", "candidates", "east")
    cells = index.where(~plain).select(F.col("cell").alias("leaf"), "candidates", "east")
    return settled.unionByName(salted_left_join(near, cells, ["leaf"], hot_rows).drop("leaf"))


def _shuffled(keyed: DataFrame, index: DataFrame, grid: Grid, hot_rows: int) -> DataFrame:
    """Not even the cells' names fit: a shuffled join per depth, each with the points' cells of that depth."""
    found = keyed
    for depth in grid.depths:
        here = index.where(F.col("depth") == depth).select(F.col("cell").alias("_cell"), F.struct("candidates", "east").alias(f"_at{depth}"))
        cell = F.shiftright("_code", 2 * (max(grid.depths) - depth))
        found = salted_left_join(found.withColumn("_cell", cell), here, ["_cell"], hot_rows).drop("_cell")
    place = F.coalesce(*(F.col(f"_at{depth}") for depth in grid.depths))
    return found.withColumn("_at", place).select(*keyed.columns, "_at.candidates", "_at.east")


def locate_points(
    points: DataFrame,
    index: DataFrame,
    grid: Grid,
    on_multiple: str = "all",
    lon: str = "longitude",
    lat: str = "latitude",
    strategy: str = "auto",
    keep_unmatched: bool = True,
    hot_rows: int = HOT_ROWS,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Attach the payload of the boundaries holding each point.

    `all` gives one row per boundary, `first` one row per point with the lowest
    payload (nulls last), `list` one row per point with all payloads in an array `matches`. Points in no boundary keep null payload, or are
    dropped when `keep_unmatched` is false. `strategy` is 'auto', or 'shuffle' to
    leave the whole index unsent even where it is measured to be small.
    """
    if on_multiple not in ("all", "first", "list"):
        raise ValueError("on_multiple is 'all', 'first' or 'list'")
    payload = index.schema["candidates"].dataType.elementType["payload"].dataType.names
    found = _locate(points, index, grid, f"`{lon}`", f"`{lat}`", strategy, hot_rows, max_rows, max_bytes)
    hits = found.withColumn("_hits", _hits(f"`{lon}`", f"`{lat}`")).drop("candidates", "east")
    if on_multiple == "list":
        matches = F.coalesce("_hits", F.array())
        listed = hits.select(*points.columns, matches.alias("matches"))
        return listed if keep_unmatched else listed.where("size(matches) > 0")
    if on_multiple == "first":
        lowest = f"""get(array_sort(_hits, (l, r) -> case
            when l.{payload[0]} is null and r.{payload[0]} is null then 0
            when l.{payload[0]} is null then 1
            when r.{payload[0]} is null then -1
            when l.{payload[0]} < r.{payload[0]} then -1
            when l.{payload[0]} > r.{payload[0]} then 1 else 0 end), 0)"""
        hits = hits.withColumn("_hits", F.expr(f"case when size(_hits) > 1 then array({lowest}) else _hits end"))
    # A generator in both cases, through which nothing is pushed: a filter on the payload would test the edges again.
    explode = F.explode_outer if keep_unmatched else F.explode
    result = hits.withColumn("_hit", explode("_hits"))
    return result.select(*points.columns, *[F.col(f"_hit.{p}").alias(p) for p in payload])


def points_in_their_cell(placed: DataFrame, grid: Grid, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Rows of an index with a point each: those whose point lies in their cell, with the payloads that hold it in `matches`."""
    coded = _with_codes(placed, grid, f"`{lon}`", f"`{lat}`")
    here = coded.where(f"shiftright(_code, 2 * ({max(grid.depths)} - depth)) = cell")
    return here.withColumn("matches", _hits(f"`{lon}`", f"`{lat}`")).drop("_code", "candidates", "east")


def boundaries_containing(boundaries: DataFrame, longitude: float, latitude: float) -> DataFrame:
    """Boundaries that hold one coordinate; a scan with a filter."""
    lon, lat = f"{longitude!r}d", f"{latitude!r}d"
    edges = F.expr(
        f"""flatten(transform(rings, ring -> transform(sequence(0, size(ring) - 1), i -> {
            _northward('ring[i].x', 'ring[i].y', 'ring[(i + 1) % size(ring)].x', 'ring[(i + 1) % size(ring)].y')
        })))"""
    )
    # The whole plane as one cell: no end of an edge lies east of it.
    crossed = F.expr(_crossings(lon, lat, "double('infinity')", "_edges", "0"))
    return (
        boundaries.withColumn("_edges", edges)
        .withColumn("_crossed", crossed)
        .where("_crossed < 0 or _crossed % 2 = 1")
        .drop("_edges", "_crossed")
    )
