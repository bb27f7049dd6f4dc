"""Point-in-polygon against brute force, borders, and plan shape."""

import random

import pytest
from pyspark.sql import functions as F

from emberscan.operators.guards import DuplicateKey
from emberscan.operators.region import attach_regency, rejected_points, region_index, resolve_boundaries
from emberscan.operators.spatial import (
    boundaries_containing,
    build_cell_index,
    locate_points,
)
from emberscan.schemas import RING

from .plans import explained

SCHEMA = f"boundary_id bigint, regency_id bigint, rings array<{RING}>"


def square(x, y, side):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]


def frame(spark, shapes):
    """shapes: {id: [ring, ...]}"""
    rows = [(i, i, [[(float(a), float(b)) for a, b in ring] for ring in rings]) for i, rings in shapes.items()]
    return spark.createDataFrame(rows, SCHEMA)


def points(spark, coordinates):
    return spark.createDataFrame(
        [(i, float(x), float(y)) for i, (x, y) in enumerate(coordinates)], "i int, longitude double, latitude double"
    )


def covers(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay, ax) > (by, bx):
                ax, ay, bx, by = bx, by, ax, ay
            if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and ay <= y <= by and min(ax, bx) <= x <= max(ax, bx):
                return True
            if ay <= y < by and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def brute(shapes, coordinates):
    found = set()
    for i, (x, y) in enumerate(coordinates):
        hits = {k for k, rings in shapes.items() if covers(rings, x, y)}
        found |= {(i, k) for k in hits} or {(i, None)}
    return found


def located(spark, shapes, coordinates, budget, **options):
    index, grid = build_cell_index(frame(spark, shapes), ["regency_id"], budget=budget)
    rows = locate_points(points(spark, coordinates), index, grid, **options).select("i", "regency_id").collect()
    return [tuple(r) for r in rows]


DONUT = {1: [square(0, 0, 4), square(1, 1, 2)]}
TWINS = {1: [square(0, 0, 2)], 2: [square(2, 0, 2)]}
PARTS = {7: [square(0, 0, 1), square(5, 5, 1)]}

CASES = [
    (DONUT, (0.5, 0.5), {1}),
    (DONUT, (9.0, 9.0), {None}),
    (DONUT, (4.0, 2.5), {1}),
    (DONUT, (0.0, 0.0), {1}),
    (DONUT, (2.0, 2.0), {None}),
    (DONUT, (1.0, 2.0), {1}),
    (DONUT, (3.0, 3.0), {1}),
    (PARTS, (5.5, 5.5), {7}),
    (PARTS, (3.0, 3.0), {None}),
    (TWINS, (2.0, 1.0), {1, 2}),
    (TWINS, (3.9, 0.1), {2}),
]


@pytest.mark.parametrize("budget", [4, 32])
def test_borders_holes_and_parts(spark, budget):
    for shapes in (DONUT, PARTS, TWINS):
        cases = [(p, want) for s, p, want in CASES if s is shapes]
        got = located(spark, shapes, [p for p, _ in cases], budget)
        assert set(got) == {(i, k) for i, (_, want) in enumerate(cases) for k in want}
        assert len(got) == sum(len(w) for _, w in cases)


def test_points_that_are_no_place_match_nothing(spark):
    odd = [(float("nan"), 1.0), (1.0, float("nan")), (float("inf"), 1.0), (1e300, -1e300)]
    assert located(spark, {1: [square(-5, -5, 10)]}, odd, 4) == [(i, None) for i in range(4)]


def test_first_match_takes_the_lowest_known_id(spark):
    assert located(spark, TWINS, [(2.0, 1.0)], 4, on_multiple="first") == [(0, 1)]


def blob(rng, cx, cy, radius, corners):
    import math

    return [
        (cx + radius * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / corners),
         cy + radius * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / corners))
        for k in range(corners)
    ]


@pytest.mark.parametrize("seed,size", [(1, 6), (2, 40)])
def test_random_polygons_match_brute_force(spark, seed, size):
    rng = random.Random(seed)
    shapes = {}
    for k in range(12):
        cx, cy = rng.uniform(95, 99), rng.uniform(-2, 2)
        rings = [blob(rng, cx, cy, rng.uniform(0.2, 1.2), rng.randint(3, 40))]
        if k % 3 == 0:
            rings.append(blob(rng, cx, cy, 0.05, 7))
        if k % 4 == 0:
            rings.append(blob(rng, cx + 3, cy, 0.3, 9))
        shapes[k] = rings
    spots = [(rng.uniform(94, 103), rng.uniform(-3.5, 3.5)) for _ in range(1500)]
    spots += [p for rings in shapes.values() for p in rings[0]]
    spots += [(round(x, 1), round(y, 1)) for x, y in spots[:300]]
    want = brute(shapes, spots)
    assert set(located(spark, shapes, spots, size)) == want
    assert set(located(spark, shapes, spots, size, strategy="shuffle", hot_rows=50)) == want
    nothing_fits = located(spark, shapes, spots, size, strategy="auto", hot_rows=50, max_rows=3)
    assert set(nothing_fits) == want and len(nothing_fits) == len(want)


def test_grid_aligned_shapes_match_brute_force(spark):
    """Vertices and edges exactly on cell lines, points too."""
    shapes = {1: [[(0, 0), (3, 0), (3, 1), (1, 1), (1, 2), (3, 2), (3, 3), (0, 3)]], 2: [square(1, 1, 1)]}
    spots = [(x / 2, y / 2) for x in range(-1, 9) for y in range(-1, 9)]
    for budget in (3, 32):
        assert set(located(spark, shapes, spots, budget)) == brute(shapes, spots)


def test_point_lookup_scans_boundaries(spark):
    found = boundaries_containing(frame(spark, TWINS), 2.0, 1.0)
    assert {r["regency_id"] for r in found.collect()} == {1, 2}
    assert boundaries_containing(frame(spark, DONUT), 2.0, 2.0).count() == 0


def test_cells_follow_the_budget(spark):
    """A dense shore is split down, open land is not; no cell holds more than the budget."""
    dense = [(95 + 0.0005 * k, 0.0002 * (k % 2)) for k in range(2000)]
    index, grid = build_cell_index(frame(spark, {1: [dense + [(96.0, 20.0), (95.0, 20.0)]]}), ["regency_id"])
    held = index.select("depth", F.expr("aggregate(transform(candidates, c -> size(c.edges)), 0, (a, n) -> a + n)").alias("n"))
    assert held.agg(F.max("n")).first()[0] <= 32
    assert max(grid.depths) - min(grid.depths) >= 6 and index.count() < 1000
    _, plain = build_cell_index(frame(spark, TWINS), ["regency_id"])
    assert plain.depths == (0,)


def test_a_long_shore_matches_brute_force(spark):
    """Many edges over many depths, a second boundary across them all, and points on and beside the shore."""
    rng = random.Random(7)
    shore = [(x / 400 + rng.uniform(0, 0.002), rng.uniform(0, 0.4) ** 2) for x in range(20_000)]
    shapes = {1: [shore + [(50.0, 30.0), (0.0, 30.0)]], 2: [square(-3, -3, 60)], 3: [square(10, 0.01, 0.3), square(10.1, 0.02, 0.1)]}
    spots = [(rng.uniform(-4, 58), rng.uniform(-4, 40)) for _ in range(60)]
    spots += [(rng.uniform(9.9, 10.5), rng.uniform(-0.1, 0.4)) for _ in range(60)] + rng.sample(shore, 20)
    want = brute(shapes, spots)
    assert set(located(spark, shapes, spots, 32)) == want
    assert set(located(spark, shapes, spots, 32, strategy="shuffle", hot_rows=20)) == want


def test_one_vertex_of_many_edges_ends_the_split(spark):
    """Forty edges meet in one vertex: no cell around it can hold fewer, so the deepest one holds them all."""
    star = [p for k in range(20) for p in ((0.0, 0.0), (1.0 + k, 30.0 - k), (1.5 + k, 30.0 - k))]
    spots = [(0.0, 0.0), (1e-9, 1e-9), (1.2, 29.9), (5.0, 1.0), (1.25, 30.0)]
    assert set(located(spark, {1: [star]}, spots, 32)) == brute({1: [star]}, spots)


def test_rings_that_are_none(spark):
    rows = [(1, 1, [[(0.0, 0.0), (None, 1.0), (1.0, 1.0)], [(0.0, float("nan")), (1.0, 1.0)], []]), (2, 2, None)]
    index, grid = build_cell_index(spark.createDataFrame(rows, SCHEMA), ["regency_id"])
    assert index.count() == 0
    assert [r["regency_id"] for r in locate_points(points(spark, [(0.5, 0.5)]), index, grid).collect()] == [None]


def test_no_point_is_shuffled_or_meets_every_boundary(spark):
    index, grid = build_cell_index(frame(spark, TWINS), ["regency_id"])
    plan = explained(locate_points(points(spark, [(1, 1)]), index, grid, strategy="broadcast"))
    assert "BroadcastHashJoin" in plan
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SortMergeJoin"):
        assert word not in plan
    plan = explained(locate_points(points(spark, [(1, 1)]), index, grid, strategy="shuffle"))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert word not in plan


def boundaries(spark):
    return frame(spark, TWINS).drop("regency_id").withColumn(
        "regency_key", F.when(F.col("boundary_id") == 1, "BOGOR").otherwise("KOTA_BOGOR")
    )


def regencies(spark, names):
    return spark.createDataFrame([(i, 9, n) for i, n in names], "regency_id bigint, province_id bigint, regency_name string")


def test_regions_get_small_cells(spark):
    """A point tests at most eight edges, and gets the region it gets with the larger cells."""
    coast = [(k / 10, (k % 2) / 10) for k in range(40)] + [(3.9, 3.0), (0.0, 3.0)]
    shapes = frame(spark, {1: [coast], 2: [square(5, 0, 3)]}).drop("regency_id").withColumn(
        "regency_key", F.when(F.col("boundary_id") == 1, "A").otherwise("KOTA_A")
    )
    known = regencies(spark, [(3, "Kabupaten A"), (4, "Kota A")])
    spots = points(spark, [(x / 7, y / 7) for x in range(60) for y in range(-2, 25)])
    index, grid = region_index(shapes, known)
    held = index.select(F.expr("aggregate(transform(candidates, c -> size(c.edges)), 0, (a, n) -> a + n)").alias("n"))
    assert held.agg(F.max("n")).first()[0] <= 8
    coarse = attach_regency(spots, *region_index(shapes, known, budget=32))
    assert set(attach_regency(spots, index, grid).collect()) == set(coarse.collect())


def test_lookup_by_name_key(spark):
    index, grid = region_index(boundaries(spark), regencies(spark, [(10, "KABUPATEN BOGOR"), (20, "KOTA BOGOR")]))
    raw = points(spark, [(1, 1), (3, 1), (2, 1), (50, 50)])
    assert [r["regency_id"] for r in attach_regency(raw, index, grid).orderBy("i").collect()] == [10, 20, 10, None]


def test_polygon_without_regency_keeps_the_point(spark):
    index, grid = region_index(boundaries(spark), regencies(spark, [(20, "KOTA BOGOR")]))
    got = attach_regency(points(spark, [(1, 1), (2, 1)]), index, grid).orderBy("i").collect()
    assert [r["regency_id"] for r in got] == [None, 20]


def test_ambiguous_reference_is_an_error(spark):
    with pytest.raises(DuplicateKey, match="BOGOR"):
        resolve_boundaries(boundaries(spark), regencies(spark, [(1, "KABUPATEN BOGOR"), (2, "BOGOR")]))


def test_bad_coordinates_are_set_apart(spark):
    raw = spark.createDataFrame([("a", "1.0", "1.0"), ("b", "abc", "1"), ("c", None, "1")], "i string, latitude string, longitude string")
    index, grid = region_index(boundaries(spark), regencies(spark, [(10, "BOGOR")]))
    assert [r["i"] for r in attach_regency(raw, index, grid).collect()] == ["a"]
    rejected = rejected_points(raw).collect()
    assert {(r["i"], r["latitude"], r["reject_reason"]) for r in rejected} == {
        ("b", "abc", "INVALID_COORDINATE"), ("c", None, "INVALID_COORDINATE"),
    }


def test_one_hot_cell_keeps_every_row(spark):
    """A third of all points in one spot, spread by salts, none lost or doubled."""
    spots = [(1.999, 1.0)] * 600 + [(0.1 * k % 4, 0.5) for k in range(1200)]
    got = located(spark, TWINS, spots, 4, strategy="shuffle", hot_rows=100, on_multiple="first")
    assert len(got) == len(spots)
    assert all(k == 1 for i, k in got if i < 600)


def test_a_filter_on_the_region_tests_the_edges_once(spark):
    index, grid = build_cell_index(frame(spark, TWINS), ["regency_id"])
    found = locate_points(points(spark, [(1, 1)]), index, grid, on_multiple="first").where("coalesce(regency_id, -1) <> 3")
    assert explained(found, "extended").split("== Physical Plan ==")[1].count("aggregate(") == 1
