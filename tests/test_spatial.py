"""The tile index of polygon layers against plain even-odd counting, and how its work is dealt out."""

import random

import pytest

from areadep.operators import spatial as sp, tiles

EDGE = "version string, poly long, sixfold int, eightfold int, ring int, x1 double, y1 double, x2 double, y2 double"


def ring_edges(poly, rings, version="v", six=1, eight=1):
    return [(version, poly, six, eight, k, *map(float, a), *map(float, b)) for k, ring in enumerate(rings) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]


def holds(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            t = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            if t == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and (t > 0) == (y2 > y1):
                odd = not odd
    return odd


@pytest.mark.parametrize("tile", [3.0, 4.0, 7.5, 1000.0])
def test_points_of_random_rings(spark, tile):
    """Corners, edges along tile borders, rings that cross themselves, holes, coordinates below zero."""
    rng = random.Random(int(tile * 10))
    point = lambda: (rng.randint(-24, 24), rng.choice([rng.randint(-24, 24), 4 * rng.randint(-6, 6)]))
    layer = {k: [[point() for _ in range(rng.randint(3, 9))] for _ in range(rng.randint(1, 3))] for k in range(25)}
    edges = [e for k, rings in layer.items() for e in ring_edges(k, rings)]
    points = {(float(x), float(y)) for x in range(-26, 27, 2) for y in range(-26, 27, 3)} | {(point()[0] + 0.5, point()[1] + 0.25) for _ in range(100)}
    got = {(r["poly"], r["x"], r["y"]) for r in tiles.held(spark.createDataFrame(list(points), "x double, y double"), spark.createDataFrame(edges, EDGE), tile).collect()}
    assert got == {(k, x, y) for k, rings in layer.items() for x, y in points if holds(rings, x, y)}


def test_a_polygon_is_known_far_from_its_edges(spark):
    """Blocks of corners: a wide polygon is listed by a few of them, and a point in its middle meets no edge."""
    wide = ring_edges(1, [[(-70_000_000, -900), (90_000_000, -900), (90_000_000, 900), (-70_000_000, 900)]])
    edges = spark.createDataFrame(wide, EDGE)
    runs = tiles.corner_runs(edges)
    assert 0 < tiles.blocks(runs).count() <= 4 * 2 * 16 * tiles.LEVELS
    covered = tiles.blocks(runs).selectExpr("row", "block << (4 * level) as a", "(block + 1) << (4 * level) as b").collect()
    for r in runs.collect():
        spans = sorted((c["a"], c["b"]) for c in covered if c["row"] == r["row"])
        assert spans[0][0] == r["a"] and spans[-1][1] == r["b"] and all(p[1] == q[0] for p, q in zip(spans, spans[1:], strict=False))
    points = spark.createDataFrame([(x, y) for x in (-70_000_001.0, -70_000_000.0, 0.0, 12_345_678.0, 90_000_000.0, 90_000_001.0) for y in (-901.0, -900.0, 0.0, 899.0)], "x double, y double")
    assert {(r["x"], r["y"]) for r in tiles.held(points, edges).collect()} == {
        (x, y) for x in (-70_000_000.0, 0.0, 12_345_678.0, 90_000_000.0) for y in (-900.0, 0.0, 899.0)}


def test_points_of_one_band_are_spread_over_tiles(spark):
    """A town in one band of y: its points and edges meet in as many groups as it has tiles, and a point meets the edges of one tile."""
    boxes = [ring_edges(k, [[(k * 100, 10), (k * 100 + 90, 10), (k * 100 + 90, 480), (k * 100, 480)]]) for k in range(400)]
    edges = spark.createDataFrame([e for b in boxes for e in b], EDGE)
    points = spark.createDataFrame([(k * 25.0 + 3, 7.0 * (k % 60)) for k in range(1600)], "x double, y double")
    groups = tiles.of_tile(points).groupBy("row", "col").count().collect()
    assert {r["row"] for r in groups} == {0} and len(groups) >= 80 and max(r["count"] for r in groups) <= 20
    assert max(r["count"] for r in tiles.tiled(edges).groupBy("row", "col").count().collect()) <= 4 * 6
    got = {(r["x"], r["y"]): r["poly"] for r in tiles.held(points, edges).collect()}
    assert got == {(x, y): int(x // 100) for x, y in ((k * 25.0 + 3, 7.0 * (k % 60)) for k in range(1600)) if x % 100 <= 90 and 10 <= y <= 480}
    plan = tiles.held(points, edges)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_missing_points_have_no_answer(spark):
    edges = spark.createDataFrame(ring_edges(1, [[(0, 0), (10, 0), (10, 10), (0, 10)]], "2022", 2, 3), EDGE)
    df = spark.createDataFrame([(1, "5", "5"), (2, "50", "5"), (3, None, "5"), (4, "x", "5"), (5, "5", "5")], "i long, GridReferenceEasting string, GridReferenceNorthing string")
    v = sp.RuralityVersion("2022", 0)
    got = {r["i"]: (r[f"{v.stem}_6fold"], r[f"{v.stem}_8fold"], r[f"{v.stem}_status"]) for r in sp.classify(df, edges, (v,)).collect()}
    assert got == {1: (2, 3, None), 2: (None, None, sp.OUTSIDE), 3: (None,) * 3, 4: (None,) * 3, 5: (2, 3, None)}
