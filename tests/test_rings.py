"""Broken rings: found in every way, and rebuilt to what they cover."""

import random

import pytest

from areadep.operators import rings as rg, spatial as sp, tiles

from test_spatial import EDGE, holds, ring_edges

SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10)]
SHAPES = {
    "whole": [SQUARE], "with_hole": [SQUARE, [(2, 2), (4, 2), (4, 4), (2, 4)]],
    "bow": [[(0, 0), (10, 10), (10, 0), (0, 10)]], "touch": [[(0, 0), (10, 0), (10, 10), (5, 0), (0, 10)]],
    "spike": [[(0, 0), (10, 0), (10, 10), (10, 20), (10, 10), (0, 10)]], "twice": [SQUARE, SQUARE], "eight": [[(0, 0), (5, 5), (10, 0), (10, 10), (5, 5), (0, 10)]],
    "hole_crosses": [SQUARE, [(5, 5), (15, 5), (15, 8), (5, 8)]], "hole_along": [SQUARE, [(2, 0), (4, 0), (4, 4), (2, 4)]], "repeated_point": [[(0, 0), (0, 0), (10, 0), (10, 10)]],
}
FOUND = {"whole": set(), "with_hole": set(), "bow": {"crossing"}, "touch": {"touch"}, "spike": {"overlap", "vertex"}, "twice": {"overlap"}, "eight": {"vertex"},
         "hole_crosses": {"crossing"}, "hole_along": {"overlap", "touch"}, "repeated_point": set()}
AREA = {"whole": 100, "with_hole": 96, "bow": 50, "touch": 50, "spike": 100, "twice": None, "eight": 50, "hole_crosses": 85 + 15, "hole_along": 92, "repeated_point": 50}


def layer(spark, shapes, at=lambda k: 0):
    rows = [e for k, rings in enumerate(shapes) for e in ring_edges(k, [[(x + at(k), y) for x, y in ring] for ring in rings])]
    return spark.createDataFrame(rows, EDGE)


def signed(rows):
    return {k: sum((r["x1"] + r["x2"]) / 2 * (r["y2"] - r["y1"]) for r in rows if r["poly"] == k) for k in {r["poly"] for r in rows}}


@pytest.mark.parametrize("tile,most", [(500.0, 256), (4.0, 2)])
def test_each_way_of_being_broken(spark, tile, most):
    got = {k: set() for k in range(len(SHAPES))}
    for r in rg.ring_faults(layer(spark, SHAPES.values(), lambda k: 100 * k), tile, most).collect():
        got[r["poly"]].add(r["kind"])
    assert dict(zip(SHAPES, got.values(), strict=True)) == FOUND


def test_what_is_rebuilt(spark):
    rows = rg.repaired(layer(spark, SHAPES.values(), lambda k: 100 * k), 4.0).collect()
    names = list(SHAPES)
    assert {names[r["poly"]] for r in rows if r["rebuilt"]} == {k for k, f in FOUND.items() if f and AREA[k]}
    area = signed(rows)
    assert {names[k]: round(abs(a), 6) for k, a in area.items() if k != names.index("with_hole")} == {k: a for k, a in AREA.items() if a and k != "with_hole"}
    assert len({r["ring"] for r in rows if r["poly"] == names.index("bow")}) == 2
    again = rg.ring_faults(spark.createDataFrame([r[:-1] for r in rows], EDGE), 4.0).collect()
    assert {r["kind"] for r in again} <= {"vertex"} and "bow" not in {names[r["poly"]] for r in again}


def test_random_rings_keep_what_they_cover(spark):
    rng = random.Random(9)
    shapes = [[[(rng.randint(-8, 8), rng.randint(-8, 8)) for _ in range(rng.randint(3, 8))] for _ in range(rng.randint(1, 2))] for _ in range(30)]
    edges = layer(spark, shapes)
    rows = rg.repaired(edges, 5.0, 4).collect()
    points = [(x + 0.37, y + 0.21) for x in range(-9, 9) for y in range(-9, 9)]
    got = {(r["poly"], r["x"], r["y"]) for r in tiles.held(spark.createDataFrame(points, "x double, y double"), spark.createDataFrame([r[:-1] for r in rows], EDGE), 5.0).collect()}
    assert got == {(k, x, y) for k, s in enumerate(shapes) for x, y in points if holds(s, x, y)}
    for k in {r["poly"] for r in rows if r["rebuilt"]}:
        ends = {}
        for r in rows:
            if r["poly"] == k:
                ends.setdefault(r["ring"], []).append(((r["x1"], r["y1"]), (r["x2"], r["y2"])))
        for ring in ends.values():      # closed: each vertex is come to as often as left
            assert sorted(a for a, _ in ring) == sorted(b for _, b in ring)
    assert all(a > 0 for k, a in signed([r for r in rows if r["rebuilt"]]).items())
    kinds = {r["kind"] for r in rg.ring_faults(spark.createDataFrame([r[:-1] for r in rows if r["rebuilt"]], EDGE), 5.0).collect()}
    assert "overlap" not in kinds


def test_full_tiles_are_quartered(spark):
    comb = [(x, y) for k in range(200) for x, y in ((k * 0.5, 0), (k * 0.5 + 0.25, 50))] + [(120, 0), (120, -1), (-1, -1)]
    edges = rg.numbered(layer(spark, [[comb]]))
    listed = rg.in_tiles(edges, 500.0, 16)
    assert listed.groupBy("level", "row", "col").count().agg({"count": "max"}).first()[0] <= 16 and listed.select("level").distinct().count() > 1
    assert listed.select("edge").distinct().count() == edges.count() and rg.ring_faults(layer(spark, [[comb]]), 500.0, 16).isEmpty()
    empty = spark.createDataFrame([], EDGE)
    assert rg.ring_faults(empty).isEmpty() and rg.repaired(empty).isEmpty()


def test_layer_of_few_bytes_is_dealt_out_and_not_broadcast(spark):
    """Many edges made of few rows in one file: Spark takes them for small, so their tasks and joins may not follow its guess."""
    made = spark.range(0, 3000, 1, 1).selectExpr("'v' AS version", "id AS poly", "1 AS sixfold", "1 AS eightfold", "0 AS ring", "inline(array("
        "named_struct('x1', 0d, 'y1', 0d, 'x2', 9d, 'y2', 9d), named_struct('x1', 9d, 'y1', 9d, 'x2', 9d, 'y2', 0d), "
        "named_struct('x1', 9d, 'y1', 0d, 'x2', 0d, 'y2', 9d), named_struct('x1', 0d, 'y1', 9d, 'x2', 0d, 'y2', 0d)))")
    layer = rg.numbered(made)
    assert layer.rdd.getNumPartitions() > 1 and layer.select("edge").distinct().count() == 12000
    plan = rg.repaired(made)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    plan = sp.crossing_rings(made).select("poly")
    assert "BroadcastHashJoin" not in plan._jdf.queryExecution().executedPlan().toString() and plan.count() == 3000
