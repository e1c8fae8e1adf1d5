"""Rings that meet themselves or each other: found by a sweep over each tile, and rebuilt.

Two edges of a polygon may share the end that joins them and nothing else. Where they do more, the polygon is broken:

* `crossing`: they cross inside both;
* `touch`: an end of one lies inside the other;
* `overlap`: they run along each other, or are the same edge twice;
* `vertex`: a ring comes to one of its vertices again.

Edges are listed under the tiles they touch, tiles with many of them are quartered until they hold few, and each tile is swept
from left to right with the edges that are open at the time. No pair is looked at that does not share a tile and a stretch of x.

A broken polygon is rebuilt from what it covers by even-odd counting, which is what placement uses. Its edges are cut where they
meet; pieces that lie on an even number of edges bound nothing and go; every other piece is turned so that the inside is on its
left, which the tile index tells; at each vertex a piece is followed by the next one to the right; and rings are the cycles of
that, named by pointer doubling. No polygon and no ring is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import ensure_checkpoint_dir, spread
from .checks import Checks
from .tiles import SHAPE, TILE, blocks, corner_runs, crossed, crossed_up, every_block, of_tile, tiled

MOST = 256          # edges of a polygon in a tile that is not quartered
DEEPEST = 10        # times a tile is quartered at most: edges through one point stay together in any tile
DIGITS = 6          # decimals of a point at which edges cross
POLYGON = ["version", "poly"]
ENDS = ["x1", "y1", "x2", "y2"]
KINDS = ["crossing", "touch", "overlap", "vertex"]


def kept(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def numbered(edges: DataFrame) -> DataFrame:
    """Edges of some length with a number each, written, so that the numbers stay. They are dealt out first: a source may have
    all its edges in a few files, or make them out of few rows, and what is done with them is done where they lie."""
    known = edges.dropna(subset=ENDS).where("x1 <> x2 or y1 <> y2")
    return kept(spread(known, "poly", *ENDS).withColumn("edge", F.monotonically_increasing_id()))


def merged(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join by merge. Spark takes the size of what was written for that guessed from the source, where a few bytes a row make a dozen edges,
    and would send all of a large layer through the driver as a small one."""
    return left.join(right.hint("merge"), on, how)


def in_tiles(edges: DataFrame, tile: float = TILE, most: int = MOST) -> DataFrame:
    """Edges under tiles (`level`, `row`, `col`) of which each holds at most `most` edges of a polygon, or has been quartered DEEPEST times."""
    key = [*POLYGON, "row", "col"]
    out, rest = None, edges
    for level in range(DEEPEST + 1):
        here = tiled(rest, tile / 2 ** level).withColumn("level", F.lit(level))
        if level:       # only where the tile above was full
            here = merged(here.withColumns({"_r": F.shiftright("row", 1), "_c": F.shiftright("col", 1)}),
                          full.select(*POLYGON, F.col("row").alias("_r"), F.col("col").alias("_c")), [*POLYGON, "_r", "_c"], "left_semi").drop("_r", "_c")
        if level == DEEPEST:
            return out.unionByName(here)
        here = kept(here)
        full = kept(here.groupBy(*key).count().where(F.col("count") > most).select(*key))
        if full.isEmpty():
            return here if out is None else out.unionByName(here)
        fits = merged(here, full, key, "left_anti")
        out = fits if out is None else out.unionByName(fits)
        rest = merged(edges, merged(here, full, key, "left_semi").select("edge").distinct(), "edge", "left_semi")
    return out


def _turn(a: tuple, x: float, y: float) -> float:
    return (a[3] - a[1]) * (y - a[2]) - (x - a[1]) * (a[4] - a[2])


def _inside(a: tuple, x: float, y: float) -> bool:
    """Whether a point on the line of an edge lies on it and is not one of its ends."""
    return (min(a[1], a[3]) <= x <= max(a[1], a[3]) and min(a[2], a[4]) <= y <= max(a[2], a[4])
            and (x, y) != (a[1], a[2]) and (x, y) != (a[3], a[4]))


def meeting(a: tuple, b: tuple) -> Iterator[tuple[str, int, float | None, float | None]]:
    """How two edges (number, x1, y1, x2, y2) meet beyond a shared end: (kind, edge, x, y), a point at which the edge is to be cut, if any."""
    b1, b2, a1, a2 = _turn(a, b[1], b[2]), _turn(a, b[3], b[4]), _turn(b, a[1], a[2]), _turn(b, a[3], a[4])
    if b1 == 0 and b2 == 0:
        k = 1 if a[1] != a[3] else 2
        if max(min(a[k], a[k + 2]), min(b[k], b[k + 2])) < min(max(a[k], a[k + 2]), max(b[k], b[k + 2])):
            for one, other in ((a, b), (b, a)):
                cuts = [p for p in ((other[1], other[2]), (other[3], other[4])) if _inside(one, *p)]
                yield from (("overlap", one[0], *p) for p in cuts or [(None, None)])
    elif b1 * b2 < 0 and a1 * a2 < 0:
        t = a1 / (a1 - a2)
        x, y = round(a[1] + (a[3] - a[1]) * t, DIGITS), round(a[2] + (a[4] - a[2]) * t, DIGITS)
        yield from (("crossing", e[0], x, y) for e in (a, b))
    else:
        for one, turns, other in ((a, (b1, b2), b), (b, (a1, a2), a)):
            for t, p in zip(turns, ((other[1], other[2]), (other[3], other[4])), strict=True):
                if t == 0 and _inside(one, *p):
                    yield "touch", one[0], *p


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passes over edges sorted by tile and left end; holds the edges that are open, never a tile as such."""
    names = ["version", "poly", "kind", "edge", "x", "y"]
    at, open_edges, found = None, [], []
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for tile, edge in zip(zip(*(c.to_pylist() for c in columns[:5]), strict=True), zip(*(c.to_pylist() for c in columns[5:10]), strict=True), strict=True):
            if tile != at:
                at, open_edges = tile, []
            left, low, high = min(edge[1], edge[3]), min(edge[2], edge[4]), max(edge[2], edge[4])
            open_edges = [o for o in open_edges if o[0] >= left]
            for _, down, up, other in open_edges:
                if down <= high and up >= low:
                    found += [(tile[0], tile[1], *m) for m in meeting(other, edge)]
            open_edges.append((max(edge[1], edge[3]), low, high, edge))
        kinds = [columns[0].type, columns[1].type, pa.string(), pa.int64(), pa.float64(), pa.float64()]
        rows = list(zip(*found, strict=True)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names=names)
        found = []


def meetings(edges: DataFrame, tile: float = TILE, most: int = MOST) -> DataFrame:
    """(version, poly, kind, edge, x, y): what is wrong with which numbered edge, and where it is to be cut, if anywhere."""
    key = [*POLYGON, "level", "row", "col"]
    listed = in_tiles(edges, tile, most).select(*key, "edge", *[F.col(c).cast("double").alias(c) for c in ENDS])
    swept = listed.repartition(*key).sortWithinPartitions(*key, F.least("x1", "x2"))
    kinds = {f.name: f.dataType.simpleString() for f in edges.schema.fields}
    found = swept.mapInArrow(_sweep, f"version {kinds['version']}, poly {kinds['poly']}, kind string, edge long, x double, y double").distinct()
    again = edges.groupBy(*POLYGON, "ring", "x1", "y1").count().where("count > 1").select(
        *POLYGON, F.lit("vertex").alias("kind"), F.lit(None).cast("long").alias("edge"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    return found.union(again)


def ring_faults(edges: DataFrame, tile: float = TILE, most: int = MOST) -> DataFrame:
    """(version, poly, kind): the polygons of a layer that are broken, and in which ways. A layer without edges has none."""
    return meetings(numbered(edges), tile, most).select(*POLYGON, "kind").distinct()


def cut(edges: DataFrame, splits: DataFrame) -> DataFrame:
    """Edges in pieces that meet at their ends only; pieces that lie on an even number of edges are gone."""
    along = (F.col("x") - F.col("x1")) * (F.col("x2") - F.col("x1")) + (F.col("y") - F.col("y1")) * (F.col("y2") - F.col("y1"))
    points = merged(splits.where("x is not null").select("edge", "x", "y").distinct(), edges, "edge").groupBy("edge").agg(
        F.array_sort(F.collect_list(F.struct(along.alias("t"), "x", "y"))).alias("points"))
    ends = lambda x, y: F.array(F.struct(F.lit(0.0).alias("t"), F.col(x).alias("x"), F.col(y).alias("y")))
    whole = merged(edges, points, "edge", "left").withColumn("points", F.concat(ends("x1", "y1"), F.coalesce("points", F.array()), ends("x2", "y2")))
    a, b = F.slice("points", F.lit(1), F.size("points") - 1), F.slice("points", F.lit(2), F.size("points") - 1)
    pieces = whole.select(*SHAPE, F.inline(F.arrays_zip(a.alias("a"), b.alias("b"))))
    first = F.struct("a.x", "a.y") < F.struct("b.x", "b.y")
    either = lambda c: [F.when(first, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(f"{c}1"), F.when(first, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(f"{c}2")]
    pieces = pieces.select(*SHAPE, *either("x"), *either("y")).where("x1 <> x2 or y1 <> y2")
    return pieces.groupBy(*SHAPE, *ENDS).count().where("count % 2 = 1").drop("count")


def turned(pieces: DataFrame, tile: float = TILE) -> DataFrame:
    """Pieces (`piece`, from the smaller to the larger end) turned so that the inside of their polygon is on their left.

    The parity on one side of a piece is that of a path from its tile's corner to its middle: it ends to the west
    of a piece, or above one that lies flat. If the middle lies on its tile's left side the path, which starts a little to the right, comes from the east."""
    at = of_tile(pieces.select(*POLYGON, F.col("piece").alias("own"), ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y")), tile)
    asked = at.select(*POLYGON, "row", "col").distinct().select(*POLYGON, "row", "col", every_block())
    corners = merged(asked, blocks(corner_runs(pieces, tile)).drop("sixfold", "eightfold"), [*POLYGON, "row", "level", "block"]).select(*POLYGON, "row", "col")
    items = tiled(pieces, tile).select(*POLYGON, "row", "col", "piece", *ENDS).unionByName(corners, allowMissingColumns=True)
    odd = F.when(F.col("piece").isNull(), F.lit(True)).when(F.col("piece") == F.col("own"), crossed_up(tile)).otherwise(crossed(tile))
    met = merged(at, items, [*POLYGON, "row", "col"]).where(odd)
    inside = met.groupBy(F.col("own").alias("piece")).agg((F.count(F.lit(1)) % 2 == 1).alias("odd"))
    middle = (F.col("x1") + F.col("x2")) / 2
    from_east = middle == F.floor(middle / tile) * tile
    along = F.coalesce("odd", F.lit(False)) == F.when(F.col("y1") == F.col("y2"), F.lit(True)).otherwise((F.col("y2") > F.col("y1")) != from_east)
    swap = lambda c, d: F.when(along, F.col(c)).otherwise(F.col(d)).alias(c)
    return merged(pieces, inside, "piece", "left").select(*SHAPE, "piece", swap("x1", "x2"), swap("y1", "y2"), swap("x2", "x1"), swap("y2", "y1"))


def followed(pieces: DataFrame) -> DataFrame:
    """(piece, next): at its end each piece is followed by the next one clockwise, which bounds the same inside."""
    end = lambda x, y, u, v, out: pieces.select(*POLYGON, "piece", F.col(x).alias("x"), F.col(y).alias("y"), F.lit(out).alias("out"),
                                                F.atan2(F.col(v) - F.col(y), F.col(u) - F.col(x)).alias("angle"))
    around = W.partitionBy(*POLYGON, "x", "y").orderBy("angle")
    every = end("x1", "y1", "x2", "y2", True).union(end("x2", "y2", "x1", "y1", False))
    last = F.last("piece").over(around.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return every.withColumn("next", F.coalesce(F.lag("piece").over(around), last)).where("not out").select("piece", "next")


def cycles(links: DataFrame) -> DataFrame:
    """(piece, ring): the smallest piece of each cycle of (piece, next), by doubling; as many rounds as the logarithm of the longest cycle."""
    held = kept(links.select("piece", "next", F.col("piece").alias("ring"), F.lit(True).alias("moved")))
    while not held.where("moved").isEmpty():
        ahead = held.select(F.col("piece").alias("next"), F.col("next").alias("after"), F.col("ring").alias("other"))
        held = kept(merged(held, ahead, "next").select("piece", F.col("after").alias("next"), F.least("ring", "other").alias("ring"), (F.col("other") < F.col("ring")).alias("moved")))
    return held.select("piece", "ring")


def repaired(edges: DataFrame, tile: float = TILE, most: int = MOST) -> DataFrame:
    """The layer with its broken polygons rebuilt: rings that bound what even-odd counting covers, the inside on their left, met at vertices only.

    Whole polygons stay as they are, with `rebuilt` false. A polygon that covers nothing goes. A hole that touches its shell in a point is one ring with it.
    """
    layer = numbered(edges)
    found = kept(meetings(layer, tile, most))
    broken = found.select(*POLYGON).distinct()
    pieces = cut(merged(layer, broken, POLYGON, "left_semi"), found)
    pieces = kept(turned(kept(pieces.withColumn("piece", F.monotonically_increasing_id())), tile))
    rings = merged(pieces, cycles(followed(pieces)), "piece")
    whole = merged(layer, broken, POLYGON, "left_anti")
    columns = [*SHAPE, "ring", *ENDS]
    return whole.select(*columns, F.lit(False).alias("rebuilt")).union(rings.select(*columns, F.lit(True).alias("rebuilt")))


def observed(edges: DataFrame, tile: float = TILE, prefix: str = "rurality.") -> DataFrame:
    """How many polygons of a layer are broken, in all and in each way, as observations: placement counts even-odd, which a broken ring does not disturb."""
    c = Checks(prefix).observe("broken_polygons", F.count_distinct("version", "poly"))
    for kind in KINDS:
        c.observe(f"broken_by_{kind}", F.count_if(F.col("kind") == kind))
    return c.run(ring_faults(edges, tile))
