"""A polygon layer indexed by square tiles, with what lies at each tile's corner carried in.

Whether a polygon holds a point is the parity of the edges that a path from far away crosses. The path used here runs along
the row of tile corners to the corner of the point's tile, up the tile's left side and across to the point. What the first part
crosses is worked out once for each corner, as a running parity over the columns of a row; the other two parts lie
inside the tile. So a point meets the edges of its own tile only, with one row more for each polygon that holds the corner,
and the key of the join is a tile, of which a busy town has many.

A polygon holds long rows of corners. They are not listed one by one but as blocks of 16, 256, ... corners, so that the index
grows with the outline and not with the area; a tile is looked up under the block of each size that contains it.

The corner of a tile is taken a little to the right of the grid point and a point a little above itself, by less than any
distance, the former by more than the latter. So no path meets an end of an edge, ties have one answer, and coordinates in whole
metres are answered exactly: only signs of products are used, never a quotient.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

TILE = 500.0
LEVELS = 6          # sizes of blocks of corners; the largest are 16^5 tiles wide
SHAPE = ["version", "poly", "sixfold", "eightfold"]


def turn(x: Column, y: Column) -> Column:
    """Above zero where (x, y) lies to the left of the edge, below where to the right, zero on its line."""
    return (F.col("x2") - F.col("x1")) * (y - F.col("y1")) - (x - F.col("x1")) * (F.col("y2") - F.col("y1"))


def left_of_edge(x: Column, y: Column) -> Column:
    """Whether the point a little to the right of (x, y), and less above it, is left of the edge."""
    t, up, along = turn(x, y), F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")
    return F.when(t != 0, t > 0).when(up != 0, up < 0).otherwise(along > 0)


def steps(low: Column, high: Column, tile: float) -> Column:
    return F.sequence(F.floor(low / tile), F.floor(high / tile))


def tiled(edges: DataFrame, tile: float = TILE) -> DataFrame:
    """Edges under every tile (`row`, `col`) they touch: the rows they cross, and in each row the columns between where they enter and leave it."""
    e = edges.withColumn("row", F.explode(steps(F.least("y1", "y2"), F.greatest("y1", "y2"), tile)))
    bottom, top = F.col("row") * tile, (F.col("row") + 1) * tile
    clip = lambda y: F.least(F.greatest(y, bottom), top)
    at = lambda y: F.when(F.col("y1") != F.col("y2"), F.col("x1") + (F.col("x2") - F.col("x1")) * ((y - F.col("y1")) / (F.col("y2") - F.col("y1"))))
    one, two = F.coalesce(at(clip(F.col("y1"))), "x1"), F.coalesce(at(clip(F.col("y2"))), "x2")
    # Quotients are rounded: a hair's breadth more, which can only list a tile too many.
    spare = F.lit(tile * 1e-6) + F.greatest(F.abs("x1"), F.abs("x2")) * 1e-12
    low = F.greatest(F.least(one, two) - spare, F.least("x1", "x2"))
    high = F.least(F.greatest(one, two) + spare, F.greatest("x1", "x2"))
    return e.withColumn("col", F.explode(steps(F.least(low, high), F.greatest(low, high), tile)))


def corner_runs(edges: DataFrame, tile: float = TILE) -> DataFrame:
    """(version, poly, sixfold, eightfold, row, a, b): columns a to b - 1 of whose corners in a row the polygon holds.

    Each edge that crosses a row of corners changes all corners from some column on. Columns are found by rounding and settled by the sign
    of `turn`. What changes a column twice is gone before the running parity, whose window is bounded by the columns of one row.
    """
    e = edges.withColumn("row", F.explode(steps(F.least("y1", "y2"), F.greatest("y1", "y2"), tile)))
    line = F.col("row") * tile
    e = e.where((F.col("y1") > line) != (F.col("y2") > line))
    near = F.floor((F.col("x1") + (F.col("x2") - F.col("x1")) * ((line - F.col("y1")) / (F.col("y2") - F.col("y1")))) / tile)
    # An edge that goes up has the corners beyond it on its right.
    beyond = lambda k: left_of_edge(k * tile, line) != (F.col("y2") > F.col("y1"))
    first = F.coalesce(*[F.when(beyond(near + d), near + d) for d in (-1, 0, 1)], near + 2)
    changed = e.groupBy(*SHAPE, "row", first.alias("a")).agg((F.count(F.lit(1)) % 2).alias("odd")).where("odd = 1")
    w = W.partitionBy(*SHAPE, "row").orderBy("a")
    runs = changed.select(*SHAPE, "row", "a", F.lead("a").over(w).alias("b"), (F.row_number().over(w) % 2).alias("inside"))
    return runs.where("inside = 1 and b is not null").drop("inside")


def blocks(runs: DataFrame) -> DataFrame:
    """Runs of corners as blocks (`row`, `level`, `block`) of 16^level of them: at most 30 of each level, whatever the length of the run."""
    wide = lambda k: 4 * k
    low = lambda k: -F.shiftright(-F.col("a"), wide(k))
    high = lambda k: F.shiftright(F.col("b"), wide(k))
    span = lambda k, p, q: F.when(p < q, F.transform(F.sequence(p, q - 1), lambda i: F.struct(F.lit(k).alias("level"), i.alias("block"))))
    parts = [span(LEVELS - 1, low(LEVELS - 1), high(LEVELS - 1))]
    for k in range(LEVELS - 1):
        above = low(k + 1) < high(k + 1)
        parts += [F.when(above, span(k, low(k), F.shiftleft(low(k + 1), 4))).otherwise(span(k, low(k), high(k))),
                  F.when(above, span(k, F.shiftleft(high(k + 1), 4), high(k)))]
    return runs.select(*SHAPE, "row", F.inline(F.flatten(F.array_compact(F.array(*parts)))))


def every_block() -> Column:
    """The block of each size that holds the corner in column `col`, as rows."""
    return F.inline(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("col", 4 * k).alias("block")) for k in range(LEVELS)]))


def crossed_up(tile: float = TILE) -> Column:
    """Whether the path from the corner of a tile up its side to the height of (x, y) crosses the edge."""
    side = F.col("col") * tile
    return ((F.col("x1") > side) != (F.col("x2") > side)) & (left_of_edge(side, F.col("row") * tile) != left_of_edge(side, F.col("y")))


def crossed(tile: float = TILE) -> Column:
    """Whether the path up the side and then across to (x, y) crosses the edge once."""
    x, y = F.col("x"), F.col("y")
    across = ((F.col("y1") > y) != (F.col("y2") > y)) & (left_of_edge(F.col("col") * tile, y) != (turn(x, y) > 0))
    return crossed_up(tile) != across


def of_tile(points: DataFrame, tile: float = TILE) -> DataFrame:
    return points.withColumns({"row": F.floor(F.col("y") / tile), "col": F.floor(F.col("x") / tile)})


def held(points: DataFrame, edges: DataFrame, tile: float = TILE) -> DataFrame:
    """(version, poly, sixfold, eightfold, x, y): the polygons that hold each of the distinct points (x, y); a boundary belongs to both sides.

    Even-odd counting, so rings need no repair and holes none of their own treatment. Edges whose coordinates are missing hold nothing.
    """
    edges = edges.dropna(subset=["x1", "y1", "x2", "y2"])
    at = of_tile(points, tile)
    asked = at.select("row", "col").distinct().select("row", "col", every_block())
    corners = asked.join(blocks(corner_runs(edges, tile)), ["row", "level", "block"]).select(*SHAPE, "row", "col")
    ends = ["x1", "y1", "x2", "y2"]
    items = tiled(edges, tile).select(*SHAPE, "row", "col", *ends).unionByName(corners, allowMissingColumns=True)

    x, y = F.col("x"), F.col("y")
    on_edge = x.between(F.least("x1", "x2"), F.greatest("x1", "x2")) & y.between(F.least("y1", "y2"), F.greatest("y1", "y2")) & (turn(x, y) == 0)
    corner = F.col("x1").isNull()
    odd, touches = F.coalesce(crossed(tile), F.lit(False)) | corner, F.coalesce(on_edge, F.lit(False))
    met = at.join(items, ["row", "col"]).select(*SHAPE, "x", "y", odd.alias("odd"), touches.alias("touches")).where("odd or touches")
    found = met.groupBy(*SHAPE, "x", "y").agg(F.count_if("odd").alias("n"), F.max("touches").alias("touches"))
    return found.where((F.col("n") % 2 == 1) | F.col("touches")).select(*SHAPE, "x", "y")
