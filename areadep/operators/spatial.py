"""Placing points in polygons, and what a polygon layer has to keep to.

A polygon layer is a table of edges: version, poly, sixfold, eightfold, ring, x1, y1, x2, y2. Points are placed
by the tile index of `tiles`: a point meets the edges of its own tile, and even-odd counting needs no repair of rings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import Lives, is_po_box
from ..functions.values import missing_point
from ..registry import BNG_EPSG, EIGHT_TO_SIX, AgreementGate, RuralityVersion
from ..session import spread
from .checks import Checks, static_check, union_checks
from .skew import lookup_join
from .tiles import TILE, held

BAND = 500.0      # metres
CELL = 10_000.0

OUTSIDE, AMBIGUOUS, PO_BOX = "outside_polygons", "ambiguous_polygons", "po_box"


def banded(edges: DataFrame, height: float = BAND) -> DataFrame:
    """Edges under every band they touch."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    bands = F.sequence(F.floor(low / height), F.floor(high / height))
    return edges.withColumn("band", F.explode(bands))


def classes(points: DataFrame, edges: DataFrame, versions: list[str], tile: float = TILE) -> DataFrame:
    """One row per distinct point (x, y) that some polygon holds, with per version the least 6-fold and the least and greatest 8-fold
    class (`six_k`, `low_k`, `high_k` for the k-th version): all versions in one pass, none of them multiplying the points."""
    found = held(points, edges, tile)
    of = lambda k, f, c: f(F.when(F.col("version") == versions[k], F.col(c)))
    return found.groupBy("x", "y").agg(*[of(k, f, c).alias(f"{n}_{k}") for k in range(len(versions))
                                         for n, f, c in (("six", F.min, "sixfold"), ("low", F.min, "eightfold"), ("high", F.max, "eightfold"))])


def answer(k: int) -> tuple[Column, Column, Column]:
    """6-fold and 8-fold code and status of a placed point: one class gives the codes, none or several give a status."""
    low, high = F.col(f"low_{k}"), F.col(f"high_{k}")
    one = low == high
    status = F.when(low.isNull(), F.lit(OUTSIDE)).when(~one, F.lit(AMBIGUOUS))
    return F.when(one, F.col(f"six_{k}")).cast("tinyint"), F.when(one, low).cast("tinyint"), status


def distinct_points(df: DataFrame, x: Column, y: Column) -> DataFrame:
    points = df.select(x.try_cast("double").alias("x"), y.try_cast("double").alias("y"))
    return points.where("x is not null and y is not null").distinct()


def placed(points: DataFrame, edges: DataFrame, versions: list[str], tile: float = TILE) -> DataFrame:
    """Distinct points (x, y) with, per version, the class of the polygons that hold them; a point on a
    boundary is held by both sides. One class gives the codes, none or several give a status."""
    p = distinct_points(points, F.col("x"), F.col("y"))
    wide = p.join(classes(p, edges, versions, tile), ["x", "y"], "left")
    rows = []
    for k, v in enumerate(versions):
        six, eight, status = answer(k)
        rows.append(F.struct(F.lit(v).alias("version"), six.alias("sixfold"), eight.alias("eightfold"), status.alias("status")))
    return wide.select("x", "y", F.inline(F.array(*rows))).select("version", "x", "y", "sixfold", "eightfold", "status")


def classify(index: DataFrame, edges: DataFrame, versions: tuple[RuralityVersion, ...], easting="GridReferenceEasting",
             northing="GridReferenceNorthing", tile: float = TILE) -> DataFrame:
    """Every version's two codes and status for every row, each distinct point placed once. A row without a point has none of them."""
    asked = index.withColumns({"_x": F.col(easting).try_cast("double"), "_y": F.col(northing).try_cast("double")})
    found = classes(distinct_points(index, F.col(easting), F.col(northing)), edges, [v.key for v in versions], tile)
    joined = lookup_join(asked, found.withColumnsRenamed({"x": "_x", "y": "_y"}), ["_x", "_y"])
    there = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    columns = []
    for k, v in enumerate(versions):
        columns += [c.alias(f"{v.stem}_{n}") for c, n in zip(answer(k)[:2], ("6fold", "8fold"), strict=True)]
        columns.append(F.when(there, answer(k)[2]).alias(f"{v.stem}_status"))
    return joined.select(*index.columns, *columns)


def withhold_po_boxes(df: DataFrame, versions: tuple[RuralityVersion, ...], lives: Lives = Lives()) -> DataFrame:
    """A post-office box gets no class in any version, and says so."""
    box = is_po_box(lives.role, lives.link)
    changes = {}
    for v in versions:
        for fold in ("6fold", "8fold"):
            changes[f"{v.stem}_{fold}"] = F.when(~box, F.col(f"{v.stem}_{fold}"))
        changes[f"{v.stem}_status"] = F.when(box, F.lit(PO_BOX)).otherwise(F.col(f"{v.stem}_status"))
    return df.withColumns(changes)


# ---- gates ----

def agreement(classified: DataFrame, gate: AgreementGate = AgreementGate(), lives: Lives = Lives(),
              accuracy: str = "GridLinkPositionalAccuracy") -> DataFrame:
    """Per cohort: lives, agreement of both codes with the published ones, and whether it is gated and
    passes. Cohorts overlap; all are counted in one pass, boxes included and outside points as wrong."""
    stem = RuralityVersion(gate.version, 0).stem
    text = lambda c: F.col(c).cast("string")
    right = F.coalesce((text(f"{stem}_6fold") == text(gate.sixfold)) & (text(f"{stem}_8fold") == text(gate.eightfold)), F.lit(False))
    current = F.coalesce(F.col(lives.current), F.lit(False))
    small = F.coalesce(F.col(lives.role) == "small_user", F.lit(False))
    blank = F.trim(F.coalesce(F.col(accuracy), F.lit(""))) == ""
    cohorts = {"current_small_user": current & small, "deleted_small_user": ~current & small, "current_large_user": current & ~small,
               "deleted_large_user": ~current & ~small, "po_box": is_po_box(lives.role, lives.link),
               "split_part": F.coalesce(F.col(lives.key) != F.col(lives.base), F.lit(False)), "deleted_blank_positional_accuracy": ~current & blank}
    counts = classified.agg(*[F.count_if(m).alias(f"n_{c}") for c, m in cohorts.items()],
                            *[F.count_if(m & right).alias(f"r_{c}") for c, m in cohorts.items()])
    rows = [F.struct(F.lit(c).alias("cohort"), F.col(f"n_{c}").alias("lives"), F.col(f"r_{c}").alias("agreeing"),
                     F.lit(gate.principal if c == "current_small_user" else gate.other).alias("needed")) for c in cohorts]
    out = counts.select(F.inline(F.array(*rows)))
    rate = F.when(F.col("lives") > 0, F.col("agreeing") / F.col("lives"))
    principal = F.col("cohort") == "current_small_user"
    return out.withColumns({"agreement": rate, "gated": principal | (F.col("lives") > gate.min_cohort)}).withColumn(
        "passed", F.when(F.col("gated"), F.coalesce(rate >= F.col("needed"), F.lit(False))).otherwise(F.lit(True)))


def points_present(index: DataFrame, easting="GridReferenceEasting", northing="GridReferenceNorthing") -> DataFrame:
    return Checks("rurality.").zero("points_present", missing_point(easting, northing)).run(index)


def nests():
    """Whether an 8-fold class lies in its 6-fold class."""
    six = F.create_map(*[F.lit(x) for kv in EIGHT_TO_SIX.items() for x in kv])[F.col("eightfold").cast("int")]
    return F.coalesce(six == F.col("sixfold").cast("int"), F.lit(False))


def layer_checks(polygons: DataFrame, version: RuralityVersion, columns: list[str], epsg: int | None) -> DataFrame:
    """A layer's contract, from its polygon table (version, poly, sixfold, eightfold, n_edges)."""
    label = f"rurality.{version.key}"
    spark = polygons.sparkSession
    missing = [c for c in (version.sixfold, version.eightfold) if c not in columns]
    rows = polygons.where(F.col("version") == version.key)
    classes = F.concat_ws(",", F.array_sort(F.collect_set(F.col("eightfold").cast("int"))).cast("array<string>"))
    c = (Checks(f"{label}.").equal("polygons", F.count(F.lit(1)), version.polygons).equal("eightfold_values", classes, ",".join(map(str, range(1, 9))))
         .zero("folds_nest", ~nests()).zero("geometry_present", F.coalesce(F.col("n_edges"), F.lit(0)) == 0))
    return union_checks(static_check(spark, f"{label}.columns_present", missing, []),
                        static_check(spark, f"{label}.reference_system", epsg, BNG_EPSG), c.run(rows))


def polygon_table(edges: DataFrame) -> DataFrame:
    return edges.groupBy("version", "poly", "sixfold", "eightfold").agg(F.count("x1").alias("n_edges"))


def polygon_area(edges: DataFrame) -> DataFrame:
    """Area of each polygon from its edges, holes running the other way."""
    piece = (F.col("x1") + F.col("x2")) / 2 * (F.col("y2") - F.col("y1"))
    return edges.groupBy("version", "poly").agg(F.abs(F.sum(piece)).alias("area"))


def banded_area(edges: DataFrame, height: float = BAND) -> DataFrame:
    """The same area from the pieces of the edges inside each band."""
    lo, hi = F.col("band") * height, (F.col("band") + 1) * height
    clip = lambda y: F.least(F.greatest(y, lo), hi)
    ya, yb = clip(F.col("y1")), clip(F.col("y2"))
    x_at = lambda y: F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1"))
    piece = F.when(F.col("y1") != F.col("y2"), (x_at(ya) + x_at(yb)) / 2 * (yb - ya)).otherwise(F.lit(0.0))
    return banded(edges, height).groupBy("version", "poly").agg(F.abs(F.sum(piece)).alias("banded_area"))


def area_checks(edges: DataFrame, height: float = BAND) -> DataFrame:
    """Banding a layer loses no area: a square metre, or a part in a billion."""
    both = polygon_area(edges).join(banded_area(edges, height), ["version", "poly"], "full_outer")
    lost = F.abs(F.coalesce("area", F.lit(0.0)) - F.coalesce("banded_area", F.lit(0.0))) > F.greatest(F.lit(1.0), F.col("area") * 1e-9)
    return Checks("rurality.").zero("area_conserved", lost).run(both)


def crossing_rings(edges: DataFrame, cell: float = CELL) -> DataFrame:
    """Rings with two edges that properly cross: counted, never repaired. Edges meet by shared grid cell."""
    span = lambda a, b: F.sequence(F.floor(F.least(a, b) / cell), F.floor(F.greatest(a, b) / cell))
    # Dealt out and joined by merge: made of a few bytes a row, a large layer looks small enough to broadcast.
    e = spread(edges, "poly", "x1", "y1", "x2", "y2").withColumns({"_cx": F.explode(span("x1", "x2"))}).withColumn("_cy", F.explode(span("y1", "y2")))
    names = ["x1", "y1", "x2", "y2"]
    keys = ["version", "poly", "ring", "_cx", "_cy"]
    a = e.select(*keys, *[F.col(n).alias("a" + n) for n in names])
    b = e.select(*keys, *[F.col(n).alias("b" + n) for n in names])
    turn = lambda px, py, qx, qy, rx, ry: F.signum((F.col(qx) - F.col(px)) * (F.col(ry) - F.col(py)) - (F.col(qy) - F.col(py)) * (F.col(rx) - F.col(px)))
    s = [turn("ax1", "ay1", "ax2", "ay2", "bx1", "by1"), turn("ax1", "ay1", "ax2", "ay2", "bx2", "by2"),
         turn("bx1", "by1", "bx2", "by2", "ax1", "ay1"), turn("bx1", "by1", "bx2", "by2", "ax2", "ay2")]
    order = F.struct("ax1", "ay1", "ax2", "ay2") < F.struct("bx1", "by1", "bx2", "by2")
    same_cell = reduce(lambda p, q: p & q, [a[k] == b[k] for k in keys])
    cross = (s[0] * s[1] < 0) & (s[2] * s[3] < 0)
    return a.join(b.hint("merge"), same_cell & order & cross).select(a["version"], a["poly"], a["ring"]).distinct()


def box_edges(boxes: DataFrame, keep: list[str]) -> DataFrame:
    """Edges of axis-parallel boxes (x0, y0, x1, y1), as a layer."""
    corner = lambda a, b, c, d: F.struct(F.col(a).cast("double").alias("x1"), F.col(b).cast("double").alias("y1"),
                                         F.col(c).cast("double").alias("x2"), F.col(d).cast("double").alias("y2"))
    sides = F.array(corner("bx0", "by0", "bx0", "by1"), corner("bx0", "by1", "bx1", "by1"),
                    corner("bx1", "by1", "bx1", "by0"), corner("bx1", "by0", "bx0", "by0"))
    return boxes.select(*keep, F.lit(0).alias("ring"), F.inline(sides))
