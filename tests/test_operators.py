"""Keys, dates, intervals, bands, placement, digest and the skew-safe join, on small tables."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from areadep.functions import keys as k
from areadep.functions.values import rendered
from areadep.operators import bands as b
from areadep.operators import digest as g
from areadep.operators import spatial as sp
from areadep.operators.checks import Checks, ChecksFailed, require, summary, unique_key, values_within
from areadep.operators.ordered import falls, running_total
from areadep.operators.profile import overlapping_lives, strict_overlaps, touching_pairs, touching_transitions
from areadep.operators.skew import heavy_keys, key_counts, lookup_join
from areadep.operators.snapshot import changed_fields, column_changes, compare_with_previous, snapshot_diff
from areadep.operators import timeline
from areadep.operators.timeline import as_of_join, stretches
from areadep.operators.weighted import population_bands
from areadep.registry import EDITIONS, REGISTRY, RuralityVersion

D = dt.date


# ---- keys and dates ----

def test_key_shapes(spark):
    good = [("G1 1AAA", "Y", "G11AAA", "G11AA"), ("AB1 0LTA", "Y", "AB10LTA", "AB10LT"), ("ab12 3gqa", "Y", "AB123GQA", "AB123GQ"), ("AB12 3GQ", "N", "AB123GQ", "AB123GQ")]
    bad = [("G1\t1AA", "N"), ("G1  1AA", "N"), ("G1 1AA", "Y"), ("G1 1AAD", "Y"), ("G1 1AAA", "N"), ("G1 1AA", "X"), (None, "N")]
    df = spark.createDataFrame([(p, s) for p, s, *_ in good] + bad, "Postcode string, SplitIndicator string")
    rows = k.with_keys(df, "small_user").collect()
    assert [(r["pc_norm"], r["pc_base"], r["key_ok"]) for r in rows[:4]] == [(n, base, True) for _, _, n, base in good]
    assert not any(r["key_ok"] for r in rows[4:])
    assert not k.with_keys(df, "lookup").first()["key_ok"]
    with pytest.raises(ValueError):
        k.with_keys(df, "other")


def test_dates(spark):
    rows = [("1/6/1996 00:00:00", "", True), ("01/01/1980", "02/01/1980", True), ("02/01/1980", "01/01/1980", False), ("31/2/2020", "", False),
            ("", "", False), ("1/1/2000 12:00:00", "", False), ("1/1/2000", "31/2/2020", False)]
    df = spark.createDataFrame(rows, "DateOfIntroduction string, DateOfDeletion string, want boolean")
    out = k.with_dates(df).collect()
    assert [r["dates_ok"] for r in out] == [r["want"] for r in out]
    assert out[0]["introduced_on"] == D(1996, 6, 1) and out[0]["is_current"] and not out[1]["is_current"]


def test_links(spark):
    from areadep.operators.profile import classified_links
    links = spark.createDataFrame([("NO LINKP",), ("NO LINK",), ("AB1 0NX",), ("ZZ1 1ZZ",)], "link string")
    keys = spark.createDataFrame([("AB10NX",)], "pc_norm string")
    got = {r["link"]: r["link_class"] for r in classified_links(links, keys, "link").collect()}
    assert got == {"NO LINKP": "NO LINKP", "NO LINK": "NO LINK", "AB1 0NX": "linked", "ZZ1 1ZZ": "unresolved"}


# ---- intervals ----

LIFE = "pc_norm string, spd_user_type string, introduced_on date, deleted_on date"


def test_same_day_lives_touch_and_do_not_overlap(spark):
    rows = [("G11AA", "small_user", D(2020, 1, 1), D(2020, 2, 1)), ("G11AA", "large_user", D(2020, 2, 1), None), ("G11AA", "small_user", D(2020, 2, 1), D(2020, 2, 1))]
    df = spark.createDataFrame(rows, LIFE)
    assert strict_overlaps(df).count() == 0 and touching_pairs(df).count() == 3
    assert {r["transition"]: r["pairs"] for r in touching_transitions(df).collect()} == {"small_user:small_user": 1, "small_user:large_user": 2}


def test_nested_lives_overlap(spark):
    rows = [("G11AA", "small_user", D(2000, 1, 1), D(2010, 1, 1)), ("G11AA", "small_user", D(2001, 1, 1), D(2002, 1, 1)), ("G11AA", "small_user", D(2003, 1, 1), None),
            ("G11AB", "small_user", D(2003, 1, 1), D(2004, 1, 1)), ("G11AB", "small_user", D(2004, 1, 1), None)]
    df = spark.createDataFrame(rows, LIFE)
    assert {r["pc_norm"]: r["overlaps"] for r in strict_overlaps(df).collect()} == {"G11AA": 2}
    assert overlapping_lives(df).count() == 2


def test_stretches_against_every_day(spark):
    """Random directories, every day asked, against a direct search."""
    rng = random.Random(7)
    rows, start = [], D(2000, 1, 1)
    for key in ("K1", "K2", "K3", "K4"):
        for suffix in rng.sample(["", "A", "B", "C"], rng.randint(1, 4)):
            at = rng.randint(0, 20)
            for _ in range(rng.randint(1, 4)):
                length = rng.choice([0, 1, 3, 9])
                last = rng.random() < 0.2
                rows.append((key, key + suffix, start + dt.timedelta(at), None if last else start + dt.timedelta(at + length)))
                if last:
                    break
                at += length + rng.choice([0, 1, 5]) + (1 if length == 0 else 0)
    lives = spark.createDataFrame(rows, "base string, pc string, s date, e date")
    segs = stretches(lives, "base", k.part("pc", "base"), "s", "e", [F.col("pc"), F.col("s")])
    days = [(key, start + dt.timedelta(d)) for key in ("K1", "K2", "K3", "K4", "K5") for d in range(-3, 60)] + [("K1", None), (None, start)]
    asked = spark.createDataFrame(days, "base string, d date")
    for small in (True, False):
        got = {(r["base"], r["d"]): r for r in as_of_join(asked, segs, "base", "d", small=small).collect()}
        assert len(got) == len(days)
        for key, day in days:
            mine = [r for r in rows if r[0] == key]
            r = got[(key, day)]
            if day is None or not mine:
                assert all(r[f"part{i}"] is None for i in range(4))
                continue
            found = [x for x in mine if x[2] <= day and (x[3] is None or x[3] > day)]
            previous = False
            if not found:
                ended = [x for x in mine if x[3] is not None and x[2] < x[3] <= day]
                found = [x for x in ended if x[3] == max(y[3] for y in ended)]
                previous = bool(found)
            assert sorted((x[1], x[2]) for x in found) == sorted((r[f"part{i}"]["pc"], r[f"part{i}"]["s"]) for i in range(4) if r[f"part{i}"])
            assert r["from_previous"] == previous
            assert r["first_start"] == min(x[2] for x in mine)
            assert r["previous_end"] == max((x[3] for x in mine if x[3] is not None and x[3] <= day), default=None)
            assert r["next_start"] == min((x[2] for x in mine if x[2] > day), default=None)


def test_as_of_join_answers_rows_where_they_meet_the_stretches(spark, monkeypatch):
    """Most rows in one pass beside the stretches: the same answers as by broadcast, and only rows of heavy keys and those without a key
    are counted by day and joined back."""
    d0 = dt.date(2020, 1, 1)
    lives = [(f"K{i}", f"K{i}", d0 + dt.timedelta(3 * j + i % 2), d0 + dt.timedelta(3 * j + 2)) for i in range(0, 3000, 2) for j in range(2)]
    segs = stretches(spark.createDataFrame(lives, "base string, pc string, s date, e date"), "base", k.part("pc", "base"), "s", "e", [F.col("pc"), F.col("s")])
    i = F.col("id")
    day = F.when(i % 13 != 0, F.date_add(F.lit(d0), (i % 9).cast("int") - 1))
    key = F.when(i % 10 == 0, F.lit("K8")).when(i % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("K"), (i % 3000).cast("string")))
    asked = spark.range(12_000).select("id", key.alias("base"), day.alias("d"), (i % 7).alias("_at"))
    counted = []
    monkeypatch.setattr(timeline, "key_counts", lambda df, keys: counted.append((tuple(keys), df.count())) or key_counts(df, keys))
    out = as_of_join(asked, segs, "base", "d")
    wanted = as_of_join(asked, segs, "base", "d", small=True)
    assert out.columns == wanted.columns and out.count() == 12_000
    assert out.exceptAll(wanted).count() == 0 and out.where("part0 is not null").count() > 1000
    assert {keys: n for keys, n in counted} == {("base",): 12_000, ("base", "d"): asked.where("base = 'K8' or base is null").count()}


# ---- joins of unequal keys ----

def test_lookup_join_spreads_heavy_keys(spark):
    left = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.range(0, 20_000, 5).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([("hot", -1), (None, -2)], "k string, v long"))
    heavy = heavy_keys(key_counts(left, ["k"]), ["k"])
    assert {r["k"] for r in heavy.collect()} == {"hot", None}
    out = lookup_join(left, right, ["k"])
    assert out.count() == 20_000 and out.columns == ["id", "k", "v"]
    r = out.agg(F.count_if(F.col("v") == -1).alias("hot"), F.count_if(F.col("v") == -2).alias("null"), F.count_if(F.col("v").isNull()).alias("none")).first()
    assert (r["hot"], r["null"]) == (10_000, 3_333)
    expected_none = sum(1 for i in range(20_000) if i % 2 and i % 3 and i % 5)
    assert r["none"] == expected_none
    assert lookup_join(left, right, ["k"], small=True).exceptAll(out).count() == 0
    # However many tasks the heavy key is spread over, no task holds all of it.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = lookup_join(left, right, ["k"]).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 10_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# ---- bands ----

BANDS = [(range(1, 11), [10] * 10, 10, list(range(1, 11))), (range(1, 11), [10] * 10, 5, [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]), ([1, 2.5, 2.5, 4], [10, 20, 20, 50], 10, [1, 3, 3, 8]),
         ([1, 2, 3], [0, 50, 50], 5, [1, 2, 4]), ([1, 2, 3, 4], [40, 0, 30, 30], 5, [1, 2, 3, 5])]


@pytest.mark.parametrize("ranks,people,width,want", BANDS)
def test_population_bands(spark, ranks, people, width, want):
    rows = [(i, float(r), p) for i, (r, p) in enumerate(zip(ranks, people))]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "i int, rank double, people long")
    got = {r["i"]: r["band"] for r in population_bands(df, [], "rank", "people", {"band": width}).collect()}
    assert [got[i] for i in sorted(got)] == want


@pytest.mark.parametrize("people", [[0, 0, 0], [10, -1, 5], [10, None, 5]])
def test_population_bands_refuse(spark, people):
    df = spark.createDataFrame([(float(i), p) for i, p in enumerate(people)], "rank double, people long")
    with pytest.raises(Exception):
        population_bands(df, [], "rank", "people", {"band": 5}).collect()


def test_running_total_and_falls(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), i, rng.randint(0, 9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, o int, v int")
    got = {(r["g"], r["o"]): r["t"] for r in running_total(df, ["g"], "o", "v", "t").collect()}
    sums = {"a": 0, "b": 0}
    drops, last = {"a": 0, "b": 0}, {}
    for gname, o, v in rows:
        sums[gname] += v
        assert got[(gname, o)] == sums[gname]
        drops[gname] += gname in last and v < last[gname]
        last[gname] = v
    assert {r["g"]: r["falls"] for r in falls(df, ["g"], "o", "v").collect()} == drops


def cube(spark, fault=None):
    ed = EDITIONS[0].__class__(key="t", vintage=2011, rows=4, first_year=2000, last_year=2001, domains=("income", "housing"), cube_year=2016, half_ranks="rounded_up",
                               status_domains=("housing",))
    zones = spark.createDataFrame([(f"Z{i}", i, q, d, v, inc, float(i)) for i, q, d, v, inc in
                                   ((1, 1, 1, 1, 1.0), (2, 2, 3, 6, 2.5), (3, 3, 6, 11, 2.5), (4, 5, 10, 20, 4.0))],
                                  "dz_code string, rank int, uw_scotland_quintile int, uw_scotland_decile int, uw_scotland_vigintile int, income_domain_rank double, housing_domain_rank double")
    long = []
    for r in zones.collect():
        for name, rank in (("SIMD", r["rank"]), ("Income", r["income_domain_rank"] + (0.5 if r["income_domain_rank"] % 1 else 0)), ("Housing", r["housing_domain_rank"] - (1 if r["dz_code"] == "Z4" else 0))):
            values = {"Rank": float(rank), "Quintile": r["uw_scotland_quintile"], "Decile": r["uw_scotland_decile"], "Vigintile": r["uw_scotland_vigintile"]}
            long += [(r["dz_code"], r["dz_code"], "2011 Data Zone", 2016, m, m, float(v), name) for m, v in values.items()]
    long = [f for f in (fault(x) for x in long) if f] if fault else long
    df = spark.createDataFrame(long, "FeatureCode string, FeatureName string, FeatureType string, DateCode int, Measurement string, Units string, Value double, `SIMD Domain` string")
    pinned = spark.createDataFrame([("housing", "Z4", 4.0, 3.0)], "domain string, dz_code string, shapefile_rank double, published_rank double")
    return ed, zones, df, pinned


def failed(report):
    return {r["name"].split("bands.")[-1] for r in report.where("not passed").collect()}


def test_band_cube_is_admitted(spark):
    ed, zones, df, pinned = cube(spark)
    out, report = b.admit_bands(zones, df, ed, pinned)
    assert failed(report) == set() and failed(b.cube_checks(df, ed)) == set()
    rows = {r["dz_code"]: r for r in out.collect()}
    assert rows["Z2"]["income_domain_decile"] == 3 and rows["Z4"]["housing_domain_rank_source_status"] == "rank_sources_disagree"
    assert rows["Z1"]["housing_domain_rank_source_status"] is None


@pytest.mark.parametrize("name,fault", [
    ("zones", lambda x: None if x[0] == "Z2" and x[7] == "Income" else x), ("income rank", lambda x: x[:6] + (9.0,) + x[7:] if x[0] == "Z1" and x[7] == "Income" and x[4] == "Rank" else x),
    ("overall rank", lambda x: x[:6] + (9.0,) + x[7:] if x[0] == "Z1" and x[7] == "SIMD" and x[4] == "Rank" else x),
    ("overall band", lambda x: x[:6] + (2.0,) + x[7:] if x[0] == "Z1" and x[7] == "SIMD" and x[4] == "Quintile" else x),
    ("range", lambda x: x[:6] + (6.0,) + x[7:] if x[0] == "Z4" and x[7] == "Income" and x[4] == "Quintile" else x),
    ("falls", lambda x: x[:6] + (1.0,) + x[7:] if x[0] == "Z4" and x[7] == "Income" and x[4] == "Quintile" else x)])
def test_band_cube_faults(spark, name, fault):
    ed, zones, df, pinned = cube(spark, fault)
    assert failed(b.admit_bands(zones, df, ed, pinned)[1])


@pytest.mark.parametrize("fault", [lambda x: x[:7] + ("Shoes",) if x[7] == "Income" else x, lambda x: x[:3] + (2012,) + x[4:] if x[0] == "Z1" else x,
                                   lambda x: x[:2] + ("2001 Data Zone",) + x[3:] if x[0] == "Z1" else x, lambda x: x[:4] + ("Mean",) + x[5:] if x[4] == "Decile" else x])
def test_band_cube_contract_faults(spark, fault):
    ed, _, df, _ = cube(spark, fault)
    assert failed(b.cube_checks(df, ed))


@pytest.mark.parametrize("zone", ["Z1", "Z2", "Z3", "Z4"])
def test_a_zone_without_a_published_rank_is_not_admitted(spark, zone):
    ed, zones, df, pinned = cube(spark, lambda x: None if x[0] == zone and x[7] == "Income" and x[4] == "Rank" else x)
    assert "rank.present" in failed(b.admit_bands(zones, df, ed, pinned)[1])


def test_a_null_code_is_not_declared(spark):
    ed, _, df, _ = cube(spark, lambda x: x[:2] + (None,) + x[3:] if x[0] == "Z1" else x)
    assert "feature_type" in failed(b.cube_checks(df, ed))


# ---- placing points ----

NEST = {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 5, 7: 6, 8: 6}


def squares(spark):
    rows = [("2022", i, NEST[i + 1], i + 1, i * 20000, 0, (i + 1) * 20000, 20000) for i in range(8)]
    boxes = spark.createDataFrame(rows, "version string, poly long, sixfold int, eightfold int, bx0 long, by0 long, bx1 long, by1 long")
    return sp.box_edges(boxes, ["version", "poly", "sixfold", "eightfold"])


def test_points_in_squares(spark):
    want = {(5000.0, 5000.0): (1, None), (45000.0, 5000.0): (3, None), (155000.0, 5000.0): (8, None), (5000.0, 20000.5): (None, "outside_polygons"),
            (5000.0, -50000.0): (None, "outside_polygons"), (20000.0, 5000.0): (None, "ambiguous_polygons"), (80000.0, 5000.0): (None, "ambiguous_polygons"),
            (10000.0, 5000.0): (1, None), (5000.0, 0.0): (1, None), (0.0, 0.0): (1, None), (5000.0, 20000.0): (1, None)}
    points = spark.createDataFrame(list(want), "x double, y double")
    for height in (500.0, 10_000.0, 333.0):
        got = {(r["x"], r["y"]): (r["eightfold"], r["status"]) for r in sp.placed(points, squares(spark), ["2022"], height).collect()}
        assert got == want


def ring(points, poly=0, number=0):
    return [("v", poly, 1, 1, number, *map(float, a), *map(float, c)) for a, c in zip(points, points[1:])]


EDGE = "version string, poly long, sixfold int, eightfold int, ring int, x1 double, y1 double, x2 double, y2 double"


def test_hole_diamond_and_bow_tie(spark):
    outer = ring([(0, 0), (0, 10), (10, 10), (10, 0), (0, 0)]) + ring([(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)], 0, 1)
    want = {(5.0, 5.0): False, (2.0, 5.0): True, (4.0, 5.0): True, (5.0, 4.0): True, (11.0, 5.0): False}
    got = {(r["x"], r["y"]): r["status"] is None for r in sp.placed(spark.createDataFrame(list(want), "x double, y double"), spark.createDataFrame(outer, EDGE), ["v"]).collect()}
    assert got == want
    diamond = ring([(0, 5), (5, 10), (10, 5), (5, 0), (0, 5)])
    want = {(5.0, 5.0): True, (2.0, 7.0): True, (1.0, 7.0): False, (2.5, 7.5): True, (0.0, 5.0): True, (10.0, 5.0): True, (-1.0, 5.0): False, (5.0, 10.0): True, (4.0, 10.0): False}
    got = {(r["x"], r["y"]): r["status"] is None for r in sp.placed(spark.createDataFrame(list(want), "x double, y double"), spark.createDataFrame(diamond, EDGE), ["v"], 2.0).collect()}
    assert got == want
    bow = spark.createDataFrame(ring([(0, 0), (20000, 20000), (20000, 0), (0, 20000), (0, 0)]), EDGE)
    r = sp.placed(spark.createDataFrame([(1000.0, 10000.0), (10000.0, 1000.0)], "x double, y double"), bow, ["v"]).orderBy("x").collect()
    assert [x["eightfold"] for x in r] == [1, None]
    assert sp.crossing_rings(bow).count() == 1 and sp.crossing_rings(squares(spark)).count() == 0


def test_area_is_conserved_and_loss_is_seen(spark):
    edges = squares(spark)
    assert failed(sp.area_checks(edges)) == set()
    assert {r["area"] for r in sp.polygon_area(edges).collect()} == {4e8}


def test_layer_faults(spark):
    v = RuralityVersion("2022", 2022)
    table = sp.polygon_table(squares(spark))
    assert failed(sp.layer_checks(table, v, ["UR6FOLD", "UR8FOLD"], 27700)) == set()
    assert failed(sp.layer_checks(table, v, ["UR6FOLD"], 4326)) == {"rurality.2022.columns_present", "rurality.2022.reference_system"}
    bad = table.withColumn("sixfold", F.lit(1))
    assert "rurality.2022.folds_nest" in failed(sp.layer_checks(bad, v, ["UR6FOLD", "UR8FOLD"], 27700))
    assert {"rurality.2022.polygons", "rurality.2022.eightfold_values"} <= failed(sp.layer_checks(table.where("poly > 0"), v, ["UR6FOLD", "UR8FOLD"], 27700))


# ---- export, digest, load ----

CONTRACT = g.ExportContract(fields=(("k", "string", False), ("text", "string", True), ("drop_me", "string", True), ("when", "date32", True), ("flag", "bool", False), ("count", "int16", False)),
                            key=("k",), exclude=("drop_me",))
SAMPLE = [("A1", "007", "x", D(2020, 1, 2), True, 1), ("A2", "", "x", None, False, 20), ("A3", None, "x", D(1973, 8, 1), True, 300)]
SCHEMA = "k string, text string, drop_me string, when date, flag boolean, count smallint"


def total(spark, rows):
    return g.row_digest(g.render(spark.createDataFrame(rows, SCHEMA), CONTRACT)).first()["total"]


def test_digest_is_the_sum_of_signed_prefixes(spark):
    lines = ["A1\x1f007\x1f2020-01-02\x1f1\x1f1", "A2\x1f\x1f\0\x1f0\x1f20", "A3\x1f\0\x1f1973-08-01\x1f1\x1f300"]
    want = sum(int.from_bytes(hashlib.sha256(l.encode()).digest()[:8], "big", signed=True) for l in lines)
    assert total(spark, SAMPLE) == str(want) == total(spark, SAMPLE[::-1])
    for i, change in ((0, {1: "7"}), (1, {1: None}), (2, {1: ""}), (1, {3: D(1900, 1, 1)}), (0, {1: "007 "}), (2, {5: 301})):
        rows = list(SAMPLE)
        rows[i] = tuple(change.get(j, v) for j, v in enumerate(rows[i]))
        assert total(spark, rows) != str(want)


def test_reserved_characters_and_contract(spark):
    bad = spark.createDataFrame([("A1", "a\x1fb", "", None, True, 1), ("A2", "a\0b", "", None, True, 1)], SCHEMA)
    r = g.reserved_characters(bad, CONTRACT).where("not passed").collect()
    assert [x["actual"] for x in r] == ["2"]
    with pytest.raises(ValueError):
        g.ExportContract(fields=CONTRACT.fields, key=("k",), exclude=("nope",)).columns()


def test_csv_round_trip_restores_types_and_empties(spark, tmp_path):
    fields = (("k", "string", False), ("role", "string", False), ("note", "string", True), ("status", "string", True), ("rank", "rank", False), ("n", "int8", True), ("d", "date32", True), ("f", "bool", False))
    c = g.ExportContract(fields, ("k",), (), "role", {"note": "large_user"}, ("status",))
    rows = [("a", "small_user", "", None, 5955.5, 3, D(2020, 1, 2), True), ("b", "large_user", None, "x", 12.0, None, None, False), ("c", "small_user", 'q"u,o te', "x", 1.0, -1, None, False)]
    df = spark.createDataFrame(rows, "k string, role string, note string, status string, rank double, n tinyint, d date, f boolean")
    path = str(tmp_path / "out_csv")
    g.write_csv(df, c, path)
    text = g.read_csv(spark, c, path)
    require(g.cells_equal(text, g.render(df, c, ""), ["k"]))
    back = g.restore(text, c)
    assert [tuple(map(str, r)) for r in back.orderBy("k").collect()] == [tuple(map(str, r)) for r in rows]
    digest = g.row_digest(g.render(df, c)).first()
    require(g.loaded_table(back, c, digest["n_rows"], digest["total"]))
    for wrong in (back.withColumn("note", F.coalesce("note", F.lit(""))), back.unionByName(back.limit(1)), back.withColumn("k", F.col("k").cast("int")), back.drop("f")):
        with pytest.raises(ChecksFailed):
            require(g.loaded_table(wrong, c, digest["n_rows"], digest["total"]))


def test_blank_null_and_value_stay_apart_in_parquet(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", "AB10 1AA"), ("c", "")], "k string, link string")
    df.write.parquet(str(tmp_path / "p"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "p")).collect()} == {("a", None), ("b", "AB10 1AA"), ("c", "")}


def test_rendered_kinds(spark):
    df = spark.createDataFrame([(5955.0, None)], "r double, b boolean")
    assert tuple(df.select(rendered("r", "rank"), rendered("b", "bool")).first()) == ("5955.0", "0")


# ---- snapshots and checks ----

def test_snapshot_diff(spark):
    s = "pc_norm string, introduced_on date, is_current boolean, zone string, spd_release string"
    before = spark.createDataFrame([("A", D(2020, 1, 1), True, "z1", "r1"), ("B", D(2020, 1, 1), True, "z1", "r1"), ("C", D(2020, 1, 1), True, None, "r1")], s)
    after = spark.createDataFrame([("A", D(2020, 1, 1), True, "z2", "r2"), ("B", D(2020, 1, 1), False, "z1", "r2"), ("D", D(2020, 1, 1), True, "z1", "r2")], s)
    key = ["pc_norm", "introduced_on"]
    assert tuple(snapshot_diff(before, after, key).first()) == (1, 1, 2, 2, 1)
    assert {r["field"]: r["changed"] for r in changed_fields(before, after, key).collect()} == {"zone": 1, "is_current": 1}
    assert compare_with_previous(None, after, key).first()["status"] == "unavailable"
    assert compare_with_previous(before.unionByName(before), after, key).first()["status"] == "unavailable"
    assert compare_with_previous(before, after, key).first()["status"] == "compared"
    assert column_changes(before.drop("zone"), after) == {"added_columns": ["zone"], "removed_columns": []}


def test_checks_report_and_stop(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "r int, c string")
    report = Checks("t.").rows(3).dense_rank("r", 3).required(["c"]).between("r", 1, 2).observe("most", F.max("r")).run(df)
    got = {r["name"]: r["passed"] for r in report.collect()}
    assert got == {"t.rows": True, "t.rank_dense": True, "t.required_values_nonnull": False, "t.r.range": False, "t.most": True}
    assert tuple(summary(report).first()) == (4, 2, 2)
    with pytest.raises(ChecksFailed, match="2 blocking"):
        require(report)
    require(unique_key(df, ["r"]))
    with pytest.raises(ChecksFailed):
        require(unique_key(df, ["c"]).unionByName(values_within(df, "r", [1, 2], "codes")))


def test_registry_numbers():
    assert [len(e.measures()) for e in REGISTRY.editions] == [51, 57, 57, 57, 57, 58]
    assert REGISTRY.rurality_windows()[5] == (2013, 2015, "2013-2014")


def test_bytes_of_very_wide_rows(spark):
    """As many columns as a report's directory has, and more: the sum may not be as deep as it is long."""
    from areadep.operators.skew import measured, row_bytes
    text = F.col("id").cast("string")
    wide = spark.range(2).select(*[F.concat(F.lit("ab"), text).alias(f"c{k}") for k in range(1500)], F.struct(text.alias("a"), F.col("id").alias("b")).alias("s"))
    assert wide.agg(F.sum(row_bytes(wide.schema))).first()[0] == 2 * (1500 * 11 + 9 + 8)
    kept, small = measured(wide, 10)
    kept.unpersist()
    assert not small
