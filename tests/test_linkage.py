"""The full linkage results on made-up directories in which every measure of every edition has its own value."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from areadep.plans import report as rp
from areadep.registry import LOOKUP_HEADER, REGISTRY, SMALL_USER_HEADER
from areadep.schema import history_fields, main_fields, struct_type

D = dt.date
FIELDS = history_fields()
def open_schema(fields):
    return StructType([StructField(f.name, f.dataType, True) for f in struct_type(fields).fields])


def stored(seed):
    """Values that differ by record, edition and measure."""
    out = {}
    for n, e in enumerate(REGISTRY.editions):
        for k, m in enumerate(e.measures()):
            out[e.column(m)] = "rank_sources_disagree" if m.endswith("_status") else (seed * 10 + n + k / 2 if m.endswith("_domain_rank") else (seed * 17 + n * 5 + k) % 120)
    return out


def life(pc="AB11AA", base=None, intro="2010-01-01", deleted=None, user="small_user", link="", seed=1, split="N", reason=None):
    row = {f.name: None for f in FIELDS}
    row.update({c: f"raw-{c}" for c in SMALL_USER_HEADER})
    row.update(stored(seed))
    for v in (2001, 2011):
        row[f"DataZone{v}Code"], row[f"IntermediateZone{v}Code"] = f"dz{v}-{seed}", f"iz{v}-{seed}"
        row.update({f"phs_dz{v}_{g}": f"{g}-{v}-{seed}" for g in ("hb", "hscp", "ca")})
    for i, v in enumerate(REGISTRY.rurality_versions):
        row[f"{v.stem}_6fold"], row[f"{v.stem}_8fold"], row[f"{v.stem}_status"] = (None, None, reason) if reason else ((seed + i) % 6 + 1, (seed + i) % 8 + 1, None)
    day = lambda s: D.fromisoformat(s) if s else None
    row.update(pc_norm=pc, pc_base=base or pc, spd_user_type=user, spd_release="r1", introduced_on=day(intro), deleted_on=day(deleted),
               is_current=deleted is None, LinkedSmallUserPostcode=link, SplitIndicator=split, Postcode=pc)
    return row


def directory(spark, *lives):
    return spark.createDataFrame([tuple(r[f.name] for f in FIELDS) for r in lives], open_schema(FIELDS))


def cohort(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def statuses(df, column="postcode_status"):
    return {r["id"]: r[column] for r in df.select("id", column).collect()}


def test_contract_widths(spark):
    assert len(rp.common()) == 84
    assert len(FIELDS) == 442 and len(main_fields()) == 399
    h = directory(spark, life())
    c = cohort(spark, [(1, "AB1 1AA", D(2020, 1, 1), 2020)], "id int, postcode string, address_date date, analysis_year int")
    assert len(rp.by_era(c, h).columns) == 151
    assert len(rp.throughout(c, h, "2016").columns) == 151
    assert len(rp.on_date(c, h).columns) == 154


def test_every_measure_of_the_chosen_edition(spark):
    h = directory(spark, life(seed=3))
    years = {e.first_year: e for e in REGISTRY.editions}
    c = cohort(spark, [(y, "ab1 1aa", y) for y in years], "id int, postcode string, analysis_year int")
    values = stored(3)
    for r in rp.by_era(c, h).collect():
        e = years[r["id"]]
        assert (r["simd_edition"], r["data_zone_vintage"], r["simd_status"]) == (e.key, e.vintage, "matched")
        assert r["data_zone_code"] == f"dz{e.vintage}-3" and r["phs_ca_code"] == f"ca-{e.vintage}-3" and r["intermediate_zone_code"] == f"iz{e.vintage}-3"
        for out, m in rp.measures().items():
            assert r[out] == (values[e.column(m)] if e.publishes(m) else None), (e.key, m)


def test_year_problems(spark):
    h = directory(spark, life())
    c = cohort(spark, [(1, "AB1 1AA", None), (2, "AB1 1AA", 0), (3, "AB1 1AA", 10000), (4, "AB1 1AA", 1995), (5, "ZZ1 1ZZ", 1995), (6, "ZZ1 1ZZ", 2000)],
               "id int, postcode string, analysis_year int")
    out = rp.by_era(c, h)
    assert statuses(out, "simd_status") == {1: "missing_year", 2: "invalid_year", 3: "invalid_year", 4: "no_edition", 5: "no_edition", 6: "not_found"}
    assert statuses(out, "rurality_status") == {1: "missing_year", 2: "invalid_year", 3: "invalid_year", 4: "before_first_version", 5: "not_found", 6: "not_found"}
    assert statuses(rp.throughout(c, h, "1999"), "simd_status")[1] == "unknown_edition"


def test_key_problems_keep_every_row(spark):
    h = directory(spark, life())
    keys = [None, "   ", "ZZ1 1ZZ", " ab1 1aa ", "AB1 1AAA", "AB1\t1AA", "ab1 1aa"]
    c = cohort(spark, [(i, k) for i, k in enumerate(keys)] + [(3, " ab1 1aa ")], "id int, postcode string")
    out = rp.throughout(c, h, "2020v2")
    assert out.count() == 8
    assert statuses(out) == {0: "missing_postcode", 1: "missing_postcode", 2: "not_found", 3: "matched", 4: "not_found", 5: "not_found", 6: "matched"}


A, B, C = "AB11AAA", "AB11AAB", "AB11AAC"
GONE = "2010-02-01"
LATEST = [
    ("live A over deleted whole", [life(deleted=GONE), life(A, "AB11AA", seed=2)], A, "a_part"),
    ("A from 1973 over deleted C", [life(A, "AB11AA", "1973-01-01"), life(C, "AB11AA", "1978-01-01", "1979-01-01")], A, "a_part"),
    ("A over a newer B", [life(A, "AB11AA"), life(B, "AB11AA", "2020-01-01")], A, "a_part"),
    ("only B lives", [life(deleted=GONE), life(B, "AB11AA")], B, "split_a_missing"),
    ("B before C", [life(deleted=GONE), life(C, "AB11AA"), life(B, "AB11AA")], B, "split_a_missing"),
    ("whole and A tie", [life(), life(A, "AB11AA")], "AB11AA", "ambiguous_postcode"),
    ("newest life is an unlinked large user", [life(deleted=GONE), life(intro="2015-01-01", user="large_user", link="NO LINK")], "AB11AA", "unlinked_large_user"),
    ("blank link", [life(user="large_user", link="")], "AB11AA", "unlinked_large_user"), ("null link", [life(user="large_user", link=None)], "AB11AA", "unlinked_large_user"),
    ("po box", [life(user="large_user", link="NO LINKP")], "AB11AA", "po_box"), ("link to nothing", [life(user="large_user", link="ZZ1 1ZZ")], "AB11AA", "linked_small_user_not_found"),
]


@pytest.mark.parametrize("name,rows,matched,status", LATEST, ids=[c[0] for c in LATEST])
def test_latest_life(spark, name, rows, matched, status):
    r = rp.throughout(cohort(spark, [(1, "AB1 1AA")], "id int, postcode string"), directory(spark, *rows), "2020v2").first()
    assert (r["matched_pc_norm"], r["postcode_status"]) == (matched, status)
    usable = status in ("matched", "a_part", "linked_small_user")
    assert r["simd_status"] == ("matched" if usable else status) and (r["simd_rank"] is not None) == usable


def test_links_are_followed_exactly(spark):
    targets = [life("AB11AC", seed=5), life("AB11BAA", "AB11BA", seed=6), life("AB11BAB", "AB11BA", seed=7), life("AB11AD", user="large_user", link="AB1 1AC")]
    want = {"AB1 1AC": 5, " ab1 1ac ": 5, "AB1 1BAA": 6, "AB1 1BAB": 7, "AB1 1BA": None, "AB1 1AD": None, "ZZ1 1ZZ": None}
    large = [life(f"AB12{chr(65 + i)}A", user="large_user", link=l) for i, l in enumerate(want)]
    h = directory(spark, *targets, *large)
    c = cohort(spark, [(i, f"AB1 2{chr(65 + i)}A", D(2020, 5, 5), 2020) for i in range(len(want))], "id int, postcode string, address_date date, analysis_year int")
    for out in (rp.by_era(c, h), rp.on_date(c, h)):
        got = {r["id"]: r for r in out.collect()}
        for i, seed in enumerate(want.values()):
            assert got[i]["postcode_status"] == ("linked_small_user" if seed else "linked_small_user_not_found")
            assert got[i]["data_zone_code"] == (f"dz2011-{seed}" if seed else None)
            assert got[i]["DataZone2011Code"] == "dz2011-1"      # its own zone stays beside it


@pytest.mark.parametrize("strategy", ["auto", "sorted"])
def test_life_on_the_date(spark, strategy):
    h = directory(spark, life(intro="1973-08-01", deleted="1978-04-01", seed=1), life(intro="1978-11-01", seed=2))
    want = {D(1975, 6, 1): ("matched", 1), D(1973, 8, 1): ("matched", 1), D(1978, 3, 31): ("matched", 1), D(1978, 4, 1): ("previous_life", 1), D(1978, 6, 1): ("previous_life", 1),
            D(1978, 11, 1): ("matched", 2), D(1990, 6, 1): ("matched", 2), D(1970, 1, 1): ("postcode_not_yet_introduced", None), None: ("missing_address_date", None)}
    c = cohort(spark, [(i, "AB1 1AA", d, 2018) for i, d in enumerate(want)], "id int, postcode string, address_date date, analysis_year int")
    got = {r["address_date"]: r for r in rp.on_date(c, h, strategy=strategy).collect()}
    assert {d: (r["postcode_status"], r["simd_rank"]) for d, r in got.items()} == {
        d: (s, stored(seed)["simd2020v2_rank"] if seed else None) for d, (s, seed) in want.items()}
    gap = got[D(1978, 6, 1)]
    assert (gap["first_introduced_on"], gap["previous_life_deleted_on"], gap["next_life_introduced_on"]) == (D(1973, 8, 1), D(1978, 4, 1), D(1978, 11, 1))
    missing = got[None]
    assert (missing["first_introduced_on"], missing["previous_life_deleted_on"], missing["next_life_introduced_on"]) == (D(1973, 8, 1), None, None)


def test_no_life_before_the_date_and_same_day_lives(spark):
    same = directory(spark, life(intro="2000-01-01", deleted="2000-01-01"), life("AB11AB", intro="2000-01-01", deleted="2000-01-01"), life("AB11AB", intro="2005-01-01"))
    c = cohort(spark, [(1, "AB1 1AA", D(2001, 1, 1)), (2, "AB1 1AB", D(2001, 1, 1)), (3, "AB1 1AB", D(2000, 1, 1))], "id int, postcode string, address_date date")
    assert statuses(rp.on_date(c, same)) == {1: "postcode_deleted_by_date", 2: "between_lives", 3: "between_lives"}


def test_parts_on_a_date(spark):
    h = directory(spark, life(intro="1990-01-01", deleted="2000-01-01", seed=1), life(A, "AB11AA", "2000-01-01", "2010-01-01", seed=2),
                  life(B, "AB11AA", "2000-01-01", seed=3))
    c = cohort(spark, [(1, "AB1 1AA", D(1995, 1, 1)), (2, "AB1 1AA", D(2005, 1, 1)), (3, "AB1 1AA", D(2015, 1, 1))], "id int, postcode string, address_date date")
    assert statuses(rp.on_date(c, h)) == {1: "matched", 2: "a_part", 3: "split_a_missing"}
    tie = directory(spark, life(intro="2000-01-01"), life(A, "AB11AA", "2000-01-01"))
    assert statuses(rp.on_date(c, tie))[2] == "ambiguous_postcode"


def test_linked_record_must_be_valid_on_the_date(spark):
    large = life("AB11AL", intro="2000-01-01", deleted="2010-01-01", user="large_user", link="AB1 1AS")
    target = [life("AB11AS", intro="1990-01-01", deleted="2005-01-01", seed=4), life("AB11AS", intro="2008-01-01", seed=5)]
    c = cohort(spark, [(1, "AB1 1AL", D(2003, 1, 1), 2016), (2, "AB1 1AL", D(2006, 1, 1), 2016), (3, "AB1 1AL", D(2009, 1, 1), 2016), (4, "AB1 1AL", D(2020, 1, 1), 2016)],
               "id int, postcode string, address_date date, analysis_year int")
    for strategy in ("auto", "sorted"):
        got = {r["id"]: (r["postcode_status"], r["data_zone_code"]) for r in rp.on_date(c, directory(spark, large, *target), strategy=strategy).collect()}
        assert got == {1: ("linked_small_user", "dz2011-4"), 2: ("linked_small_user_not_found", None), 3: ("linked_small_user", "dz2011-5"),
                       4: ("previous_life", "dz2011-5")}


def test_overlapping_lives_stop_the_job(spark):
    h = directory(spark, life(intro="2000-01-01", deleted="2010-01-01"), life(intro="2005-01-01"))
    c = cohort(spark, [(1, "AB1 1AA", D(2003, 1, 1))], "id int, postcode string, address_date date")
    with pytest.raises(Exception, match="overlap"):
        rp.on_date(c, h).collect()


def test_missing_value_only_where_published(spark):
    h = directory(spark, {**life(), "simd2006_crime_domain_rank": None})
    c = cohort(spark, [(1, "AB1 1AA", 2000), (2, "AB1 1AA", 2005), (3, "AB1 1AA", 2012)], "id int, postcode string, analysis_year int")
    assert statuses(rp.by_era(c, h), "simd_status") == {1: "matched", 2: "missing_simd", 3: "matched"}


def test_rurality_reason_is_reported(spark):
    h = directory(spark, life(reason="outside_polygons"))
    c = cohort(spark, [(1, "AB1 1AA", D(2021, 1, 1)), (2, "AB1 1AA", D(2009, 1, 1))], "id int, postcode string, address_date date")
    r = rp.on_date_short(c, h).where("id = 1").first()
    assert (r["rurality_version"], r["rurality_6fold"], r["rurality_status"]) == ("2020", None, "outside_polygons")


def test_lookup_product(spark):
    fields = main_fields()
    def row(**k):
        r = life(**{x: v for x, v in k.items() if x != "kind"})
        r.update({c: f"raw-{c}" for c in LOOKUP_HEADER if c not in r or r[c] is None}, sspl_release="s1")
        return tuple(r.get(f.name) for f in fields)
    small = dict(pc="AB11AC", seed=5), dict(pc="AB11AB", seed=6, split="Y")
    links = {"AB1 1AC": 5, "AB1 1AB": 6, "AB1 1ABA": 6, "AB1 1ABB": None, "AB1 1ABC": None, "AB1 1ACA": None, "AB1 1ADA": None, "NO LINKP": None, "NO LINK": None}
    large = [dict(pc=f"AB12{chr(65 + i)}A", user="large_user", link=l) for i, l in enumerate(links)]
    m = spark.createDataFrame([row(**k) for k in (*small, *large)], open_schema(fields))
    rows = [(i, f"AB1 2{chr(65 + i)}A", 2018) for i in range(len(links))] + [(20, "AB1 1AC", 2018), (21, "AB1 1AB", 2018), (22, "AB1 1ABA", 2018)]
    out = rp.lookup_by_era(cohort(spark, rows, "id int, postcode string, analysis_year int"), m)
    assert len(out.columns) == 132
    got = {r["id"]: r for r in out.collect()}
    for i, (link, seed) in enumerate(links.items()):
        status = {"NO LINKP": "po_box", "NO LINK": "unlinked_large_user"}.get(link, "linked_small_user" if seed else "linked_small_user_not_found")
        assert (got[i]["postcode_status"], got[i]["data_zone_code"]) == (status, f"dz2011-{seed}" if seed else None)
    assert [got[i]["postcode_status"] for i in (20, 21, 22)] == ["matched", "a_part", "not_found"]
    assert rp.lookup_throughout(cohort(spark, [(1, "AB1 1AC")], "id int, postcode string"), m, "2004").first()["simd_edition"] == "2004"


@pytest.mark.parametrize("n", [2, 9])
def test_a_same_day_record_changes_nothing_whatever_is_carried(spark, n):
    """One row a request, with the values of the life, for few and for many carried columns."""
    from areadep.plans.linkage import link_as_of, link_latest
    columns = [e.column("rank") for e in REGISTRY.editions] + ["Postcode", "SplitIndicator", "spd_release"]
    h = directory(spark, life(intro="2000-01-01", deleted="2010-01-01", seed=1), life(intro="2010-01-01", deleted="2010-01-01", user="large_user", link="NO LINK", seed=2),
                  life(intro="2010-01-01", seed=3))
    c = cohort(spark, [(1, "AB1 1AA", D(2010, 1, 1)), (2, "AB1 1AA", D(2005, 5, 5)), (3, "AB1 1AA", D(2020, 1, 1))], "id int, postcode string, address_date date")
    rank = columns[0]
    dated = {r["id"]: r[f"source_{rank}"] for r in link_as_of(c, h, source=columns[:n]).collect()}
    newest = [(r["id"], r[f"source_{rank}"]) for r in link_latest(c, h, source=columns[:n]).collect()]
    want = {s: stored(s)[rank] for s in (1, 3)}
    assert dated == {1: want[3], 2: want[1], 3: want[3]} and sorted(newest) == [(i, want[3]) for i in (1, 2, 3)]
    assert link_as_of(c, h, source=columns[:n]).count() == 3


def shuffled(plan) -> list[str]:
    """The columns of every shuffle of a plan."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return shuffled(plan.initialPlan())
    mine = [plan.schema().json()] if plan.nodeName() == "Exchange" else []
    return mine + [x for i in range(plan.children().size()) for x in shuffled(plan.children().apply(i))]


@pytest.mark.parametrize("link", ["link_latest", "link_as_of"])
def test_rows_of_a_cohort_are_not_shuffled_with_what_the_directory_carries(spark, link):
    """Many carried columns: by shuffles the same rows as by broadcast, and none moves a row together with its values. Values move null for null."""
    from areadep.plans import linkage
    columns = [e.column(m) for e in REGISTRY.editions for m in ("rank", "pw_scotland_quintile")]
    gap = lambda **k: life(**k) | {columns[0]: None, columns[1]: 5}
    h = directory(spark, *[life(intro=f"200{y}-01-01", deleted=f"200{y}-06-01", seed=1) for y in range(9)], life(intro="2010-01-01", seed=2),
                  gap(pc="AB11AB", intro="2001-01-01", deleted="2005-01-01", seed=3), life(pc="AB11AB", intro="2005-01-01", seed=3) | {columns[0]: 5, columns[1]: None},
                  life(pc="AB11AC", user="large_user", link="AB1 1AA", seed=4))
    days = [(i, f"AB1 1A{'ABCD'[i % 4]}" if i % 9 else None, D(1999 + i % 13, 2 + i % 9, 1)) for i in range(200)]
    c = cohort(spark, days, "id int, postcode string, address_date date")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved, stayed = [getattr(linkage, link)(c, h, context=["Postcode"], source=columns, strategy=how) for how in ("sorted", "broadcast")]
        rows = [x for x in shuffled(moved._jdf.queryExecution().executedPlan()) if '"name":"id"' in x]
        assert rows and not [x for x in rows if columns[0] in x]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = moved.collect()
    assert moved.columns == stayed.columns and sorted(map(repr, got)) == sorted(map(repr, stayed.collect()))
    of = {(r[f"source_{columns[0]}"], r[f"source_{columns[1]}"]) for r in got if r["matched_pc_norm"] == "AB11AB"}
    assert of <= {(None, 5), (5, None)} and (5, None) in of


def test_a_report_of_one_edition_reads_no_other(spark):
    """Unread values are not worked out, however they could be: types and columns are those of all editions."""
    h = directory(spark, life(seed=2))
    other = h.withColumns({c: F.raise_error(F.lit("read")).cast(h.schema[c].dataType) for c in ("simd2020v2_rank", "simd2004_pw_hb_decile", "urbanrural2003_2004_6fold")})
    c = cohort(spark, [(1, "AB1 1AA"), (2, "ZZ1 1ZZ")], "id int, postcode string")
    for how in ("auto", "sorted"):
        out = rp.throughout(c, other, "2012", strategy=how)
        assert out.schema.simpleString() == rp.throughout(c, h, "none such").schema.simpleString()
        assert {r["id"]: (r["simd_rank"], r["simd_status"]) for r in out.collect()} == {1: (stored(2)["simd2012_rank"], "matched"), 2: (None, "not_found")}


def test_the_short_report_reads_what_it_shows(spark):
    """A value that a row's edition published and the record lacks makes it missing_simd as before, though it is not shown; fields of the record are not read."""
    lacks = life(seed=2) | {"simd2012_pw_hb_decile": None, "simd2020v2_housing_domain_rank_source_status": None, "IntermediateZone2011Code": None}
    h = directory(spark, lacks, life(pc="AB11AB", seed=3) | {"phs_dz2001_ca": None})
    other = h.withColumn("Locality1991Code", F.raise_error(F.lit("read")).cast("string"))
    c = cohort(spark, [(i, f"AB1 1A{x}", D(y, 5, 1)) for i, (x, y) in enumerate((x, y) for x in "AB" for y in (2011, 2020))], "id int, postcode string, address_date date")
    for how in ("auto", "sorted"):
        got = {r["id"]: (r["simd_status"], r["simd_rank"]) for r in rp.on_date_short(c, other, strategy=how).collect()}
        assert got == {0: ("missing_simd", stored(2)["simd2012_rank"]), 1: ("matched", stored(2)["simd2020v2_rank"]),
                       2: ("missing_simd", stored(3)["simd2012_rank"]), 3: ("matched", stored(3)["simd2020v2_rank"])}
