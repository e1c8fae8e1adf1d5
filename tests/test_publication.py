"""The commit of a publication, and comparing snapshots by digests of key ranges."""

import random

import pytest

from areadep.operators import snapshot as sn
from areadep.plans import publish as pb


def test_one_of_two_writers_wins(spark, tmp_path):
    root = str(tmp_path / "results")
    assert pb.latest_version(spark, root) == (0, None) and pb.current(spark, root, "t") is None
    began = pb.latest_version(spark, root)[0]
    pb.commit(spark, root, began + 1, "run-a")
    with pytest.raises(pb.PublishedMeanwhile):
        pb.commit(spark, root, began + 1, "run-b")
    assert pb.latest_version(spark, root) == (1, "run-a")
    pb.commit(spark, root, 2, "run-c")
    assert pb.latest_run(spark, root) == "run-c"
    assert [r["run_id"] for r in spark.read.json(f"{root}/publications").orderBy("published_at").collect()] == ["run-a", "run-c"]
    (tmp_path / "results" / "publications" / "000000000003.json").write_text("")      # a writer that was lost as it began
    assert pb.latest_version(spark, root) == (3, "run-c")


def test_a_published_table_that_was_altered_is_not_trusted(spark, tmp_path):
    from areadep.operators import digest as g
    root = str(tmp_path / "results")
    df = spark.createDataFrame([(k, f"v{k}") for k in range(20)], "k long, v string")
    df.write.parquet(f"{root}/runs/r1/t")
    g.table_fingerprint(df).selectExpr("'t' as table", "total as fingerprint").write.json(f"{root}/runs/r1/manifest")
    assert pb.still_as_published(spark, root, "r1", "t", pb.published(spark, root, "r1", "t"))
    df.where("k < 19").write.mode("overwrite").parquet(f"{root}/runs/r1/t")
    before = pb.published(spark, root, "r1", "t")
    assert not pb.still_as_published(spark, root, "r1", "t", before)
    out = sn.compare_with_previous(before, df, ["k"], pb.still_as_published(spark, root, "r1", "t", before)).first()
    assert out["status"] == "unavailable" and "published" in out["reason"]


@pytest.mark.parametrize("per_range", [1, 8, 100_000])
def test_only_ranges_that_differ_are_joined(spark, per_range):
    rng = random.Random(5)
    rows = {k: (rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]), rng.random() < 0.5) for k in range(3000)}
    after = dict(rows)
    for k in rng.sample(range(3000), 12):
        after[k] = (rng.choice([None, "a", "c"]), rng.choice([None, 1, 9]), rng.random() < 0.5)
    del after[7], after[2000]
    after[5000] = ("n", 1, True)
    make = lambda d, kind: spark.createDataFrame([(k, *v) for k, v in d.items()], f"k long, a string, b {kind}, is_current boolean")
    old, new = make(rows, "int"), make(after, "long")
    r = sn.compared(old, new, ["k"], per_range=per_range).first()
    common = [k for k in rows if k in after]
    assert (r["added_records"], r["removed_records"], r["common_records"]) == (1, 2, 2998)
    assert r["changed_records"] == sum(rows[k] != after[k] for k in common)
    assert r["newly_deleted_records"] == sum(rows[k][2] and not after[k][2] for k in common)
    want = {c: (sum(rows[k][i] != after[k][i] for k in common), sum(rows[k][i] != after[k][i] and rows[k][2] and after[k][2] for k in common)) for i, c in enumerate(("a", "b", "is_current"))}
    assert {f["field"]: (f["changed"], f["changed_current"]) for f in r["fields"]} == {c: w for c, w in want.items() if w[0]}
    bits = sn.range_bits(3000, per_range)
    columns = sn.compared_columns(old, new, ["k"])
    ranges = sn.unequal_ranges(sn._printed(old, new, ["k"], columns), sn._printed(new, old, ["k"], columns), bits).count()
    assert ranges <= 15 and (per_range > 8 or ranges >= 3)
    same = sn.compared(old, old.selectExpr("*"), ["k"], per_range=per_range).first()
    assert tuple(same)[:5] == (0, 0, 3000, 0, 0) and same["fields"] == []


def test_gaps_and_repeats_are_told_apart(spark):
    schema = "k int, a string, b string"
    one = spark.createDataFrame([(1, None, "x"), (2, "y", None)], schema)
    two = spark.createDataFrame([(1, "x", None), (2, None, "y")], schema)
    assert sn.snapshot_diff(one, two, ["k"], None).first()["changed_records"] == 2
    empty = one.where("k < 0")
    assert tuple(sn.snapshot_diff(empty, one, ["k"], None).first()) == (2, 0, 0, 0, 0) and tuple(sn.snapshot_diff(one, empty, ["k"], None).first()) == (0, 2, 0, 0, 0)


def test_metadata_is_compared_whole(spark, tmp_path):
    from areadep.schema import Field, field_metadata, metadata_checks, provenance, typed
    fields = [Field("k", "string", False, "directory"), Field("simd2004_rank", "int16", False, "phs", "2004")]
    df = spark.createDataFrame([("a", 5)], "k string, simd2004_rank int")
    about = provenance(["k"], "spd", "r1", "postcode_grid_reference", "d" * 64, [("b.csv", "2"), ("a.csv", "1")])
    assert [s["path"] for s in about["sources"]] == ["a.csv", "b.csv"]
    typed(df, fields, "spd", about).write.parquet(f"{tmp_path}/t")
    saved = spark.read.parquet(f"{tmp_path}/t")
    failed = lambda table, like=fields: {r["name"] for r in metadata_checks(saved, field_metadata(like, "spd", table), "t").where("not passed").collect()}
    assert failed(about) == set()
    assert failed({**about, "decisions_sha256": "x", "sources": about["sources"][:1]}) == {"t.metadata.decisions_sha256", "t.metadata.sources"}
    assert failed({k: v for k, v in about.items() if k != "allocation"}) == {"t.metadata.allocation"}
    assert failed(about, [fields[0], Field("simd2004_rank", "int16", False, "phs", "2006")]) == {"t.metadata"}
    assert {f"t.metadata.{k}" for k in about} == failed(None)
