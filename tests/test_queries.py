"""Registered queries run, and agree with their SQL on another engine over the same files."""

import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
OWN = {**entry.queries_linkage.QUERIES, **entry.queries_data.QUERIES, **entry.queries_report.QUERIES, **entry.queries_sources.QUERIES}
NAMES = sorted(OWN)


@pytest.fixture(scope="module")
def duck(sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v != v:
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    if isinstance(v, bool) or isinstance(v, str):
        return v
    return round(float(v), 6)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_its_sql():
    assert set(entry.oracle_sql()) >= set(OWN) and len(OWN) >= 65


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    mine = ordered(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    theirs = ordered(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in cur.fetchall())
    assert columns == sorted(names) and mine == theirs


def test_stream_of_requests(spark, sf, tmp_path):
    from areadep.plans import standin as t
    from areadep.plans.linkage import latest_table, link_latest
    from areadep.streaming.linked import link_stream
    lives = t.lives(spark, sf).persist()
    t.cohort(spark, sf).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(t.cohort(spark, sf).schema).parquet(str(tmp_path / "in"))
    out = link_stream(source, latest_table(lives, t.TEST_LIVES))
    q = out.select("id", "postcode_status").writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("postcode_status").count().collect()
    want = link_latest(t.cohort(spark, sf), lives, lives=t.TEST_LIVES).groupBy("postcode_status").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
