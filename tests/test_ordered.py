"""The scan of range partitions: outliers, one hot group, groups over many partitions, and what its plans hold."""

import random

import pytest

from areadep.operators import ordered
from areadep.operators.weighted import population_bands


def table(spark, n=4000):
    """One group holds most rows and one far outlier; a null group; small groups; missing values."""
    rng = random.Random(3)
    rows = [("hot", k, rng.randint(0, 9)) for k in range(n)] + [("hot", 10 ** 15, 7)] + [(None, k, rng.randint(0, 5)) for k in range(50)]
    rows += [(f"g{k % 40:02d}", k, rng.choice([None, 1, 2])) for k in range(200)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g string, o long, v int").repartition(3), rows


def by_group(rows):
    groups = {}
    for g, o, v in rows:
        groups.setdefault(g, []).append((o, v))
    return {g: sorted(x) for g, x in groups.items()}


@pytest.mark.parametrize("partitions", ["1", "5", "60"])
@pytest.mark.parametrize("batch", ["10000", "7"])
def test_scans_over_any_partitions(spark, partitions, batch):
    df, rows = table(spark, 900)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        for k, v in zip(kept, (partitions, "false", batch), strict=True):
            spark.conf.set(k, v)
        total = {(r["g"], r["o"]): r["t"] for r in ordered.running_total(df, ["g"], "o", "v", "t").collect()}
        before = {(r["g"], r["o"]): r["p"] for r in ordered.previous_value(df, ["g"], "o", "v", "p").collect()}
        doubles = {(r["g"], r["o"]): r["t"] for r in ordered.running_total(df.selectExpr("g", "o", "v / 2.0D as v"), ["g"], "o", "v", "t").collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    for g, x in by_group(rows).items():
        so_far, last = 0, None
        for o, v in x:
            so_far += v or 0
            assert total[g, o] == so_far and before[g, o] == last and doubles[g, o] == so_far / 2
            last = v
    assert len(total) == len(before) == len(rows)


def test_no_groups_no_rows_and_other_types(spark):
    df = spark.createDataFrame([(k, k * 2) for k in range(100)], "o int, v long").repartition(4)
    assert {r["o"]: r["t"] for r in ordered.running_total(df, [], "o", "v", "t").collect()} == {k: k * (k + 1) for k in range(100)}
    text = df.selectExpr("o", "cast(v as string) as v")
    assert {r["o"]: r["p"] for r in ordered.previous_value(text, [], "o", "v", "p").collect()} == {k: str(k * 2 - 2) if k else None for k in range(100)}
    assert ordered.running_total(df.where("o < 0"), [], "o", "v", "t").collect() == ordered.previous_value(df.where("o < 0"), ["v"], "o", "v", "p").collect() == []
    with pytest.raises(TypeError):
        ordered.running_total(text, [], "o", "v", "t")


def test_an_outlier_moves_a_bound_and_nothing_else(spark):
    df, _ = table(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        sizes = [r["count"] for r in ordered.in_order(df, ["g"], "o").groupBy("_part").count().collect()]
        hot = ordered.in_order(df, ["g"], "o").where("g = 'hot'").select("_part").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert len(sizes) == 16 and max(sizes) < 2.5 * sum(sizes) / 16 and hot >= 14


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_bands_are_cut_without_cartesian_products(spark, groups):
    df = spark.createDataFrame([(k % 2, k, 10 ** 12 if k == 499 else k, 5) for k in range(500)], "g int, i long, rank long, people long")
    out = population_bands(df, groups, "rank", "people", {"band": 10})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Window" not in plan
    bands = {r["i"]: r["band"] for r in out.collect()}
    assert all(bands[k] == (1 + k // 50 if not groups else 1 + (k // 2) // 25) for k in range(500))
