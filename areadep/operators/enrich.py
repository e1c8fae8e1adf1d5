"""Every edition of the index on every directory record.

Editions of one vintage share their zones, so they are first laid side by side into one wide table per
vintage. A directory then needs one join per vintage instead of one per edition and publisher.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import half_unit, same, total
from ..registry import BAND_WIDTH, GEOGRAPHIES, RANK_SOURCES_DISAGREE, REGISTRY, Edition, Registry
from .checks import Checks, count_if, static_check, union_checks, unique_key
from .skew import BROADCAST_BYTES, lookup_join, row_bytes


def stacked(tables: list[DataFrame]) -> DataFrame:
    """Edition tables one under another; a measure an edition did not publish is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def vintage_table(service: DataFrame, gov: DataFrame, vintage: int, registry: Registry = REGISTRY) -> DataFrame:
    """dz_code, the vintage's three areas from its first edition, and every measure of its editions,
    named for the output. One aggregation per publisher lays the editions side by side."""
    eds = registry.of_vintage(vintage)
    pick = lambda e, c: F.max(F.when(F.col("edition") == e.key, F.col(c)))
    keys = [e.key for e in eds]
    s = service.where(F.col("edition").isin(*keys)).groupBy("dz_code").agg(
        *[pick(eds[0], g).alias(f"phs_dz{vintage}_{g}") for g in GEOGRAPHIES],
        *[pick(e, m).alias(e.column(m)) for e in eds for m in e.service_measures()])
    g = gov.where(F.col("edition").isin(*keys)).groupBy("dz_code").agg(
        *[pick(e, m).alias(e.column(m)) for e in eds for m in e.government_measures()])
    return s.join(g, "dz_code", "full_outer")


def enrich(index: DataFrame, service: DataFrame, gov: DataFrame, registry: Registry = REGISTRY, zone_column="DataZone{}Code") -> DataFrame:
    """The index with every edition joined on. A zone table is broadcast only if its rows, as measured, are small enough."""
    out = index
    for v in registry.vintages():
        zones = vintage_table(service, gov, v, registry)
        zone = zone_column.format(v)
        size = zones.agg(F.sum(row_bytes(zones.schema))).first()[0]
        out = lookup_join(out, zones.withColumnRenamed("dz_code", zone), [zone], small=(size or 0) <= BROADCAST_BYTES)
    return out


def join_edition(table: DataFrame, edition_table: DataFrame, on: str, measures: list[str], prefix: str) -> DataFrame:
    """One edition's measures on a zone column, named with a prefix. Rows never multiply."""
    right = edition_table.select(F.col("dz_code").alias(on), *[F.col(m).alias(f"{prefix}{m}") for m in measures])
    return lookup_join(table, right, [on])


def attached_columns(registry: Registry = REGISTRY) -> list[str]:
    geo = [f"phs_dz{v}_{g}" for v in registry.vintages() for g in GEOGRAPHIES]
    return geo + [e.column(m) for e in registry.editions for m in e.measures()]


def enriched_checks(table: DataFrame, index: DataFrame, key: list[str], registry: Registry = REGISTRY, label: str = "join") -> DataFrame:
    """Rows unchanged, every cell filled, ranks, bands and flags in range, the directory's own rank equal."""
    columns = attached_columns(registry)
    missing = [c for c in columns if c not in table.columns]
    spark = table.sparkSession
    shape = static_check(spark, f"{label}.schema_columns", missing, [])
    if missing:
        return shape
    statuses = [c for c in columns if c.endswith("_source_status")]
    valued = [c for c in columns if c not in statuses]
    ranks = [c for c in valued if c.endswith("_domain_rank")]
    c = Checks(f"{label}.").required(valued, "every_record_matched")
    for s in statuses:
        c.zero(f"{s}.values", F.col(s).isNotNull() & (F.col(s) != RANK_SOURCES_DISAGREE))
    counted = lambda tests: total([count_if(t) for t in tests])
    c.equal("domain_ranks_half_units", counted([~half_unit(r) for r in ranks]), 0)
    c.equal("domain_ranks_positive", counted([F.col(r) < 1 for r in ranks]), 0)
    banded = [(b, k) for b in valued for w, k in BAND_WIDTH.items() if b.endswith("_" + w)]
    c.equal("band_ranges", counted([~F.col(b).between(1, k) for b, k in banded]), 0, f"{len(banded)} columns")
    flags = [f for f in valued if f.endswith("15pc")]
    c.equal("flags_binary", counted([~F.col(f).isin(0, 1) for f in flags]), 0, f"{len(flags)} columns")
    if registry.directory_rank and registry.directory_rank[1] in table.columns:
        edition, own = registry.directory_rank
        c.zero("directory_rank_agreement", ~F.col(own).try_cast("int").eqNullSafe(F.col(f"simd{edition}_rank").cast("int")))
    # Both counts come from one aggregation each, compared as one row.
    n = table.agg(F.count(F.lit(1)).alias("n")).unionByName(index.agg(F.count(F.lit(1)).alias("n")))
    rows = Checks(f"{label}.").equal("rows_unchanged", F.max("n") - F.min("n"), 0).run(n)
    return union_checks(shape, c.run(table), rows, unique_key(table, key, f"{label}.primary_key_unique"))


def _measure_names(registry: Registry) -> tuple[list[str], list[str]]:
    """Every measure of any edition once: numbers, and texts."""
    names = list(dict.fromkeys(m for e in registry.editions for m in e.measures()))
    return [m for m in names if not m.endswith("_source_status")], [m for m in names if m.endswith("_source_status")]


def _packed(numbers: list, texts: list) -> Column:
    """A row's measures as two arrays, missing where they are, and a mark where a number is no number, so that it equals none."""
    number = lambda c: F.when(c.isNotNull(), F.coalesce(c.try_cast("double"), F.lit(float("nan"))))
    return F.struct(F.array(*[number(c) for c in numbers], F.lit(None).cast("double")).alias("n"),
                    F.array(*[c.cast("string") for c in texts], F.lit(None).cast("string")).alias("t"))


def paired(saved: DataFrame, service: DataFrame, gov: DataFrame, key: list[str], registry: Registry = REGISTRY, zone_column="DataZone{}Code") -> DataFrame:
    """(key, edition, dz_code, saved, source): a record's measures of an edition beside those of its zone, looked up again from the long
    tables, each packed into arrays in one order. One row a record and edition, whatever the number of measures."""
    numbers, texts = _measure_names(registry)
    none = F.lit(None).cast("string")
    own = lambda e, names: [F.col(e.column(m)) if e.publishes(m) else none for m in names]
    cells = [F.struct(F.lit(e.key).alias("edition"), F.col(zone_column.format(e.vintage)).alias("dz_code"), _packed(own(e, numbers), own(e, texts)).alias("saved"))
             for e in registry.editions]
    long = saved.select(*key, F.inline(F.array(*cells)))
    given = [m for m in numbers + texts if m in service.columns]
    more = [m for m in numbers + texts if m in gov.columns and m not in given]
    both = service.select("edition", "dz_code", *given).join(gov.select("edition", "dz_code", *more), ["edition", "dz_code"], "full_outer")
    # What an edition did not publish is no value of it, whatever a table holds there.
    shown = lambda m: F.when(F.col("edition").isin(*[e.key for e in registry.editions if e.publishes(m)]), F.col(m)) if m in given + more else none
    source = both.select("edition", "dz_code", _packed([shown(m) for m in numbers], [shown(m) for m in texts]).alias("source"))
    return long.join(source, ["edition", "dz_code"], "left")


def _cells(rows: DataFrame, key: list[str], registry: Registry, unequal_only: bool) -> DataFrame:
    """The measures of packed rows one by one: those that differ, or all that the edition published."""
    numbers, texts = _measure_names(registry)
    published = F.create_map(*[x for e in registry.editions for x in (F.lit(e.key), F.array(*[F.lit(m) for m in e.measures()]))])

    def side(part: str, names: list[str]) -> Column:
        listed = F.arrays_zip(F.array(*[F.lit(m) for m in names], F.lit(None).cast("string")).alias("m"), F.col(f"saved.{part}").alias("a"),
                              F.coalesce(F.col(f"source.{part}"), F.array()).alias("b"))
        keep = (lambda x: x["m"].isNotNull() & ~same(x["a"], x["b"])) if unequal_only else (lambda x: F.array_contains(F.col("_published"), x["m"]))
        return F.transform(F.filter(listed, keep), lambda x: F.struct(x["m"].alias("measure"), x["a"].cast("string").alias("saved"), x["b"].cast("string").alias("source"),
                                                                      same(x["a"], x["b"]).alias("same")))

    out = rows.where(~same("saved", "source")) if unequal_only else rows.withColumn("_published", published[F.col("edition")])
    return out.select(*key, "edition", "dz_code", F.inline(F.concat(side("n", numbers), side("t", texts))))


def unequal_cells(saved: DataFrame, service: DataFrame, gov: DataFrame, key: list[str], registry: Registry = REGISTRY, zone_column="DataZone{}Code") -> DataFrame:
    """(key, edition, dz_code, measure, saved, source) of every attached value that is not its source's, missing values being equal to
    missing ones. Rows equal as a whole are passed over; only cells that differ become rows."""
    return _cells(paired(saved, service, gov, key, registry, zone_column), key, registry, True).drop("same")


def traced(saved: DataFrame, service: DataFrame, gov: DataFrame, keys: DataFrame, key: list[str], registry: Registry = REGISTRY,
           zone_column="DataZone{}Code") -> DataFrame:
    """The record trace for any set of keys: (key, edition, dz_code, measure, saved, source, same)."""
    asked = saved.join(keys.select(*key).distinct(), key, "left_semi")
    return _cells(paired(asked, service, gov, key, registry, zone_column), key, registry, False)


def relookup_checks(saved: DataFrame, service: DataFrame, gov: DataFrame, key: list[str], registry: Registry = REGISTRY, label="readback") -> DataFrame:
    """Readback: every attached value equals its source, nulls equal to nulls."""
    return Checks(f"{label}.").equal("attached_values", F.count(F.lit(1)), 0).run(unequal_cells(saved, service, gov, key, registry))


def source_equal_checks(saved: DataFrame, index: DataFrame, key: list[str], label: str = "readback") -> DataFrame:
    """Readback: every index column of the saved table equals the index built from the sources."""
    value = [c for c in index.columns if c not in key]
    pack = lambda df, n: df.select(*key, F.struct(*value).alias(n))
    pairs = pack(saved, "a").join(pack(index, "b"), key, "full_outer")
    c = Checks(f"{label}.").zero("rows", F.col("a").isNull() | F.col("b").isNull())
    for v in value:
        c.zero(f"index.{v}", F.col("a").isNotNull() & F.col("b").isNotNull() & ~same(f"a.{v}", f"b.{v}"))
    return c.run(pairs)


def edition_measure(df: DataFrame, edition_column: str, measures: dict[str, str], registry: Registry = REGISTRY, source: str | None = None,
                    types: dict | None = None) -> DataFrame:
    """One edition's stored measures per row, chosen by the row's edition: output name -> measure. The
    choice is made once per row for all measures together, not once per measure. `types` are those of the
    outputs where `df` does not hold the measures of every edition."""
    at = (lambda c: F.col(f"{source}{c}")) if source else F.col
    types = dict(types or {})
    for e in registry.editions:
        for out, m in measures.items():
            name = f"{source or ''}{e.column(m)}"
            if e.publishes(m) and name in df.columns:
                types.setdefault(out, df.schema[name].dataType)
    def packed(e: Edition):
        return F.struct(*[(at(e.column(m)).cast(types[out]) if e.publishes(m) and f"{source or ''}{e.column(m)}" in df.columns
                           else F.lit(None).cast(types.get(out, "string"))).alias(out) for out, m in measures.items()])
    choice = None
    for e in registry.editions:
        test = F.col(edition_column) == e.key
        choice = F.when(test, packed(e)) if choice is None else choice.when(test, packed(e))
    return df.withColumn("_measures", choice).select("*", "_measures.*").drop("_measures")
