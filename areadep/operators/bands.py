"""Edition tables: published bands turned one way, checked, and admitted from the long band cube."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.values import half_unit, turned, whole
from ..registry import (BAND_WIDTH, CUBE_DOMAINS, CUBE_MEASUREMENTS, PUBLISHED_BANDS, PUBLISHED_FLAGS, RANK_SOURCES_DISAGREE,
                        UNWEIGHTED, Edition)
from .checks import Checks, count_if, static_check, union_checks, unique_key, values_within
from .ordered import falls
from .profile import split_ties, tied_values

SCOPE_COLUMN = {"scotland": None, "hb": "hb", "hscp": "hscp", "ca": "ca"}
UNWEIGHTED_WIDTH = {"uw_scotland_quintile": 5, "uw_scotland_decile": 10, "uw_scotland_vigintile": 20}


def band_width(name: str) -> int:
    return BAND_WIDTH[name.rsplit("_", 1)[-1]]


def canonical(source: DataFrame, ed: Edition) -> DataFrame:
    """The edition table: canonical names, bands with 1 as most deprived; ranks and flags untouched."""
    p = ed.prefix
    return source.select(
        F.lit(ed.key).alias("edition"), F.lit(ed.vintage).alias("dz_vintage"), F.col("DataZone").alias("dz_code"),
        F.col("HB").alias("hb"), F.col("HSCP").alias("hscp"), F.col("CA").alias("ca"), F.col(f"{p}Rank").alias("rank"),
        *[turned(f"{p}{src}", band_width(name), ed.invert_bands).alias(name) for src, name in PUBLISHED_BANDS.items()],
        *[F.col(f"{p}{src}").alias(name) for src, name in PUBLISHED_FLAGS.items()])


def source_checks(source: DataFrame, ed: Edition) -> DataFrame:
    """A published edition file as read: rows, key, blanks, dense rank, band and flag ranges."""
    p = ed.prefix
    c = Checks(f"phs.{ed.key}.source.").rows(ed.rows).dense_rank(f"{p}Rank", ed.rows).blanks([n for n in ed.zone_columns])
    for src, name in PUBLISHED_BANDS.items():
        c.between(f"{p}{src}", 1, band_width(name))
    for src in PUBLISHED_FLAGS:
        c.binary(f"{p}{src}")
    return union_checks(c.run(source), unique_key(source, ["DataZone"], f"phs.{ed.key}.source.key_unique"))


def monotone_checks(table: DataFrame, bands: list[str], label: str, scope=None) -> DataFrame:
    """No band falls as the rank rises, within the geography the band was cut in. All bands of one
    geography are stacked and checked in one job."""
    by_scope: dict = {}
    for b in bands:
        by_scope.setdefault(scope(b) if scope else None, []).append(b)
    reports = []
    for column, names in by_scope.items():
        group = F.col(column) if column else F.lit("all")
        stacked = table.select(group.alias("_group"), "rank", F.inline(F.array(*[
            F.struct(F.lit(n).alias("_name"), F.col(n).alias("_band")) for n in names])))
        counts = falls(stacked, ["_name", "_group"], "rank", "_band")
        c = Checks(f"{label}.")
        for n in names:
            c.equal(f"{n}.monotone", F.coalesce(F.sum(F.when(F.col("_name") == n, F.col("falls"))), F.lit(0)), 0)
        reports.append(c.run(counts))
    return union_checks(*reports)


def canonical_checks(table: DataFrame, ed: Edition) -> DataFrame:
    """Direction of every band, and the most and least deprived zones as anchors."""
    bands, flags = list(PUBLISHED_BANDS.values()), list(PUBLISHED_FLAGS.values())
    first = lambda c: F.min_by(c, "rank")
    last = lambda c: F.max_by(c, "rank")
    c = Checks(f"phs.{ed.key}.")
    c.equal("flag_anchors", F.concat_ws(",", first(flags[0]), first(flags[1]), last(flags[0]), last(flags[1])), "1,0,0,1")
    c.equal("rank1_in_band1", F.concat_ws(",", *[first(b) for b in bands]), ",".join("1" for _ in bands))
    mono = monotone_checks(table, bands, f"phs.{ed.key}", lambda b: SCOPE_COLUMN[b.split("_")[1]])
    return union_checks(c.run(table), mono)


def government(attributes: DataFrame, ed: Edition) -> DataFrame:
    """The government edition table from its attribute table, declared columns by name."""
    c = ed.columns
    return attributes.select(
        F.lit(ed.key).alias("edition"), F.lit(ed.vintage).alias("dz_vintage"), F.col(c["datazone"]).cast("string").alias("dz_code"),
        F.col(c["rank"]).cast("long").alias("rank"),
        *[F.col(c[name.rsplit("_", 1)[-1]]).cast("long").alias(name) for name in UNWEIGHTED],
        F.col(c["population"]).cast("long").alias("population"),
        *[F.col(ed.domain_columns[d]).cast("double").alias(f"{d}_domain_rank") for d in ed.domains])


def government_source_checks(attributes: DataFrame, ed: Edition) -> DataFrame:
    """Before any cast: declared columns present, numbers whole, domain ranks complete half units in range."""
    label = f"govscot.{ed.key}"
    declared = [*ed.columns.values(), *ed.domain_columns.values()]
    missing = [c for c in declared if c not in attributes.columns]
    present = static_check(attributes.sparkSession, f"{label}.columns_present", missing, [])
    if missing:
        return present
    c = Checks(f"{label}.").rows(ed.rows)
    for kind, name in ed.columns.items():
        if kind != "datazone":
            c.zero(f"{kind}.integral", ~whole(name))
    for d in ed.domains:
        v = F.col(ed.domain_columns[d]).cast("double")
        c.zero(f"{d}_domain.complete", v.isNull()).zero(f"{d}_domain.half_units", v.isNotNull() & ~half_unit(v))
        c.zero(f"{d}_domain.range", ~v.between(1, ed.rows))
    return union_checks(present, c.run(attributes))


def government_checks(table: DataFrame, ed: Edition) -> DataFrame:
    label = f"govscot.{ed.key}"
    c = Checks(f"{label}.").dense_rank("rank", ed.rows).zero("population_nonnegative", F.col("population") < 0)
    for name, k in UNWEIGHTED_WIDTH.items():
        c.between(name, 1, k)
    ties = [Checks(f"{label}.").observe(f"{d}_domain.tied_values", F.max("tied_values")).run(tied_values(table, f"{d}_domain_rank"))
            for d in ed.domains]
    return union_checks(c.run(table), unique_key(table, ["dz_code"], f"{label}.key_unique"),
                        monotone_checks(table, list(UNWEIGHTED_WIDTH), label), *ties)


# ---- the long band cube ----

def domain_name(column="SIMD Domain"):
    c = F.col(f"`{column}`")
    return F.create_map(*[F.lit(x) for kv in CUBE_DOMAINS.items() for x in kv])[c]


def cube_of(cube: DataFrame, ed: Edition) -> DataFrame:
    """One edition's rows of the long cube with their domain."""
    return cube.where(F.col("DateCode") == ed.cube_year).withColumn("domain", domain_name())


def pivoted(rows: DataFrame) -> DataFrame:
    """One row per zone and domain: Rank, Quintile, Decile, Vigintile."""
    return (rows.groupBy(F.col("FeatureCode").alias("dz_code"), "domain").pivot("Measurement", list(CUBE_MEASUREMENTS))
            .agg(F.first("Value")))


def cube_checks(cube: DataFrame, ed: Edition, years: list[int] | None = None) -> DataFrame:
    label = f"govscot.{ed.key}.bands"
    rows = cube_of(cube, ed)
    return union_checks(
        values_within(cube, "DateCode", years or [ed.cube_year], f"{label}.years"),
        values_within(rows, "FeatureType", [f"{ed.vintage} Data Zone"], f"{label}.feature_type"),
        values_within(rows, "Measurement", list(CUBE_MEASUREMENTS), f"{label}.measurements"),
        values_within(rows.where(F.col("domain").isNotNull()), "domain", [*ed.domains, "overall"], f"{label}.domains"),
        Checks(f"{label}.").zero("domain_names_known", F.col("domain").isNull()).run(rows),
        unique_key(rows, ["FeatureCode", "SIMD Domain", "Measurement"], f"{label}.unique"))


def rank_pairs(table: DataFrame, wide: DataFrame, domains: list[str]) -> DataFrame:
    """Zone and domain with our rank and the published row, unmatched sides kept."""
    ours = table.select("dz_code", F.inline(F.array(*[
        F.struct(F.lit(d).alias("domain"), F.col("rank" if d == "overall" else f"{d}_domain_rank").cast("double").alias("ours"),
                 *[F.col(f"uw_scotland_{b}").cast("double").alias(f"our_{b}") for b in BAND_WIDTH]) for d in domains])))
    published = wide.where(F.col("domain").isin(*domains)).withColumn("_published", F.lit(1))
    return ours.join(published, ["dz_code", "domain"], "full_outer")


def rank_disagreements(pairs: DataFrame, half_ranks: str) -> DataFrame:
    """Zones whose published rank is another one, declared half-rank rounding aside."""
    ours, theirs = F.col("ours"), F.col("Rank").cast("double")
    rounded = (F.pmod(ours, F.lit(1.0)) == 0.5) & (theirs == ours + 0.5) if half_ranks == "rounded_up" else F.lit(False)
    differ = ours.isNotNull() & theirs.isNotNull() & (ours != theirs) & ~rounded & (F.col("domain") != "overall")
    return pairs.where(differ).select("dz_code", "domain", ours.alias("shapefile_rank"), theirs.alias("published_rank"))


def pinned_match(found: DataFrame, pinned: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Zones found and zones pinned side by side, with whether each pair is the same."""
    pack = lambda df, n: df.select(*keys, F.struct(*values).alias(n))
    both = pack(found, "found").join(pack(pinned, "pinned"), keys, "full_outer")
    return both.withColumn("as_pinned", F.col("found").eqNullSafe(F.col("pinned")))


def admit_bands(table: DataFrame, cube: DataFrame, ed: Edition, pinned: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The edition table with its published domain bands, and the check rows of their admission.
    pinned: domain, dz_code, shapefile_rank, published_rank of the declared disagreements."""
    label = f"govscot.{ed.key}.bands"
    domains = ["overall", *ed.domains]
    wide = pivoted(cube_of(cube, ed))
    pairs = rank_pairs(table, wide, domains)
    found = rank_disagreements(pairs, ed.half_ranks)
    spark = table.sparkSession
    pinned = pinned if pinned is not None else spark.createDataFrame([], "domain string, dz_code string, shapefile_rank double, published_rank double")
    match = pinned_match(found, pinned, ["domain", "dz_code"], ["shapefile_rank", "published_rank"])

    c = Checks(f"{label}.").zero("zones", F.col("ours").isNull() | F.col("_published").isNull()).zero("rank.present", F.col("Rank").isNull())
    for b, k in BAND_WIDTH.items():
        v = F.col(b.capitalize()).cast("double")
        c.zero(f"{b}.whole", ~whole(v)).zero(f"{b}.range", ~F.coalesce(v.between(1, k), F.lit(False)))
        c.zero(f"overall.{b}_agrees", (F.col("domain") == "overall") & ~v.eqNullSafe(F.col(f"our_{b}")))
    c.zero("overall.rank_agrees", (F.col("domain") == "overall") & ~F.col("Rank").cast("double").eqNullSafe(F.col("ours")))
    stacked = wide.select("domain", F.col("Rank").alias("rank"), F.inline(F.array(*[
        F.struct(F.lit(b).alias("_name"), F.col(b.capitalize()).alias("_band")) for b in BAND_WIDTH])))
    mono = Checks(f"{label}.").equal("monotone", F.coalesce(F.sum("falls"), F.lit(0)), 0).run(falls(stacked, ["domain", "_name"], "rank", "_band"))
    ties = Checks(f"{label}.").observe("split_ties", F.sum("split_ties")).run(split_ties(stacked, ["domain", "_name"], "rank", "_band"))
    as_pinned = Checks(f"{label}.").zero("rank_disagreements_as_pinned", ~F.col("as_pinned")).run(match)
    report = union_checks(c.run(pairs), mono, ties, as_pinned)

    bands = wide.where(F.col("domain") != "overall").groupBy("dz_code").agg(*[
        F.max(F.when(F.col("domain") == d, F.col(b.capitalize()))).cast("long").alias(f"{d}_domain_{b}") for d in ed.domains for b in BAND_WIDTH])
    out = table.join(bands, "dz_code", "left")
    for d in ed.status_domains:
        flagged = pinned.where(F.col("domain") == d).select("dz_code", F.lit(RANK_SOURCES_DISAGREE).alias(f"{d}_domain_rank_source_status"))
        out = out.join(flagged.distinct(), "dz_code", "left")
    return out, report


def cross_publisher(service: DataFrame, gov: DataFrame) -> DataFrame:
    """Both publishers describe the same zones with the same ranks, per edition, as check rows."""
    a = service.select("edition", "dz_code", F.col("rank").alias("_a"))
    b = gov.select("edition", "dz_code", F.col("rank").alias("_b"))
    pairs = a.join(b, ["edition", "dz_code"], "full_outer")
    return Checks("cross.").zero("same_zones", F.col("_a").isNull() | F.col("_b").isNull()).zero(
        "rank_identical", F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("_a") != F.col("_b"))).run(pairs)


def shared_geography(service: DataFrame) -> DataFrame:
    """Editions of one vintage give a zone the same three areas and have the same zones."""
    areas = F.struct("hb", "hscp", "ca")
    editions = service.groupBy("dz_vintage").agg(F.count_distinct(F.col("edition")).alias("_n"))
    per = service.groupBy("dz_vintage", "dz_code").agg(F.min(areas).alias("_lo"), F.max(areas).alias("_hi"), F.count_distinct(F.col("edition")).alias("_in"))
    return Checks("phs.geography.").zero("agrees", F.col("_lo") != F.col("_hi")).zero("same_zones", F.col("_in") != F.col("_n")).run(
        per.join(editions, "dz_vintage"))
