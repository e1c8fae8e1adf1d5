"""CSV sources read as published: all text, declared header, blanks kept apart from nulls."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.keys import link_base, link_shape_ok, user_type, with_dates, with_keys
from ..operators.checks import Checks, header, identical_duplicates, static_check, union_checks, unique_key
from ..operators.profile import ambiguous_groups, classified_links, strict_overlaps
from ..registry import (CUBE_COLUMNS, LARGE_USER_HEADER, LOOKUP_HEADER, PUBLISHED_BANDS, PUBLISHED_FLAGS, REGISTRY,
                        SMALL_USER_HEADER, Edition, Registry)


def text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text under the file's own header; a blank cell is '' and nothing is NA."""
    raw = (spark.read.option("header", True).option("inferSchema", False).option("escape", '"').option("multiLine", False)
           .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return raw.na.fill("")


def pinned_list(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small list with # comment lines and a header."""
    return spark.read.schema(schema).option("header", True).option("comment", "#").csv(path)


def directory_file(spark: SparkSession, path: str, role: str, registry: Registry = REGISTRY, expected: list[str] | None = None,
                   rows: int | None = None, live: int | None = None) -> tuple[DataFrame, DataFrame]:
    """One directory file with its derived key, dates and provenance, and its check rows. Ill-formed
    keys and dates are counted and fail; nothing is repaired."""
    expected = list(expected or (SMALL_USER_HEADER if role == "small_user" else LARGE_USER_HEADER))
    raw = text_csv(spark, path)
    label = f"spd.{role}"
    shape = header(raw, expected, f"{label}.schema")
    if list(raw.columns) != expected:
        return raw, shape
    full = with_dates(with_keys(raw, role)).withColumns({"spd_user_type": F.lit(role), "spd_release": F.lit(registry.history_release)})
    c = Checks(f"{label}.").zero("keys_well_formed", ~F.col("key_ok")).zero("dates_well_formed", ~F.col("dates_ok"))
    c.rows(rows) if rows is not None else c.observe("rows", F.count(F.lit(1)))
    current = F.count_if("is_current")
    c.equal("live", current, live) if live is not None else c.observe("live", current)
    c.observe("same_day", F.count_if(F.coalesce(F.col("introduced_on") == F.col("deleted_on"), F.lit(False))))
    c.observe("split_records", F.count_if(F.col("SplitIndicator") == "Y"))
    if "NeverDigitised" in raw.columns:
        c.observe("live_never_digitised", F.count_if(F.col("is_current") & (F.col("NeverDigitised") == "Y")))
    report = union_checks(shape, c.run(full), identical_duplicates(raw, f"{label}.identical_duplicates"))
    return full.drop("key_ok", "dates_ok"), report


def history_index(small: DataFrame, large: DataFrame, registry: Registry = REGISTRY, totals: tuple[int, int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Both files under one another. A column one file lacks is null there; a blank stays blank. The
    check rows cover what only both together can show."""
    derived = ["pc_norm", "pc_base", "spd_user_type", "spd_release", "introduced_on", "deleted_on", "is_current"]
    source = [c for c in small.columns if c not in derived]
    source += [c for c in large.columns if c not in derived and c not in source]
    both = small.unionByName(large, allowMissingColumns=True).select(*source, *derived)
    c = Checks("spd.").required(["pc_norm", "introduced_on"], "primary_key_nonnull")
    for name, value in zip(("total_all", "total_live", "total_deleted"), totals or (None, None, None)):
        actual = {"total_all": F.count(F.lit(1)), "total_live": F.count_if("is_current"), "total_deleted": F.count_if(~F.col("is_current"))}[name]
        c.equal(name, actual, value) if value is not None else c.observe(name, actual)
    for v in registry.vintages():
        c.zero(f"dz{v}.blanks", F.col(f"DataZone{v}Code") == "")
    links = classified_links(large, small.select("pc_norm"), "LinkedSmallUserPostcode")
    current = both.where("is_current")
    zones = [static_check(both.sparkSession, f"spd.dz{v}.present", f"DataZone{v}Code" in both.columns, True) for v in registry.vintages()]
    ambiguous = [Checks(f"spd.dz{v}.").observe("ambiguous_bases", F.max("ambiguous")).run(ambiguous_groups(current, "pc_base", f"DataZone{v}Code"))
                 for v in registry.vintages()]
    report = union_checks(
        c.run(both), unique_key(both, ["pc_norm", "introduced_on"], "spd.primary_key_unique"), unique_key(current, ["pc_norm"], "spd.current_unique_nrs"),
        Checks("spd.").equal("strict_overlaps", F.coalesce(F.sum("overlaps"), F.lit(0)), 0).run(strict_overlaps(both)),
        Checks("spd.").zero("unresolved_real_links", F.col("link_class") == "unresolved").run(links), *zones, *ambiguous)
    return both, report


def latest_lookup(spark: SparkSession, path: str, registry: Registry = REGISTRY, expected: list[str] | None = None, rows: int | None = None,
                  live: int | None = None, small: int | None = None, large: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The lookup of whole latest keys with its derived columns, and its check rows."""
    expected = list(expected or LOOKUP_HEADER)
    raw = text_csv(spark, path)
    shape = header(raw, expected, "sspl.schema")
    if list(raw.columns) != expected:
        return raw, shape
    full = with_dates(with_keys(raw, "lookup")).withColumns({"spd_user_type": user_type("PostcodeType"), "sspl_release": F.lit(registry.lookup_release)})
    is_large = F.col("spd_user_type") == "large_user"
    link = F.col("LinkedSmallUserPostcode")
    c = Checks("sspl.").zero("keys_well_formed", ~F.col("key_ok")).zero("dates_well_formed", ~F.col("dates_ok"))
    c.zero("postcode_type", F.col("spd_user_type").isNull())
    c.zero("link_values_valid", is_large & ~link_shape_ok(link)).zero("small_user_links_blank", ~is_large & (link != ""))
    wanted = {"rows": (F.count(F.lit(1)), rows), "live": (F.count_if("is_current"), live), "small_user": (F.count_if(~is_large), small), "large_user": (F.count_if(is_large), large)}
    for name, (actual, value) in wanted.items():
        c.equal(name, actual, value) if value is not None else c.observe(name, actual)
    c.observe("introduced_first", F.min("introduced_on")).observe("introduced_last", F.max("introduced_on"))
    for v in registry.vintages():
        c.zero(f"dz{v}.blanks", F.col(f"DataZone{v}Code") == "")
    links = classified_links(full.where(is_large), full.where(~is_large).select("pc_norm"), "LinkedSmallUserPostcode",
                             link_base("LinkedSmallUserPostcode"), "small_user_target_not_found")
    suffix = F.col("link_class").isin("linked", "small_user_target_not_found") & (F.length(link_base(link)) < F.length(F.replace(link, F.lit(" "), F.lit(""))))
    o = Checks("sspl.links.").observe("linked", F.count_if(F.col("link_class") == "linked"))
    o.observe("not_found", F.count_if(F.col("link_class") == "small_user_target_not_found")).observe("with_split_suffix", F.count_if(suffix))
    report = union_checks(shape, c.run(full), identical_duplicates(raw, "sspl.identical_duplicates"), unique_key(full, ["pc_norm"], "sspl.primary_key_unique"), o.run(links))
    columns = [*expected, "pc_norm", "spd_user_type", "sspl_release", "introduced_on", "deleted_on", "is_current"]
    return full.select(*columns), report


def service_edition(spark: SparkSession, path: str, ed: Edition) -> tuple[DataFrame, DataFrame]:
    """One published edition file, numbers typed (a bad number stops the job), and its check rows."""
    from ..operators.bands import source_checks
    raw = text_csv(spark, path)
    numbers = [ed.prefix + s for s in ("Rank", *PUBLISHED_BANDS, *PUBLISHED_FLAGS)]
    shape = header(raw, [*ed.zone_columns, *numbers], f"phs.{ed.key}.source.schema")
    if list(raw.columns) != [*ed.zone_columns, *numbers]:
        return raw, shape
    typed = raw.select(*ed.zone_columns, *[F.col(n).cast("long").alias(n) for n in numbers])
    return typed, union_checks(shape, source_checks(typed, ed))


def band_cube(spark: SparkSession, path: str) -> DataFrame:
    """The long file of published bands. Several editions read it, so it is kept."""
    types = {"DateCode": "int", "Value": "double"}
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in CUBE_COLUMNS)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path).persist()


def pinned_files(spark: SparkSession, root: str, pins: DataFrame) -> DataFrame:
    """Every declared file (path, sha256) with whether it is present with its hash. Files are hashed
    where they are read, one task a file."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    # What stands behind the folder's name; the scan may put a scheme before it.
    base = re.sub(r"^[a-z0-9]+:(//[^/]*)?", "", root).rstrip("/") + "/"
    relative = F.expr("substring(path, locate(_base, path) + length(_base))")
    hashed = found.withColumn("_base", F.lit(base)).select(relative.alias("path"), F.sha2("content", 256).alias("found_sha256"))
    out = pins.join(hashed, "path", "left")
    return out.select("path", "sha256", "found_sha256", F.col("found_sha256").isNotNull().alias("present"),
                      F.coalesce(F.col("sha256") == F.col("found_sha256"), F.lit(False)).alias("verified"))
