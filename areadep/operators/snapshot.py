"""Comparing two tables by key: what was added, removed and changed, and in which columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import Lives
from ..functions.values import same
from ..registry import REGISTRY, Registry
from .lives import latest_per_base

RELEASE_LABELS = ("spd_release", "sspl_release")


def compared_columns(before: DataFrame, after: DataFrame, key: list[str], ignore=RELEASE_LABELS) -> list[str]:
    return [c for c in after.columns if c in before.columns and c not in key and c not in ignore]


def _printed(df: DataFrame, other: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Rows with their range, the first bits of a hash of the key, and two prints of key and values. Types that differ between the tables are printed as text."""
    plain = lambda c: F.col(c) if df.schema[c].dataType == other.schema[c].dataType else F.col(c).cast("string")
    # A hash skips what is missing, so where that is belongs to the print.
    gaps = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    values = [plain(c) for c in [*key, *columns]]
    return df.select(*key, F.struct(*(columns or key)).alias("_row"), F.xxhash64(*[plain(c) for c in key]).alias("_h"),
                     F.xxhash64(*values, gaps).alias("_p1"), F.xxhash64(F.lit(7), *values, gaps).alias("_p2"))


def _ranges(printed: DataFrame, bits: int) -> DataFrame:
    """Rows and digests of each range of key hashes, whatever the order of rows; sums of prints, so that repeated rows do not cancel out."""
    at = F.shiftrightunsigned("_h", 64 - bits).alias("_range")
    exact = lambda p: F.sum(F.col(p).cast("decimal(20,0)"))
    return printed.groupBy(at).agg(F.count(F.lit(1)).alias("n"), exact("_p1").alias("d1"), exact("_p2").alias("d2"))


PER_RANGE = 64          # rows of a range, as a mean


def range_bits(n: int, per_range: int = PER_RANGE) -> int:
    """Bits of a hash that cut n rows into ranges of about `per_range`: the leaves of the tree of ranges."""
    return max(1, min(40, (max(n, 1) // per_range).bit_length()))


def unequal_ranges(before: DataFrame, after: DataFrame, bits: int) -> DataFrame:
    """(_range, n): ranges of printed tables that differ, with the rows of `before` in them."""
    named = lambda df, p: df.select("_range", *[F.col(c).alias(p + c) for c in ("n", "d1", "d2")])
    both = named(_ranges(before, bits), "b_").join(named(_ranges(after, bits), "a_"), "_range", "full_outer")
    alike = F.lit(True)
    for c in ("n", "d1", "d2"):
        alike = alike & F.col("b_" + c).eqNullSafe(F.col("a_" + c))
    return both.where(~alike).select("_range", F.coalesce("b_n", F.lit(0).cast("long")).alias("n"))


def compared(before: DataFrame, after: DataFrame, key: list[str], current: str | None = "is_current", ignore=RELEASE_LABELS, per_range: int = PER_RANGE) -> DataFrame:
    """One row: added, removed, common and changed records, records newly deleted, and per column how many values differ among common
    records, in all and among those current in both (`fields`, columns without a difference left out).

    Both tables are cut into ranges of a hash of the key and each range is digested, in partial sums; only rows of ranges whose digests
    differ are joined, once, for all figures together. Keys must be unique."""
    columns = compared_columns(before, after, key, ignore)
    old, new = _printed(before, after, key, columns), _printed(after, before, key, columns)
    n = before.count()
    bits = range_bits(n, per_range)
    differ = unequal_ranges(old, new, bits)
    at = F.shiftrightunsigned("_h", 64 - bits)
    some = lambda df, name: df.withColumn("_range", at).join(differ.select("_range"), "_range", "left_semi").select(*key, F.col("_row").alias(name))
    pairs = some(old, "old").join(some(new, "new"), key, "full_outer")
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    unlike = {c: ~same(f"old.{c}", f"new.{c}") for c in columns}
    changed = F.lit(False)
    for test in unlike.values():
        changed = changed | test
    flagged = current is not None and current in columns
    newly = (F.col(f"old.{current}") & ~F.col(f"new.{current}")) if flagged else F.lit(False)
    in_both = F.coalesce(F.col(f"old.{current}") & F.col(f"new.{current}"), F.lit(False)) if flagged else F.lit(False)
    counts = pairs.agg(
        F.count_if(F.col("old").isNull()).alias("added_records"), F.count_if(F.col("new").isNull()).alias("removed_records"),
        F.count_if(F.col("old").isNotNull()).alias("_seen"), F.count_if(both & changed).alias("changed_records"),
        F.count_if(both & F.coalesce(newly, F.lit(False))).alias("newly_deleted_records"),
        *[F.count_if(both & t).alias(f"_f{i}") for i, t in enumerate(unlike.values())], *[F.count_if(both & in_both & t).alias(f"_c{i}") for i, t in enumerate(unlike.values())])
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_f{i}").alias("changed"), F.col(f"_c{i}").alias("changed_current")) for i, c in enumerate(columns)])
    fields = F.filter(fields, lambda f: f["changed"] > 0) if columns else F.array().cast("array<struct<field:string,changed:bigint,changed_current:bigint>>")
    common = F.lit(n) - F.col("removed_records")
    return counts.select("added_records", "removed_records", common.alias("common_records"), "changed_records", "newly_deleted_records", fields.alias("fields"))


def snapshot_diff(before: DataFrame, after: DataFrame, key: list[str], current: str | None = "is_current", ignore=RELEASE_LABELS) -> DataFrame:
    """One row: added, removed, common and changed records, records newly deleted."""
    return compared(before, after, key, current, ignore).drop("fields")


def changed_fields(before: DataFrame, after: DataFrame, key: list[str], ignore=RELEASE_LABELS) -> DataFrame:
    """Differing values per column among common records, columns without a difference left out."""
    return compared(before, after, key, None, ignore).select(F.inline("fields")).select("field", "changed")


def column_changes(before: DataFrame, after: DataFrame) -> dict:
    return {"added_columns": sorted(set(after.columns) - set(before.columns)), "removed_columns": sorted(set(before.columns) - set(after.columns))}


def key_difference(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """One row: keys only left, only right, and in both."""
    l, r = left.select(*key).distinct().withColumn("_l", F.lit(1)), right.select(*key).distinct().withColumn("_r", F.lit(1))
    return l.join(r, key, "full_outer").agg(
        F.count_if(F.col("_r").isNull()).alias("only_left"), F.count_if(F.col("_l").isNull()).alias("only_right"),
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("both"))


def compare_with_previous(before: DataFrame | None, after: DataFrame, key: list[str], trusted: bool = True) -> DataFrame:
    """What changed since the table before: status and reason, the figures of `compared` with their fields, and the columns that came and
    went. Unavailable, with its reason, where there is no table before, its rows are not those that were published, or a key repeats."""
    spark = after.sparkSession
    unavailable = lambda why: spark.createDataFrame([("unavailable", why)], "status string, reason string")
    if before is None:
        return unavailable("no previous table")
    if not trusted:
        return unavailable("the previous table is not the one that was published")
    repeats = [df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(1) for df in (before, after)]
    if repeats[0].unionByName(repeats[1]).count():
        return unavailable("a key repeats")
    columns = column_changes(before, after)
    names = lambda c: F.array(*[F.lit(n) for n in columns[c]]).cast("array<string>").alias(c)
    return compared(before, after, key).select(F.lit("compared").alias("status"), F.lit(None).cast("string").alias("reason"), "*", names("added_columns"), names("removed_columns"))


# ---- two products at the same grain ----

AGREEMENT_PREFIXES = ("OutputArea", "DataZone", "IntermediateZone", "HealthBoardArea2019", "CouncilArea", "IntegrationAuthority")


def product_agreement(main: DataFrame, history: DataFrame, columns: list[str] | None = None, lives: Lives = Lives(),
                      registry: Registry = REGISTRY) -> DataFrame:
    """How far a table of whole latest keys agrees with a history reduced to the same grain, as
    (section, metric, value). Ties and B or C representatives are counted and not compared."""
    if columns is None:
        bands = [e.column(f) for e in registry.editions for f in ("pw_scotland_quintile", "pw_scotland_decile", "most15pc", "uw_scotland_quintile")]
        columns = [c for c in main.columns if c in history.columns and (c.startswith(AGREEMENT_PREFIXES) or c in bands)]
    latest = latest_per_base(history, lives, [c for c in columns if c not in (lives.start, lives.role, lives.current)])
    m = main.select(F.col(lives.key).alias("_k"), F.struct(*dict.fromkeys([lives.start, lives.current, lives.role, *columns])).alias("m"))
    h = latest.select(F.col(lives.base).alias("_b"), F.struct(*[c for c in latest.columns if c != lives.base]).alias("h"))
    pairs = m.join(h, F.col("_k") == F.col("_b"), "full_outer")
    shared = F.col("m").isNotNull() & F.col("h").isNotNull()
    in_status = lambda s: F.coalesce(F.col("h.comparison_status") == s, F.lit(False))
    resolved = shared & in_status("resolved")
    both_current = resolved & F.coalesce(F.col(f"m.{lives.current}") & F.col(f"h.{lives.current}"), F.lit(False))
    differ = lambda c: ~same(f"m.{c}", f"h.{c}")
    out = [("grain", "main_rows", F.count_if(F.col("m").isNotNull())), ("grain", "history_whole_postcodes", F.count_if(F.col("h").isNotNull())),
           ("grain", "shared", F.count_if(shared)), ("grain", "only_in_main", F.count_if(F.col("h").isNull())),
           ("grain", "only_in_history", F.count_if(F.col("m").isNull())),
           ("unresolved", "ambiguous_postcode", F.count_if(in_status("ambiguous_postcode"))),
           ("unresolved", "split_a_missing", F.count_if(in_status("split_a_missing"))),
           ("grain", "shared_resolved", F.count_if(resolved)), ("grain", "shared_and_current_in_both", F.count_if(both_current))]
    out += [("record", c, F.count_if(resolved & differ(c))) for c in (lives.start, lives.current, lives.role)]
    for c in columns:
        out += [("all", c, F.count_if(resolved & differ(c))), ("current", c, F.count_if(both_current & differ(c)))]
    counts = pairs.agg(*[v.alias(f"v{i}") for i, (_, _, v) in enumerate(out)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("section"), F.lit(n).alias("metric"), F.col(f"v{i}").alias("value")) for i, (s, n, _) in enumerate(out)])))
