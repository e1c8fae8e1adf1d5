"""Profiles of a directory: counts, group sizes, intervals that touch or overlap, links.

Pairs of lives are never listed to be counted. Lives are first counted by key and day, and the pairs
follow from the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.keys import Lives, link_class, normalised
from ..registry import LINK_SENTINELS
from .checks import count_if


def directory_profile(df: DataFrame, lives: Lives = Lives(), split_flag: str | None = "SplitIndicator") -> DataFrame:
    """One row of conditional counts, all from one pass."""
    more = {"split_records": F.count_if(F.col(split_flag) == "Y")} if split_flag in df.columns else {}
    if "NeverDigitised" in df.columns:
        more["live_never_digitised"] = count_if(F.col(lives.current) & (F.col("NeverDigitised") == "Y"))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(lives.current).alias("live"), F.count_if(~F.col(lives.current)).alias("deleted"),
        count_if(F.col(lives.role) == "small_user").alias("small_user"), count_if(F.col(lives.role) == "large_user").alias("large_user"),
        count_if(F.col(lives.start) == F.col(lives.end)).alias("same_day"),
        F.min(lives.start).alias("first_introduced"), F.max(lives.start).alias("last_introduced"),
        *[v.alias(k) for k, v in more.items()])


def value_counts(df: DataFrame, column, name: str = "value") -> DataFrame:
    return df.groupBy((F.col(column) if isinstance(column, str) else column).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def group_sizes(df: DataFrame, key: str, at_least: int = 2) -> DataFrame:
    """How many keys have each number of rows."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= at_least)
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n_keys"))


def repeats(df: DataFrame, key: str) -> DataFrame:
    """Keys held more than once, and the most rows one key has."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.count_if(F.col("_n") > 1).alias("repeated_keys"), F.coalesce(F.max("_n"), F.lit(0)).alias("max_repeats"))


def ambiguous_groups(df: DataFrame, key: str, column: str) -> DataFrame:
    """Number of keys with more than one distinct value."""
    spread = df.groupBy(key).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    return spread.agg(F.count_if(F.coalesce(F.col("_lo") != F.col("_hi"), F.lit(False))).alias("ambiguous"))


def tied_values(df: DataFrame, column: str) -> DataFrame:
    """Values shared by more than one row."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("tied_values"))


def split_ties(df: DataFrame, groups: list[str], rank: str, band: str) -> DataFrame:
    """Ranks whose rows straddle bands."""
    per = df.groupBy(*groups, rank).agg(F.min(band).alias("_lo"), F.max(band).alias("_hi"))
    return per.groupBy(*groups).agg(F.count_if(F.col("_lo") != F.col("_hi")).alias("split_ties"))


# ---- intervals ----

def touching_pairs(df: DataFrame, lives: Lives = Lives()) -> DataFrame:
    """The pairs where one life of a key ends on the day another starts: a row each."""
    a = df.where(F.col(lives.end).isNotNull()).alias("a")
    b = df.alias("b")
    same_day = (F.col(f"a.{lives.key}") == F.col(f"b.{lives.key}")) & (F.col(f"a.{lives.end}") == F.col(f"b.{lives.start}"))
    # A same-day record meets a life that starts that day, but not itself.
    itself = (F.col(f"a.{lives.start}") == F.col(f"b.{lives.start}")) & F.col(f"a.{lives.end}").eqNullSafe(F.col(f"b.{lives.end}"))
    return a.join(b, same_day & ~itself).select(
        F.col(f"a.{lives.key}").alias(lives.key), F.col(f"a.{lives.start}").alias("first_start"), F.col(f"a.{lives.end}").alias("meets_on"),
        F.col(f"b.{lives.end}").alias("second_end"), F.col(f"a.{lives.role}").alias("first_role"), F.col(f"b.{lives.role}").alias("second_role"))


def touching_transitions(df: DataFrame, lives: Lives = Lives()) -> DataFrame:
    """Touching pairs counted by the two roles, first:second. Ends times starts of a key and day,
    less each same-day life meeting itself."""
    ends = (df.where(F.col(lives.end).isNotNull()).groupBy(F.col(lives.key).alias("k"), F.col(lives.end).alias("d"), F.col(lives.role).alias("ra"))
            .agg(F.count(F.lit(1)).alias("n_end"), F.count_if(F.col(lives.start) == F.col(lives.end)).alias("n_self")))
    begins = (df.groupBy(F.col(lives.key).alias("k"), F.col(lives.start).alias("d"), F.col(lives.role).alias("rb"))
              .agg(F.count(F.lit(1)).alias("n_start")))
    pairs = F.col("n_end") * F.col("n_start") - F.when(F.col("ra").eqNullSafe(F.col("rb")), F.col("n_self")).otherwise(0)
    met = ends.join(begins, ["k", "d"])
    return (met.groupBy(F.concat_ws(":", "ra", "rb").alias("transition")).agg(F.sum(pairs).alias("pairs"))
            .where(F.col("pairs") > 0))


def strict_overlaps(df: DataFrame, lives: Lives = Lives(), by: list[str] | None = None) -> DataFrame:
    """Overlapping pairs of lives of one key; lives without a day are ignored. On each day of a key, the
    lives starting meet every life still open and one another."""
    keys = by or [lives.key]
    rows = df.where(F.col(lives.end).isNull() | (F.col(lives.start) < F.col(lives.end)))
    days = rows.select(*keys, F.inline(F.array(
        F.struct(F.col(lives.start).alias("d"), F.lit(1).alias("s"), F.lit(0).alias("e")),
        F.struct(F.col(lives.end).alias("d"), F.lit(0).alias("s"), F.lit(1).alias("e"))))).where(F.col("d").isNotNull())
    days = days.groupBy(*keys, "d").agg(F.sum("s").alias("s"), F.sum("e").alias("e"))
    order = W.partitionBy(*keys).orderBy("d")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    still_open = F.coalesce(F.sum("s").over(before), F.lit(0)) - F.sum("e").over(upto)
    pairs = F.col("s") * still_open + F.expr("s * (s - 1) div 2")
    return days.select(*keys, pairs.alias("_p")).groupBy(*keys).agg(F.sum("_p").alias("overlaps")).where(F.col("overlaps") > 0)


def overlapping_lives(df: DataFrame, lives: Lives = Lives()) -> DataFrame:
    """Lives that start before an earlier life of their key has ended (running latest end per key)."""
    far = F.coalesce(F.col(lives.end), F.lit("9999-12-31").cast("date"))
    rows = df.where(F.col(lives.end).isNull() | (F.col(lives.start) < F.col(lives.end)))
    earlier = W.partitionBy(lives.key).orderBy(lives.start).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("_reach", F.max(far).over(earlier)).where(F.col("_reach") > F.col(lives.start)).drop("_reach")


# ---- links ----

def classified_links(df: DataFrame, small_keys: DataFrame, link: str, key_of_link=None, unresolved: str = "unresolved") -> DataFrame:
    """Each record with link_class: a sentinel, linked to a known small-user key, or unresolved.
    small_keys has one column of keys."""
    name = small_keys.columns[0]
    known = small_keys.select(F.col(name).alias("_known")).distinct()
    target = key_of_link if key_of_link is not None else normalised(link)
    # Sentinels and blanks link to nothing and may be most of the rows: each is spread over the shuffle under a key that no record has.
    nowhere = F.col(link).isin(*LINK_SENTINELS) | F.coalesce(target == "", F.lit(True))
    spread = F.when(nowhere, F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string"))).otherwise(target)
    joined = df.withColumn("_t", spread).join(known, F.col("_t") == F.col("_known"), "left")
    return joined.withColumn("link_class", link_class(link, F.col("_known").isNotNull(), unresolved)).drop("_t", "_known")


def build_figures(history: DataFrame, lives: Lives = Lives()) -> DataFrame:
    """Summary figures of a built table as (section, metric, value): totals, user types, key lengths and links."""
    totals = directory_profile(history, lives).selectExpr(
        "stack(6, 'totals', 'all', n_rows, 'totals', 'live', live, 'totals', 'deleted', deleted, 'user_type', 'small_user', small_user,"
        " 'user_type', 'large_user', large_user, 'totals', 'same_day', same_day) as (section, metric, value)")
    lengths = value_counts(history, F.length(lives.key), "metric").select(
        F.lit("key_length").alias("section"), F.col("metric").cast("string").alias("metric"), F.col("n").alias("value"))
    small = history.where(F.col(lives.role) == "small_user").select(lives.key)
    links = classified_links(history.where(F.col(lives.role) == "large_user"), small, lives.link)
    links = value_counts(links, "link_class", "metric").select(F.lit("links").alias("section"), "metric", F.col("n").alias("value"))
    return totals.unionByName(lengths).unionByName(links)
