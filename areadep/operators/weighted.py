"""Population-weighted bands of a rank, exact and for any number of groups at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..registry import WEIGHTED_WIDTH, Edition
from .checks import Checks, union_checks
from .ordered import running_total
from .skew import lookup_join


def weighted_blocks(df: DataFrame, groups: list[str], rank: str, population: str) -> DataFrame:
    """One row per group and rank with its population, the population up to it and the group's total.
    Missing or negative values and an empty population stop the job."""
    bad = F.col(rank).isNull() | F.col(population).isNull() | (F.col(population) < 0)
    people = F.when(bad, F.raise_error(F.lit("ranks and populations must be complete, and populations not negative"))).otherwise(F.col(population))
    blocks = df.groupBy(*groups, rank).agg(F.sum(people.cast("long")).alias("_block"))
    blocks = running_total(blocks, groups, rank, "_block", "_upto")
    # One row a group: a hot group's total reaches its rows without gathering them.
    joined = lookup_join(blocks, blocks.groupBy(*groups).agg(F.sum("_block").alias("_total")), groups)
    empty = F.when(F.col("_total") <= 0, F.raise_error(F.lit("a total population of zero has nothing to weight by"))).otherwise(F.col("_total"))
    return joined.withColumn("_total", empty.cast("long"))


def band_at(width: int):
    """Band of a block's population midpoint, in whole numbers: ceil((2 upto - block) k / 2 total)."""
    return F.expr(f"cast(greatest(1, least({width}, ((2 * _upto - _block) * {width} + 2 * _total - 1) div (2 * _total))) as int)")


def population_bands(df: DataFrame, groups: list[str], rank: str, population: str, bands: dict[str, int]) -> DataFrame:
    """Each row with its band per name in `bands` (name -> number of bands). Equal ranks share a band."""
    work, keys = df, list(groups)
    if not keys:
        work, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    blocks = weighted_blocks(work, keys, rank, population)
    cut = blocks.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col(rank).alias("_b_rank"), *[band_at(k).alias(n) for n, k in bands.items()])
    on = F.col(rank) == F.col("_b_rank")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_b_{k}"))
    return work.join(cut, on, "left").select(*df.columns, *bands)


def with_domain_bands(government: DataFrame, edition: Edition) -> DataFrame:
    """One edition's table with the computed quintile and decile of every published domain. All domains
    are cut in one job: ranks are stacked, cut and turned back."""
    domains = [d for d in edition.domains if f"{d}_domain_rank" in government.columns]
    stacked = government.select("dz_code", "population", F.inline(F.array(*[
        F.struct(F.lit(d).alias("domain"), F.col(f"{d}_domain_rank").alias("rank")) for d in domains])))
    cut = population_bands(stacked, ["domain"], "rank", "population", WEIGHTED_WIDTH)
    wide = cut.groupBy("dz_code").agg(*[
        F.max(F.when(F.col("domain") == d, F.col(b))).alias(f"{d}_domain_pw_scotland_{b}") for d in domains for b in WEIGHTED_WIDTH])
    return government.join(wide, "dz_code", "left")


def reproduces_published(service: DataFrame, government: DataFrame, edition: str) -> DataFrame:
    """The rule against the published overall bands, on every zone, as check rows."""
    both = service.select("dz_code", "rank", *[F.col(f"pw_scotland_{b}").alias(f"published_{b}") for b in WEIGHTED_WIDTH]).join(
        government.select("dz_code", "population"), "dz_code")
    mine = population_bands(both, [], "rank", "population", {f"mine_{b}": k for b, k in WEIGHTED_WIDTH.items()})
    c = Checks(f"weighted.{edition}.")
    for b in WEIGHTED_WIDTH:
        c.zero(f"reproduces_phs_scotland_{b}", ~F.col(f"mine_{b}").eqNullSafe(F.col(f"published_{b}")))
    left, right = service.select("dz_code", F.lit(1).alias("_s")), government.select(F.col("dz_code"), F.lit(1).alias("_g"))
    zones = left.join(right, "dz_code", "full_outer")
    return union_checks(c.run(mine), Checks(f"weighted.{edition}.").zero("zones", F.col("_s").isNull() | F.col("_g").isNull()).run(zones))


def share_deviation(df: DataFrame, groups: list[str], band: str, population: str, width: int, name: str = "max_share_deviation_pp") -> DataFrame:
    """Per group: the largest distance of a band's population share from an equal share, in points."""
    per = df.groupBy(*groups, band).agg(F.sum(population).alias("_p"))
    total = per.groupBy(*groups).agg(F.sum("_p").alias("_total"), F.max("_p").alias("_most"), F.min("_p").alias("_least"))
    share = lambda c: F.abs(F.col(c) / F.col("_total") * 100 - F.lit(100 / width))
    return total.select(*groups, F.round(F.greatest(share("_most"), share("_least")), 4).alias(name))
