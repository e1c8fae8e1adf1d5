"""Cases at the edges of every band, with a record to look each one up by."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import Lives
from ..operators.bands import turned
from ..registry import LINK_SENTINELS, REGISTRY, Registry

CASE_BANDS = {"quintile": 5, "decile": 10}
STAGES = ("current_ordinary", "current_any", "deleted_any")


def band_edges(table: DataFrame, groups: list[str], band: str, rank: str = "rank", zone: str = "dz_code", published: str | None = None) -> DataFrame:
    """The first and last zone by rank inside every band value."""
    order = F.struct(F.col(rank), F.col(zone))
    row = F.struct(F.col(zone).alias("dz_code"), F.col(rank).alias("rank"), F.col(published or band).alias("published_value"))
    ends = table.groupBy(*groups, F.col(band).alias("value")).agg(F.min_by(row, order).alias("_first"), F.max_by(row, order).alias("_last"))
    return ends.select(*groups, "value", F.inline(F.array(F.struct(F.lit("first").alias("edge"), F.col("_first").alias("z")),
                                                          F.struct(F.lit("last").alias("edge"), F.col("_last").alias("z"))))).select(
        *groups, "value", "edge", "z.dz_code", "z.rank", "z.published_value", F.col("value").alias("expected_value"))


def pick_records(history: DataFrame, zone: str, seed: int, lives: Lives = Lives()) -> DataFrame:
    """One key per zone, drawn by a seeded hash: an ordinary current record if there is one, else any
    current one, else any; with the newest life of the drawn key in that stage."""
    ordinary = ((F.col(lives.role) == "small_user") & (F.col(lives.key) == F.col(lives.base))
                & ~F.coalesce(F.col(lives.link), F.lit("")).isin(*LINK_SENTINELS))
    stage = F.when(F.col(lives.current) & ordinary, 0).when(F.col(lives.current), 1).otherwise(2)
    keys = history.groupBy(zone, lives.key).agg(F.min_by(F.struct(stage.alias("stage"), F.col(lives.start).alias("introduced_on")),
                                                         F.struct(stage, -F.datediff(F.col(lives.start), F.lit("1970-01-01").cast("date")))).alias("_r"))
    draw = F.struct(F.col("_r.stage"), F.sha2(F.concat(F.col(lives.key), F.lit(f"|{seed}")), 256))
    best = keys.groupBy(zone).agg(F.min_by(F.struct(F.col(lives.key).alias("pc_norm"), "_r"), draw).alias("b"))
    name = F.element_at(F.array(*[F.lit(s) for s in STAGES]), F.col("b._r.stage") + 1)
    return best.select(zone, "b.pc_norm", F.col("b._r.introduced_on").alias("introduced_on"), name.alias("selection"))


def ground_truth(service: DataFrame, gov: DataFrame, history: DataFrame, seed: int = 2026, registry: Registry = REGISTRY,
                 lives: Lives = Lives(), zone_column="DataZone{}Code") -> DataFrame:
    """Both publishers, every edition, quintile and decile, both edges: one case each, with a record of
    its zone. published_value is the publisher's own number, before any turning."""
    cases = None
    inverted = F.col("edition").isin(*[e.key for e in registry.editions if e.invert_bands])
    for publisher, table, stem in (("phs", service, "pw_scotland"), ("govscot", gov, "uw_scotland")):
        for name, width in CASE_BANDS.items():
            band = f"{stem}_{name}"
            own = F.when(inverted, turned(band, width)).otherwise(F.col(band)) if publisher == "phs" else F.col(band)
            part = band_edges(table.withColumn("_own", own), ["edition", "dz_vintage"], band, published="_own").select(
                F.lit(publisher).alias("publisher"), "edition", "dz_vintage", F.lit(name).alias("band"), "value", "edge", "rank", "dz_code",
                "published_value", "expected_value")
            cases = part if cases is None else cases.unionByName(part)
    picks = None
    for v in registry.vintages():
        p = pick_records(history, zone_column.format(v), seed, lives).withColumnRenamed(zone_column.format(v), "dz_code").withColumn("dz_vintage", F.lit(v))
        picks = p if picks is None else picks.unionByName(p)
    return cases.join(picks, ["dz_vintage", "dz_code"], "left").withColumn("selection", F.coalesce("selection", F.lit("no_postcode")))
