"""Choosing one life of a key: newest life, best part, ties counted. Aggregations only, so a key
with many lives is reduced on the map side before anything meets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import Lives, normalised, part, tier


def newest_lives(history: DataFrame, lives: Lives = Lives(), carry: list[str] | None = None) -> DataFrame:
    """The newest introduction of every full key (one row per key); of those on one day the life that ends last, an open one
    before all, so that a same-day record never hides the life beside it. Of records equal in that, one by a
    hash of what is read of it, so that the choice is the same in every run."""
    keep = carry if carry is not None else [c for c in history.columns if c not in (lives.key, lives.start)]
    ends = [F.coalesce(F.col(lives.end), F.lit("9999-12-31").cast("date"))] if lives.end in history.columns else []
    plain = [c for c in keep if "map<" not in history.schema[c].dataType.simpleString()]
    best = F.max_by(F.struct(*keep), F.struct(F.col(lives.start), *ends, F.xxhash64(*plain) if plain else F.lit(0))) if keep else None
    out = history.groupBy(lives.key).agg(F.max(lives.start).alias(lives.start), best.alias("_r"))
    return out.select(lives.key, lives.start, *[F.col(f"_r.{c}").alias(c) for c in keep])


def life_record(lives: Lives = Lives(), carry: tuple | list = ()) -> list:
    """Fields of the chosen record, the key first so that the smallest key represents a tie."""
    return [F.col(lives.key).alias("pc_norm"), F.col(lives.base).alias("pc_base"), F.col(lives.start).alias("introduced_on"),
            F.col(lives.end).alias("deleted_on"), F.col(lives.current).alias("is_current"), F.col(lives.role).alias("role"),
            F.col(lives.link).alias("link"), *[F.col(c) for c in carry]]


def best_part(rows: DataFrame, keys: list[str], lives: Lives = Lives(), carry: tuple | list = (), live_first: bool = False) -> DataFrame:
    """Per keys: the record of the best part (whole beside A, then B, C; then the newest start) and how
    many records tie for it. `live_first` puts current records before ended ones."""
    ended = F.when(F.col(lives.current), F.lit(0)).otherwise(F.lit(1)) if live_first else F.lit(0)
    age = -F.datediff(F.col(lives.start), F.lit("1970-01-01").cast("date"))
    ranked = rows.select(*keys, ended.alias("_e"), tier(lives.key, lives.base).alias("_t"), age.alias("_g"),
                         F.struct(*life_record(lives, carry)).alias("_rec"))
    # A map or other unordered column cannot be compared; the key alone decides inside a tie.
    tied = ranked.groupBy(*keys, "_e", "_t", "_g").agg(F.count(F.lit(1)).alias("candidates"), F.min_by("_rec", "_rec.pc_norm").alias("rec"))
    return tied.groupBy(*keys).agg(F.min_by(F.struct("candidates", "rec"), F.struct("_e", "_t", "_g")).alias("found"))


def best_of_parts():
    """The same choice among the part0..part3 of one stretch, as (candidates, rec). A whole record and
    an A part compete by start; B and C count only where neither is there."""
    whole, a = F.col("part0"), F.col("part1")
    w_start, a_start = F.col("part0.introduced_on"), F.col("part1.introduced_on")
    rec = F.when(a_start > w_start, a).otherwise(F.coalesce(whole, a, F.col("part2"), F.col("part3")))
    candidates = F.when(rec.isNotNull(), F.when(w_start == a_start, F.lit(2)).otherwise(F.lit(1)).cast("long"))
    return candidates.alias("candidates"), rec.alias("rec")


def geography_key(rec: str, candidates: str):
    """Which record supplies geography: none for a tie or a B or C part, its own for a small user,
    the linked key for a large user."""
    own_part = part(f"{rec}.pc_norm", f"{rec}.pc_base")
    return (F.when((F.col(candidates) > 1) | ~own_part.isin("", "A"), F.lit(None).cast("string"))
            .when(F.col(f"{rec}.role") == "small_user", F.col(f"{rec}.pc_norm"))
            .otherwise(normalised(f"{rec}.link")))


def latest_per_base(history: DataFrame, lives: Lives = Lives(), carry: tuple | list = ()) -> DataFrame:
    """One representative of every base with a comparison status, before following any link."""
    found = best_part(newest_lives(history, lives), [lives.base], lives, carry, live_first=True)
    rec = "found.rec"
    names = {"pc_norm": lives.key, "introduced_on": lives.start, "deleted_on": lives.end, "is_current": lives.current,
             "role": lives.role, "link": lives.link}
    status = (F.when(F.col("found.candidates") > 1, F.lit("ambiguous_postcode"))
              .when(tier(f"{rec}.pc_norm", f"{rec}.pc_base") != "A", F.lit("split_a_missing")).otherwise(F.lit("resolved")))
    return found.select(lives.base, *[F.col(f"{rec}.{k}").alias(v) for k, v in names.items()],
                        *[F.col(f"{rec}.{c}").alias(c) for c in carry], status.alias("comparison_status"))


def current_candidates(history: DataFrame, requests: DataFrame, key: str = "postcode", lives: Lives = Lives()) -> DataFrame:
    """How many current records answer each requested key, and whether that is none, one or several."""
    from .skew import lookup_join
    counts = history.where(F.col(lives.current)).groupBy(F.col(lives.base).alias("_key")).agg(F.count(F.lit(1)).alias("candidate_count"))
    asked = requests.withColumn("_key", normalised(key))
    out = lookup_join(asked, counts, ["_key"]).withColumn("candidate_count", F.coalesce("candidate_count", F.lit(0).cast("long")))
    status = (F.when(F.col("candidate_count") == 0, F.lit("not_found")).when(F.col("candidate_count") == 1, F.lit("unique"))
              .otherwise(F.lit("ambiguous")))
    return out.withColumn("selection_status", status).drop("_key")
