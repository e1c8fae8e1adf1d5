"""The full linkage results: edition and version by year, every measure, and every status.

All five results share their first columns, `COMMON`; the matched record's own fields follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import status as st
from ..functions.keys import Lives
from ..functions.values import folded
from ..functions.years import analysis_year, edition_for, edition_status, version_for, vintage_of
from ..operators.enrich import edition_measure
from ..registry import (BAND_DIRECTION, CORE_OUTPUT, EDITION_BY_YEAR, EDITION_THROUGHOUT, GEOGRAPHIES, LARGE_USER_HEADER, LOOKUP_HEADER, REGISTRY,
                        RURALITY_BY_YEAR, RURALITY_THROUGHOUT, SMALL_USER_HEADER, Registry, optional_output)
from .linkage import link_as_of, link_latest, link_lookup

HISTORY_SOURCE = {"index_source": "spd", "allocation": "postcode_grid_reference", "release": "spd_release"}
LOOKUP_SOURCE = {"index_source": "sspl", "allocation": "oa2022_centroid", "release": "sspl_release"}
NOT_RETURNED = ("GridReferenceEasting", "GridReferenceNorthing", "Latitude", "Longitude")


def measures(registry: Registry = REGISTRY) -> dict[str, str]:
    """Output name -> stored measure, in output order."""
    return {**CORE_OUTPUT, **{optional_output(m): m for m in registry.optional_measures()}}


def common(registry: Registry = REGISTRY) -> list[str]:
    return ["id", "postcode", "address_date", "analysis_year", "postcode_key", "postcode_status", "simd_status", "index_source", "index_release",
            "allocation", "simd_edition", "edition_policy", "data_zone_vintage", "matched_pc_norm", "matched_introduced_on", "matched_is_current",
            "matched_user_type", "requested_link_postcode", "simd_source_pc_norm", "simd_source_introduced_on", "simd_source_is_current",
            "data_zone_code", "intermediate_zone_code", *[f"phs_{g}_code" for g in GEOGRAPHIES], *measures(registry), "band_direction"]


def _stored(history: DataFrame, registry: Registry, used: Registry | None = None) -> list[str]:
    """Columns the geography record supplies: zones, areas and every stored measure. All have to be there; those of the editions in `used` are read."""
    def of(r: Registry) -> list[str]:
        names = [f"{z}{v}Code" for z in ("DataZone", "IntermediateZone") for v in r.vintages()]
        names += [f"phs_dz{v}_{g}" for v in r.vintages() for g in GEOGRAPHIES]
        return names + [e.column(m) for e in r.editions for m in measures(registry).values() if e.publishes(m)]
    missing = [n for n in of(registry) if n not in history.columns]
    if missing:
        raise ValueError(f"the directory lacks published columns: {missing[:5]}")
    return of(used or registry)


def _used(registry: Registry, edition: str | None) -> Registry:
    """What a report reads: one edition and the latest version where these hold throughout, else all."""
    if edition not in {e.key for e in registry.editions}:
        return registry
    return registry.replace(editions=(registry.edition(edition),), rurality_versions=registry.rurality_versions[-1:])


def _types(history: DataFrame, registry: Registry) -> dict:
    """The type of each measure's output, by the first edition that published it."""
    return {out: history.schema[e.column(m)].dataType for e in reversed(registry.editions) for out, m in measures(registry).items() if e.publishes(m)}


def _own_fields(history: DataFrame, header) -> list[str]:
    return [c for c in header if c in history.columns and c not in NOT_RETURNED]


def _by_vintage(name: str, registry: Registry):
    out = None
    for v in registry.vintages():
        test = F.col("data_zone_vintage") == v
        out = F.when(test, F.col(name.format(v))) if out is None else out.when(test, F.col(name.format(v)))
    return out


ZONES = {"data_zone_code": "DataZone{}Code", "intermediate_zone_code": "IntermediateZone{}Code", **{f"phs_{g}_code": "phs_dz{}_" + g for g in GEOGRAPHIES}}


def _required(registry: Registry) -> dict:
    """Outputs that have to have a value, with their measure (none for a zone). A source status may be empty, and the intermediate zone is carried as it is."""
    named = {**dict.fromkeys(ZONES), **measures(registry)}
    return {out: m for out, m in named.items() if out != "intermediate_zone_code" and not (m and m.endswith("_source_status"))}


def _missing(registry: Registry, used: Registry):
    """Whether a row lacks a value that its edition published."""
    missing = []
    for out, m in _required(registry).items():
        unpublished = [e.key for e in used.editions if m and not e.publishes(m)]
        test = F.col(out).isNull()
        missing.append(test & ~F.col("simd_edition").isin(*unpublished) if unpublished else test)
    return folded(missing, lambda a, b: a | b)


def _values(df: DataFrame, registry: Registry, source: dict, usable: tuple, used: Registry, types: dict) -> DataFrame:
    df = df.withColumns({k: _by_vintage("source_" + v, used) for k, v in ZONES.items()})
    df = edition_measure(df, "simd_edition", measures(registry), used, source="source_", types=types)
    return df.withColumns({
        "simd_status": st.value_status(usable, _missing(registry, used)), "index_source": F.lit(source["index_source"]), "allocation": F.lit(source["allocation"]),
        "index_release": F.col(f"context_{source['release']}"), "band_direction": F.lit(BAND_DIRECTION),
        "simd_source_pc_norm": F.col("source_key"), "simd_source_introduced_on": F.col("source_introduced_on"),
        "simd_source_is_current": F.col("source_is_current")})


def _rurality(df: DataFrame, registry: Registry, used: Registry) -> DataFrame:
    packed = None
    for v in used.rurality_versions:
        cell = F.struct(*[F.col(f"context_{v.stem}_{c}").alias(n) for c, n in (("6fold", "six"), ("8fold", "eight"), ("status", "reason"))])
        test = F.col("rurality_version") == v.key
        packed = F.when(test, cell) if packed is None else packed.when(test, cell)
    df = df.withColumn("_rural", packed).withColumn("rurality_stored_status", F.col("_rural.reason"))
    decided = ~F.col("postcode_status").isin(*st.UNDECIDED)
    return df.withColumns({"rurality_6fold": F.when(decided, F.col("_rural.six")), "rurality_8fold": F.when(decided, F.col("_rural.eight")),
                           "rurality_status": st.rurality_status(registry.rurality_windows()[0][0])})


def _shaped(df: DataFrame, registry: Registry, own: list[str], rurality: bool, more: list[str]) -> DataFrame:
    rural = ["rurality_version", "rurality_policy", "rurality_6fold", "rurality_8fold", "rurality_status"] if rurality else []
    fields = [F.col(f"context_{c}").alias("matched_postcode" if c == "Postcode" else c) for c in own]
    return df.select(*common(registry), *rural, *more, *fields)


def _chosen(cohort: DataFrame, registry: Registry, edition: str | None) -> DataFrame:
    year = "analysis_year"
    if edition is None:
        return cohort.withColumns({
            "simd_edition": edition_for(year, registry), "edition_policy": F.lit(EDITION_BY_YEAR), "rurality_version": version_for(year, registry),
            "rurality_policy": F.lit(RURALITY_BY_YEAR)}).withColumns({
                "data_zone_vintage": vintage_of("simd_edition", registry), "edition_status": edition_status(year, "simd_edition")})
    known = edition in {e.key for e in registry.editions}
    return cohort.withColumns({
        "simd_edition": F.lit(edition if known else None).cast("string"), "edition_policy": F.lit(EDITION_THROUGHOUT),
        "rurality_version": F.lit(registry.rurality_versions[-1].key), "rurality_policy": F.lit(RURALITY_THROUGHOUT),
        "edition_status": F.lit("ok" if known else "unknown_edition")}).withColumn("data_zone_vintage", vintage_of("simd_edition", registry))


def _rural(used: Registry) -> list[str]:
    return [f"{v.stem}_{c}" for v in used.rurality_versions for c in ("6fold", "8fold", "status")]


def _history_columns(history: DataFrame, registry: Registry, used: Registry) -> tuple[list[str], list[str], list[str]]:
    header = [*SMALL_USER_HEADER, *[c for c in LARGE_USER_HEADER if c not in SMALL_USER_HEADER]]
    own = _own_fields(history, header)
    return own, [*own, HISTORY_SOURCE["release"], *_rural(used)], _stored(history, registry, used)


def by_era(cohort: DataFrame, history: DataFrame, registry: Registry = REGISTRY, lives: Lives = Lives(), **options) -> DataFrame:
    """History table, newest life, edition by the row's analysis_year. Cohort: id, postcode, analysis_year."""
    asked = cohort.select("id", "postcode", F.lit(None).cast("date").alias("address_date"), F.col("analysis_year").cast("int").alias("analysis_year"))
    return _latest(asked, history, registry, lives, None, options)


def throughout(cohort: DataFrame, history: DataFrame, edition: str, registry: Registry = REGISTRY, lives: Lives = Lives(), **options) -> DataFrame:
    """History table, newest life, one edition for the whole study. Cohort: id, postcode."""
    asked = cohort.select("id", "postcode", F.lit(None).cast("date").alias("address_date"), F.lit(None).cast("int").alias("analysis_year"))
    return _latest(asked, history, registry, lives, edition, options)


def _latest(asked, history, registry, lives, edition, options) -> DataFrame:
    used = _used(registry, edition)
    own, context, source = _history_columns(history, registry, used)
    df = _chosen(link_latest(asked, history, lives=lives, context=context, source=source, **options), registry, edition)
    df = _rurality(_values(df, registry, HISTORY_SOURCE, st.USABLE, used, _types(history, registry)), registry, used)
    return _shaped(df, registry, own, True, ["matched_pc_base"])


def _dated(cohort: DataFrame) -> DataFrame:
    override = F.col("analysis_year") if "analysis_year" in cohort.columns else F.lit(None)
    return cohort.select("id", "postcode", F.col("address_date").cast("date").alias("address_date"),
                         analysis_year(override.cast("int"), F.col("address_date").cast("date")).alias("analysis_year"))


DATED = (*st.USABLE, "previous_life")


def on_date(cohort: DataFrame, history: DataFrame, registry: Registry = REGISTRY, lives: Lives = Lives(), **options) -> DataFrame:
    """History table, the life on the row's date, edition by its year or by analysis_year where given.
    Cohort: id, postcode, address_date and optionally analysis_year."""
    own, context, source = _history_columns(history, registry, registry)
    df = _chosen(link_as_of(_dated(cohort), history, lives=lives, context=context, source=source, **options), registry, None)
    df = _rurality(_values(df, registry, HISTORY_SOURCE, DATED, registry, _types(history, registry)), registry, registry)
    return _shaped(df, registry, own, True, ["first_introduced_on", "previous_life_deleted_on", "next_life_introduced_on", "matched_pc_base"])


# Output names are a contract.
SHORT = ["id", "postcode", "address_date", "postcode_status", "simd_status", "simd_edition", "simd_rank", "phs_pw_scotland_quintile", "phs_pw_scotland_decile",
         "gov_uw_scotland_quintile", "gov_uw_scotland_decile", "rurality_version", "rurality_6fold", "rurality_8fold", "rurality_status"]


def on_date_short(cohort: DataFrame, history: DataFrame, registry: Registry = REGISTRY, lives: Lives = Lives(), **options) -> DataFrame:
    """The dated result on a few columns, with the 6-fold class in words. Whether a record lacks a value is worked out for each
    edition in the directory; unread columns never leave it."""
    from ..registry import SIXFOLD_LABELS
    _stored(history, registry)
    shown = {out: m for out, m in measures(registry).items() if out in SHORT}
    filled = {f"filled{e.key}": _filled(e, registry) for e in registry.editions}
    source = [e.column(m) for e in registry.editions for m in shown.values() if e.publishes(m)]
    df = link_as_of(_dated(cohort), history.withColumns(filled), lives=lives, context=_rural(registry), source=[*filled, *source], **options)
    df = edition_measure(_chosen(df, registry, None), "simd_edition", shown, registry, source="source_", types=_types(history, registry))
    lacking = None
    for e in registry.editions:
        test = F.col("simd_edition") == e.key
        lacks = ~F.coalesce(F.col(f"source_filled{e.key}"), F.lit(False))
        lacking = F.when(test, lacks) if lacking is None else lacking.when(test, lacks)
    df = _rurality(df.withColumn("simd_status", st.value_status(DATED, lacking)), registry, registry)
    words = F.create_map(*[F.lit(x) for kv in SIXFOLD_LABELS.items() for x in kv])[F.col("rurality_6fold").cast("int")]
    return df.select(*SHORT, words.alias("rurality_6fold_label"))


def _filled(e, registry: Registry):
    """Whether a directory record has every value that an edition published."""
    columns = [e.column(m) if m else ZONES[out].format(e.vintage) for out, m in _required(registry).items() if not m or e.publishes(m)]
    return folded([F.col(c).isNotNull() for c in columns], lambda a, b: a & b)


def lookup_by_era(cohort: DataFrame, main: DataFrame, registry: Registry = REGISTRY, lives: Lives = Lives(), **options) -> DataFrame:
    """Lookup table, edition by year. Cohort: id, postcode, analysis_year."""
    asked = cohort.select("id", "postcode", F.lit(None).cast("date").alias("address_date"), F.col("analysis_year").cast("int").alias("analysis_year"))
    return _lookup(asked, main, registry, lives, None, options)


def lookup_throughout(cohort: DataFrame, main: DataFrame, edition: str, registry: Registry = REGISTRY, lives: Lives = Lives(), **options) -> DataFrame:
    """Lookup table, one edition. Cohort: id, postcode."""
    asked = cohort.select("id", "postcode", F.lit(None).cast("date").alias("address_date"), F.lit(None).cast("int").alias("analysis_year"))
    return _lookup(asked, main, registry, lives, edition, options)


def _lookup(asked, main, registry, lives, edition, options) -> DataFrame:
    own = _own_fields(main, LOOKUP_HEADER)
    used = _used(registry, edition)
    df = link_lookup(asked, main, lives=lives, context=[*own, LOOKUP_SOURCE["release"]], source=_stored(main, registry, used), **options)
    df = _values(_chosen(df, registry, edition), registry, LOOKUP_SOURCE, st.USABLE, used, _types(main, registry))
    return _shaped(df, registry, own, False, [])
