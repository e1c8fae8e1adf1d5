"""The whole linkage results as registered queries: every column a user is given, over a stand-in directory in which each measure of
each edition has its own value, with SQL that works the same rows out by another engine."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import (BAND_DIRECTION, EDITION_BY_YEAR, EDITION_THROUGHOUT, GEOGRAPHIES, LARGE_USER_HEADER, LOOKUP_HEADER, REGISTRY, RURALITY_BY_YEAR,
                        RURALITY_THROUGHOUT, SIXFOLD_LABELS, SMALL_USER_HEADER)
from . import report as rp
from . import standin as t
from .attach import lookup
from .queries_linkage import ASOF_SQL, LATEST_SQL, MAIN_SQL, directory, main_table

L = t.TEST_LIVES
QUERIES: dict = {}
ORACLE: dict = {}
YEAR = "CASE WHEN id % 11 = 3 THEN NULL WHEN id % 13 = 5 THEN 0 WHEN id % 17 = 6 THEN 10000 ELSE CAST(1993 + id % 34 AS INT) END"
HEADER = [c for c in [*SMALL_USER_HEADER, *[c for c in LARGE_USER_HEADER if c not in SMALL_USER_HEADER]] if c not in rp.NOT_RETURNED]
RURAL = [f"{v.stem}_{c}" for v in REGISTRY.rurality_versions for c in ("6fold", "8fold", "status")]


def query(name: str, sql: str):
    def add(fn):
        QUERIES[name], ORACLE[name] = fn, sql
        return fn
    return add


def stored() -> list[str]:
    """Columns that the record which supplies geography has beyond the directory's own."""
    return ([f"phs_dz{v}_{g}" for v in REGISTRY.vintages() for g in GEOGRAPHIES]
            + [e.column(m) for e in REGISTRY.editions for m in rp.measures().values() if e.publishes(m)])


NUMBER = {c: k + 3 for k, c in enumerate([*stored(), *HEADER, *LOOKUP_HEADER, *RURAL])}


def value(column: str, zone: str) -> str:
    """What a column of the stand-in holds for a zone, in words of both engines. Ranks and one set of zones have gaps."""
    k = NUMBER[column]
    if column.endswith("_source_status"):
        return f"CASE WHEN {zone} % 7 = {k % 7} THEN 'rank_sources_disagree' END"
    if column.startswith("urbanrural"):
        if column.endswith("status"):
            return f"CASE WHEN {zone} % 10 = {k % 10} THEN 'outside_polygons' END"
        k = NUMBER[column[:-5] + "status"]
        return f"CASE WHEN {zone} % 10 <> {k % 10} THEN CAST({zone} % {column[-5]} + 1 AS TINYINT) END"
    if column.endswith("domain_rank"):
        return f"CAST(({zone} * {k}) % 997 AS DOUBLE) + ({zone} % 2) * 0.5E0"
    if column.startswith("simd"):
        return f"CASE WHEN {zone} % {'13 <> 4' if column.endswith('_rank') else '1 = 0'} THEN CAST(({zone} * {k}) % 97 AS INT) END"
    gap = f"{zone} % 17 <> 3" if column.startswith("IntermediateZone") else f"{zone} IS NOT NULL"
    return f"CASE WHEN {gap} THEN concat('c{k}-', CAST({zone} AS STRING)) END"


def wide(df, columns):
    return df.select("*", *[F.expr(value(c, "zone")).alias(c) for c in columns if c not in df.columns])


def history(spark, sf):
    return wide(directory(spark, sf), dict.fromkeys([*HEADER, *stored(), *RURAL])).withColumn("spd_release", F.lit("r1"))


def main(spark, sf):
    return wide(main_table(spark, sf), dict.fromkeys([*LOOKUP_HEADER, *stored()])).withColumn("sspl_release", F.lit("m1"))


def cohort(spark, sf):
    return t.cohort(spark, sf).withColumn("analysis_year", F.expr(YEAR))


def chosen(pairs, over: str) -> str:
    """CASE over a column, of (key, expression)."""
    pairs = [(k, e) for k, e in pairs if e]
    return f"CASE {over} " + " ".join(f"WHEN {k if isinstance(k, int) else repr(k)} THEN {e}" for k, e in pairs) + " END" if pairs else "NULL"


def windows(rows, at: int) -> str:
    return "CASE " + " ".join(f"WHEN analysis_year BETWEEN {w[0]} AND {w[1]} THEN {w[at] if isinstance(w[at], int) else repr(w[at])}" for w in rows) + " END"


def report_sql(base: str, own: list[str], source: tuple[str, str, str], *, edition: str | None = None, rural: bool = True, usable=("matched", "a_part", "linked_small_user"),
               more=(), only: list[str] | None = None) -> str:
    """The result over `base`, whose last table `answer` has the matched record with its zone (mz) and the zone of the one that supplies geography (sz)."""
    editions, versions, measures = REGISTRY.editions, REGISTRY.rurality_versions, rp.measures()
    pick = f"'{edition}'" if edition else windows(REGISTRY.edition_windows(), 2)
    version = f"'{versions[-1].key}'" if edition else windows(REGISTRY.rurality_windows(), 2)
    problem = "'ok'" if edition else ("CASE WHEN analysis_year IS NULL THEN 'missing_year' WHEN analysis_year < 1 OR analysis_year > 9999 THEN 'invalid_year' "
                                     "WHEN simd_edition IS NULL THEN 'no_edition' ELSE 'ok' END")
    vintages = {v: [e.key for e in editions if e.vintage == v] for v in REGISTRY.vintages()}
    zones = {"data_zone_code": "DataZone{}Code", "intermediate_zone_code": "IntermediateZone{}Code", **{f"phs_{g}_code": "phs_dz{}_" + g for g in GEOGRAPHIES}}
    cells = {o: chosen([(v, value(c.format(v), "sz")) for v in vintages], "data_zone_vintage") for o, c in zones.items()}
    cells |= {o: chosen([(e.key, value(e.column(m), "sz") if e.publishes(m) else "") for e in editions], "simd_edition") for o, m in measures.items()}
    required = [o for o in zones if o != "intermediate_zone_code"] + [o for o, m in measures.items() if not m.endswith("_source_status")]
    lacking = lambda o: [e.key for e in editions if o in measures and not e.publishes(measures[o])]
    missing = " OR ".join(f"({o} IS NULL" + (f" AND simd_edition NOT IN ({', '.join(map(repr, lacking(o)))})" if lacking(o) else "") + ")" for o in required)
    if rural:
        cells |= {f"stored_{c}": chosen([(v.key, value(f"{v.stem}_{c}", "mz")) for v in versions], "rurality_version") for c in ("6fold", "8fold", "status")}
    cells |= {"matched_postcode" if c == "Postcode" else c: "own_split" if c == "SplitIndicator" and not rural else value(c, "mz") for c in own}
    out = {c: c for c in rp.common()} | {
        "simd_status": f"CASE WHEN edition_status <> 'ok' THEN edition_status WHEN postcode_status NOT IN ({', '.join(map(repr, usable))}) THEN postcode_status "
                       f"WHEN {missing} THEN 'missing_simd' ELSE 'matched' END",
        "index_source": f"'{source[0]}'", "allocation": f"'{source[1]}'", "index_release": f"CASE WHEN matched_pc_norm IS NOT NULL THEN '{source[2]}' END",
        "edition_policy": repr(EDITION_THROUGHOUT if edition else EDITION_BY_YEAR).replace('"', "'"), "band_direction": f"'{BAND_DIRECTION}'",
        "simd_source_pc_norm": "source_key", "simd_source_introduced_on": "source_introduced_on", "simd_source_is_current": "source_is_current"}
    if rural:
        undecided = "postcode_status IN ('ambiguous_postcode', 'split_a_missing')"
        out |= {"rurality_version": "rurality_version", "rurality_policy": f"'{RURALITY_THROUGHOUT if edition else RURALITY_BY_YEAR}'",
                "rurality_6fold": f"CASE WHEN NOT {undecided} THEN stored_6fold END", "rurality_8fold": f"CASE WHEN NOT {undecided} THEN stored_8fold END",
                "rurality_status": f"CASE WHEN matched_pc_norm IS NULL OR {undecided} THEN postcode_status WHEN rurality_version IS NULL AND analysis_year IS NULL THEN 'missing_year' "
                                   "WHEN rurality_version IS NULL AND (analysis_year < 1 OR analysis_year > 9999) THEN 'invalid_year' "
                                   f"WHEN rurality_version IS NULL AND analysis_year < {versions[0].reference_year} THEN 'before_first_version' WHEN rurality_version IS NULL THEN 'invalid_year' "
                                   "WHEN stored_status IS NOT NULL THEN stored_status ELSE 'matched' END",
                "rurality_6fold_label": chosen(list((k, repr(v)) for k, v in SIXFOLD_LABELS.items()), "rurality_6fold")}
    out |= {c: c for c in more} | {("matched_postcode" if c == "Postcode" else c): ("matched_postcode" if c == "Postcode" else c) for c in own}
    label = out.pop("rurality_6fold_label", None)
    final = (only or list(out))
    body = base + f""",
e0 AS (SELECT *, {pick} AS simd_edition, {version} AS rurality_version FROM answer),
e1 AS (SELECT *, {problem} AS edition_status, {chosen([(e.key, str(e.vintage)) for e in editions], 'simd_edition')} AS data_zone_vintage FROM e0),
e2 AS (SELECT *, {', '.join(f'{x} AS {o}' for o, x in cells.items())} FROM e1),
e3 AS (SELECT {', '.join(x if x == o else f'{x} AS {o}' for o, x in out.items())} FROM e2)
SELECT {', '.join(f'{label} AS {c}' if c == 'rurality_6fold_label' else c for c in final)} FROM e3"""
    return body.replace("AS STRING)", "AS VARCHAR)")


MATCHED_SQL = """{m}.pc_norm AS matched_pc_norm, {m}.introduced_on AS matched_introduced_on, {m}.is_current AS matched_is_current,
    {m}.spd_user_type AS matched_user_type, {m}.link AS requested_link_postcode"""
_LATEST = LATEST_SQL.rsplit("geo AS", 1)[0] + """
geo AS (SELECT r.*, g.pc_norm AS source_key, g.introduced_on AS source_introduced_on, g.is_current AS source_is_current, g.zone AS sz FROM rep r LEFT JOIN newest g ON g.spd_user_type = 'small_user'
   AND g.pc_norm = CASE WHEN r.ties > 1 OR r.tier <> 'A' THEN NULL WHEN r.spd_user_type = 'small_user' THEN r.pc_norm ELSE upper(replace(r.link, ' ', '')) END),
answer AS (SELECT a.id, a.postcode, CAST(NULL AS DATE) AS address_date, {year} AS analysis_year, a.postcode_key, r.pc_base AS matched_pc_base, """ + MATCHED_SQL.format(m="r") + """,
    r.source_key, r.source_introduced_on, r.source_is_current, r.zone AS mz, r.sz,
""" + LATEST_SQL.split("answer AS (SELECT a.id, a.postcode_key,")[1].split("AS postcode_status,")[0] + "AS postcode_status FROM asked a LEFT JOIN geo r ON r.pc_base = a.postcode_key)"
HISTORY = ("spd", "postcode_grid_reference", "r1")
NO_YEAR = "CAST(NULL AS INT)"


@query("report_by_era", report_sql(_LATEST.format(year=YEAR), HEADER, HISTORY, more=["matched_pc_base"]))
def _(spark, sf):
    """The newest life of each key, edition and version by year: 151 columns."""
    return rp.by_era(cohort(spark, sf), history(spark, sf), lives=L)


@query("report_throughout", report_sql(_LATEST.format(year=NO_YEAR), HEADER, HISTORY, edition="2009v2", more=["matched_pc_base"]))
def _(spark, sf):
    return rp.throughout(cohort(spark, sf), history(spark, sf), "2009v2", lives=L)


_DATED = ASOF_SQL.rsplit("linked AS", 1)[0] + """
linked AS (SELECT k.*, g.pc_norm AS source_key, g.introduced_on AS source_introduced_on, g.is_current AS source_is_current, g.zone AS sz
  FROM keyed k LEFT JOIN lives g ON g.pc_norm = k.gkey AND g.spd_user_type = 'small_user' AND g.introduced_on <= k.gday
    AND (g.deleted_on IS NULL OR g.deleted_on > k.gday)),
answer AS (SELECT a.id, a.postcode, a.address_date, coalesce(""" + YEAR.replace("id %", "a.id %") + """, year(a.address_date)) AS analysis_year, a.postcode_key,
    b.m.pc_base AS matched_pc_base, """ + MATCHED_SQL.format(m="b.m") + """, b.source_key, b.source_introduced_on, b.source_is_current, b.m.zone AS mz, b.sz,
    o.first_introduced_on, o.previous_life_deleted_on, o.next_life_introduced_on,
""" + ASOF_SQL.split("answer AS (SELECT a.id, a.postcode_key, a.address_date,")[1].split("AS postcode_status,")[0] + """AS postcode_status
  FROM asked a LEFT JOIN linked b ON b.pk = a.postcode_key AND b.ad = a.address_date
    LEFT JOIN around o ON o.pk = a.postcode_key AND o.ad IS NOT DISTINCT FROM a.address_date)"""
AROUND = ["first_introduced_on", "previous_life_deleted_on", "next_life_introduced_on", "matched_pc_base"]
DATED = ("matched", "a_part", "linked_small_user", "previous_life")


@query("report_on_date", report_sql(_DATED, HEADER, HISTORY, more=AROUND, usable=DATED))
def _(spark, sf):
    """The life on each row's date, edition by the year asked for or else that of the date: 154 columns."""
    return rp.on_date(cohort(spark, sf), history(spark, sf), lives=L)


@query("report_on_date_short", report_sql(_DATED, HEADER, HISTORY, more=AROUND, usable=DATED, only=[*rp.SHORT, "rurality_6fold_label"]))
def _(spark, sf):
    return rp.on_date_short(cohort(spark, sf), history(spark, sf), lives=L)


_MAIN = MAIN_SQL.replace("SELECT pc_norm AS k, zone FROM main", "SELECT pc_norm AS k, * FROM main").replace("SELECT pc_norm || 'A', zone FROM main", "SELECT pc_norm || 'A', * FROM main") + """
answer AS (SELECT a.id, a.postcode, CAST(NULL AS DATE) AS address_date, {year} AS analysis_year, a.postcode_key, """ + MATCHED_SQL.format(m="m") + """,
   g.pc_norm AS source_key, g.introduced_on AS source_introduced_on, g.is_current AS source_is_current, m.zone AS mz, g.zone AS sz, m.split AS own_split,
   CASE WHEN a.postcode_key IS NULL THEN 'missing_postcode' WHEN m.pc_norm IS NULL THEN 'not_found'
     WHEN m.spd_user_type = 'large_user' AND m.link = 'NO LINKP' THEN 'po_box'
     WHEN m.spd_user_type = 'large_user' AND coalesce(m.link, 'NO LINK') = 'NO LINK' THEN 'unlinked_large_user'
     WHEN g.k IS NULL THEN 'linked_small_user_not_found' WHEN m.spd_user_type = 'large_user' THEN 'linked_small_user'
     WHEN m.split = 'Y' THEN 'a_part' ELSE 'matched' END AS postcode_status
  FROM asked a LEFT JOIN main m ON m.pc_norm = a.postcode_key
  LEFT JOIN address g ON g.k = CASE WHEN m.spd_user_type = 'small_user' THEN m.pc_norm ELSE upper(replace(m.link, ' ', '')) END)"""
LOOKUP = ("sspl", "oa2022_centroid", "m1")
LOOKUP_OWN = [c for c in LOOKUP_HEADER if c not in rp.NOT_RETURNED]


@query("report_lookup_by_era", report_sql(_MAIN.format(year=YEAR), LOOKUP_OWN, LOOKUP, rural=False))
def _(spark, sf):
    """A lookup of whole keys, edition by year: 132 columns."""
    return rp.lookup_by_era(cohort(spark, sf), main(spark, sf), lives=L)


@query("report_lookup_throughout", report_sql(_MAIN.format(year=NO_YEAR), LOOKUP_OWN, LOOKUP, edition="2016", rural=False))
def _(spark, sf):
    return rp.lookup_throughout(cohort(spark, sf), main(spark, sf), "2016", lives=L)


@query("lookup_candidates", "WITH " + t.LIVES_SQL + "," + t.COHORT_SQL + """,
split_keys AS (SELECT DISTINCT pc_norm FROM lives WHERE pc_norm <> pc_base),
route AS (SELECT pc_base AS route_key, * FROM lives WHERE pc_base NOT IN (SELECT pc_norm FROM split_keys)
  UNION ALL SELECT pc_norm AS route_key, * FROM lives WHERE pc_norm <> pc_base),
keys AS (SELECT DISTINCT postcode_key FROM asked)
SELECT route_key, pc_norm, introduced_on, deleted_on, is_current AS is_valid FROM route JOIN keys ON route_key = postcode_key""")
def _(spark, sf):
    """Every record that each asked key could mean, and whether it is valid today."""
    _, candidates = lookup(history(spark, sf), t.cohort(spark, sf), "2020v2", lives=L)
    return candidates.select("route_key", "pc_norm", "introduced_on", "deleted_on", "is_valid")
