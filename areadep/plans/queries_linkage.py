"""Linkage and attach queries over the stand-in tables, each with the SQL another engine runs to agree."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.years import analysis_year, edition_for, edition_status, version_for, vintage_for
from ..operators.enrich import edition_measure
from ..operators.lives import current_candidates, latest_per_base, newest_lives
from ..operators.profile import value_counts
from ..operators.snapshot import product_agreement
from ..registry import Edition, Registry, RuralityVersion
from . import standin as t
from .attach import attach, attach_by_era, attach_rurality
from .linkage import link_as_of, link_latest, link_lookup

L = t.TEST_LIVES
QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def _edition(key, years, vintage, domains=("income",)):
    return Edition(key=key, vintage=vintage, rows=0, first_year=years[0], last_year=years[1], domains=domains)


# Year windows over the years the test tables cover; e1 did not publish the crime domain.
TEST = Registry(
    editions=(_edition("e1", (1996, 1997), 2001), _edition("e2", (1998, 1999), 2001, ("income", "crime")), _edition("e3", (2000, 9999), 2011, ("income", "crime"))),
    rurality_versions=(RuralityVersion("1997-1998", 1997), RuralityVersion("2000", 2000)), directory_rank=None)


def directory(spark, sf):
    """The life table. It is read several times by every question, so it is kept."""
    return t.lives(spark, sf).persist()


def history(spark, sf):
    """The life table with measures of three editions and two classification versions from its zone."""
    part = t.table(spark, sf, "part").select(F.col("p_partkey").alias("zone"), "p_size", "p_retailprice")
    z = F.col("zone")
    return directory(spark, sf).join(part, "zone", "left").select(
        "*", F.col("p_size").alias("simde1_rank"), (F.col("p_size") % 7).alias("simde2_rank"), (z % 5).cast("int").alias("simde3_rank"),
        (F.col("p_retailprice") * 2).alias("simde2_crime_domain_rank"), F.col("p_retailprice").alias("simde3_crime_domain_rank"),
        (F.col("p_size") % 6 + 1).cast("tinyint").alias("urbanrural1997_1998_6fold"),
        F.when(z % 10 == 3, F.lit("outside_polygons")).alias("urbanrural1997_1998_status"),
        F.when(z % 9 != 4, z % 6 + 1).cast("tinyint").alias("urbanrural2000_6fold"),
        F.when(z % 9 == 4, F.lit("ambiguous_polygons")).alias("urbanrural2000_status"))


HISTORY_SQL = t.LIVES_SQL + """,
history AS (SELECT l.*, p_size AS simde1_rank, p_size % 7 AS simde2_rank, CAST(zone % 5 AS INT) AS simde3_rank,
  p_retailprice * 2 AS simde2_crime, p_retailprice AS simde3_crime,
  p_size % 6 + 1 AS r97, CASE WHEN zone % 10 = 3 THEN 'outside_polygons' END AS r97s,
  CASE WHEN zone % 9 <> 4 THEN zone % 6 + 1 END AS r00, CASE WHEN zone % 9 = 4 THEN 'ambiguous_polygons' END AS r00s
  FROM lives l LEFT JOIN part ON p_partkey = zone)"""

# ---- the life on a date ----

ASOF_SQL = "WITH " + t.LIVES_SQL + "," + t.COHORT_SQL + """,
pair AS (SELECT r.postcode_key AS pk, r.address_date AS ad, l.*,
    introduced_on <= r.address_date AND (deleted_on IS NULL OR deleted_on > r.address_date) AS open_then,
    CASE WHEN deleted_on <= r.address_date AND introduced_on < deleted_on THEN deleted_on END AS gone_on
  FROM (SELECT DISTINCT postcode_key, address_date FROM asked) r JOIN lives l ON l.pc_base = r.postcode_key),
fact AS (SELECT *, bool_or(open_then) OVER w AS any_open, max(gone_on) OVER w AS last_gone, min(introduced_on) OVER w AS first_introduced_on,
    max(CASE WHEN deleted_on <= ad THEN deleted_on END) OVER w AS previous_life_deleted_on,
    min(CASE WHEN introduced_on > ad THEN introduced_on END) OVER w AS next_life_introduced_on,
    CASE WHEN pc_norm = pc_base THEN 'A' ELSE substr(pc_norm, length(pc_base) + 1) END AS tier
  FROM pair WINDOW w AS (PARTITION BY pk, ad)),
around AS (SELECT DISTINCT pk, ad, first_introduced_on, previous_life_deleted_on, next_life_introduced_on FROM fact),
picked AS (SELECT *, rank() OVER (PARTITION BY pk, ad ORDER BY tier, introduced_on DESC) AS place
  FROM fact WHERE open_then OR (NOT any_open AND gone_on = last_gone)),
best AS (SELECT pk, ad, count(*) AS ties, bool_and(NOT any_open) AS from_previous_life, arg_min(picked, pc_norm) AS m
  FROM picked WHERE place = 1 GROUP BY pk, ad),
keyed AS (SELECT *, CASE WHEN ties > 1 OR m.tier <> 'A' THEN NULL WHEN m.spd_user_type = 'small_user' THEN m.pc_norm
    ELSE upper(replace(m.link, ' ', '')) END AS gkey,
    CASE WHEN from_previous_life THEN m.deleted_on - 1 ELSE ad END AS gday FROM best),
linked AS (SELECT k.*, g.pc_norm AS source_key, g.introduced_on AS source_introduced_on, g.zone AS source_zone
  FROM keyed k LEFT JOIN lives g ON g.pc_norm = k.gkey AND g.spd_user_type = 'small_user' AND g.introduced_on <= k.gday
    AND (g.deleted_on IS NULL OR g.deleted_on > k.gday)),
answer AS (SELECT a.id, a.postcode_key, a.address_date,
    CASE WHEN a.postcode_key IS NULL THEN 'missing_postcode' WHEN o.first_introduced_on IS NULL THEN 'not_found'
      WHEN b.m IS NULL AND a.address_date IS NULL THEN 'missing_address_date'
      WHEN b.m IS NULL AND a.address_date < o.first_introduced_on THEN 'postcode_not_yet_introduced'
      WHEN b.m IS NULL AND o.next_life_introduced_on IS NOT NULL THEN 'between_lives'
      WHEN b.m IS NULL THEN 'postcode_deleted_by_date' WHEN b.ties > 1 THEN 'ambiguous_postcode'
      WHEN b.m.tier <> 'A' THEN 'split_a_missing'
      WHEN b.m.spd_user_type = 'large_user' AND b.m.link = 'NO LINKP' THEN 'po_box'
      WHEN b.m.spd_user_type = 'large_user' AND coalesce(b.m.link, 'NO LINK') = 'NO LINK' THEN 'unlinked_large_user'
      WHEN b.source_key IS NULL THEN 'linked_small_user_not_found' WHEN b.from_previous_life THEN 'previous_life'
      WHEN b.m.spd_user_type = 'large_user' THEN 'linked_small_user'
      WHEN b.m.pc_norm <> b.m.pc_base THEN 'a_part' ELSE 'matched' END AS postcode_status,
    b.m.pc_norm AS matched_pc_norm, b.m.introduced_on AS matched_introduced_on, b.source_key, b.source_introduced_on,
    CAST(b.source_zone AS BIGINT) AS source_zone, o.first_introduced_on, o.previous_life_deleted_on, o.next_life_introduced_on
  FROM asked a LEFT JOIN linked b ON b.pk = a.postcode_key AND b.ad = a.address_date
    LEFT JOIN around o ON o.pk = a.postcode_key AND o.ad IS NOT DISTINCT FROM a.address_date)
"""
ASOF_COLUMNS = ["id", "postcode_key", "address_date", "postcode_status", "matched_pc_norm", "matched_introduced_on", "source_key",
                "source_introduced_on", "source_zone", "first_introduced_on", "previous_life_deleted_on", "next_life_introduced_on"]


def as_of(spark, sf, **options):
    return link_as_of(t.cohort(spark, sf), directory(spark, sf), lives=L, source=["zone"], **options)


@query("asof_link", ASOF_SQL + "SELECT " + ", ".join(ASOF_COLUMNS) + " FROM answer")
def _(spark, sf):
    return as_of(spark, sf).select(*ASOF_COLUMNS)


@query("asof_link_sorted", ASOF_SQL + "SELECT " + ", ".join(ASOF_COLUMNS) + " FROM answer")
def _(spark, sf):
    """The same answers by the way taken when the directory is too large to broadcast."""
    return as_of(spark, sf, strategy="sorted").select(*ASOF_COLUMNS)


@query("asof_link_status", ASOF_SQL + "SELECT postcode_status, count(*) AS n FROM answer GROUP BY 1")
def _(spark, sf):
    return value_counts(as_of(spark, sf), "postcode_status", "postcode_status")


@query("asof_link_values", ASOF_SQL + """
, dated AS (SELECT *, year(address_date) AS y FROM answer),
chosen AS (SELECT *, CASE WHEN y BETWEEN 1996 AND 1997 THEN 'e1' WHEN y BETWEEN 1998 AND 1999 THEN 'e2' WHEN y BETWEEN 2000 AND 9999 THEN 'e3' END AS edition FROM dated)
SELECT id, postcode_status, edition AS simd_edition,
  CASE WHEN address_date IS NULL THEN 'missing_year' WHEN edition IS NULL THEN 'no_edition' ELSE 'ok' END AS edition_status,
  CASE edition WHEN 'e1' THEN p_size WHEN 'e2' THEN p_size % 7 WHEN 'e3' THEN CAST(source_zone % 5 AS INT) END AS simd_rank
FROM chosen LEFT JOIN part ON p_partkey = source_zone""")
def _(spark, sf):
    out = link_as_of(t.cohort(spark, sf), history(spark, sf), lives=L, source=["simde1_rank", "simde2_rank", "simde3_rank"])
    year = F.year("address_date")
    out = out.withColumn("simd_edition", edition_for(year, TEST)).withColumn("edition_status", edition_status(year, "simd_edition"))
    out = edition_measure(out, "simd_edition", {"simd_rank": "rank"}, TEST, source="source_")
    return out.select("id", "postcode_status", "simd_edition", "edition_status", "simd_rank")


# ---- the newest life ----

LATEST_SQL = "WITH " + t.LIVES_SQL + "," + t.COHORT_SQL + """,
newest AS (SELECT * FROM lives QUALIFY row_number() OVER (PARTITION BY pc_norm ORDER BY introduced_on DESC) = 1),
tiered AS (SELECT *, CASE WHEN pc_norm = pc_base THEN 'A' ELSE substr(pc_norm, length(pc_base) + 1) END AS tier FROM newest),
top AS (SELECT * FROM tiered QUALIFY rank() OVER (PARTITION BY pc_base ORDER BY is_current DESC, tier, introduced_on DESC) = 1),
rep AS (SELECT *, count(*) OVER (PARTITION BY pc_base) AS ties FROM top QUALIFY row_number() OVER (PARTITION BY pc_base ORDER BY pc_norm) = 1),
geo AS (SELECT r.*, g.pc_norm AS source_key, CAST(g.zone AS BIGINT) AS source_zone FROM rep r LEFT JOIN newest g ON g.spd_user_type = 'small_user'
   AND g.pc_norm = CASE WHEN r.ties > 1 OR r.tier <> 'A' THEN NULL WHEN r.spd_user_type = 'small_user' THEN r.pc_norm ELSE upper(replace(r.link, ' ', '')) END),
answer AS (SELECT a.id, a.postcode_key,
    CASE WHEN a.postcode_key IS NULL THEN 'missing_postcode' WHEN r.pc_norm IS NULL THEN 'not_found' WHEN r.ties > 1 THEN 'ambiguous_postcode'
      WHEN r.tier <> 'A' THEN 'split_a_missing' WHEN r.spd_user_type = 'large_user' AND r.link = 'NO LINKP' THEN 'po_box'
      WHEN r.spd_user_type = 'large_user' AND coalesce(r.link, 'NO LINK') = 'NO LINK' THEN 'unlinked_large_user'
      WHEN r.source_key IS NULL THEN 'linked_small_user_not_found' WHEN r.spd_user_type = 'large_user' THEN 'linked_small_user'
      WHEN r.pc_norm <> r.pc_base THEN 'a_part' ELSE 'matched' END AS postcode_status,
    r.pc_norm AS matched_pc_norm, r.introduced_on AS matched_introduced_on, r.is_current AS matched_is_current, r.source_key, r.source_zone
  FROM asked a LEFT JOIN geo r ON r.pc_base = a.postcode_key)
"""
LATEST_COLUMNS = ["id", "postcode_key", "postcode_status", "matched_pc_norm", "matched_introduced_on", "matched_is_current", "source_key", "source_zone"]


@query("latest_link", LATEST_SQL + "SELECT " + ", ".join(LATEST_COLUMNS) + " FROM answer")
def _(spark, sf):
    return link_latest(t.cohort(spark, sf), directory(spark, sf), lives=L, source=["zone"]).select(*LATEST_COLUMNS)


@query("latest_link_status", LATEST_SQL + "SELECT postcode_status, count(*) AS n FROM answer GROUP BY 1")
def _(spark, sf):
    return value_counts(link_latest(t.cohort(spark, sf), directory(spark, sf), lives=L, source=["zone"]), "postcode_status", "postcode_status")


@query("one_edition_link", LATEST_SQL + """
SELECT id, postcode_status, 'e2' AS simd_edition, p_size % 7 AS simd_rank, p_retailprice * 2 AS gov_crime_domain_rank
FROM answer LEFT JOIN part ON p_partkey = source_zone""")
def _(spark, sf):
    out = link_latest(t.cohort(spark, sf), history(spark, sf), lives=L, source=["simde2_rank", "simde2_crime_domain_rank"])
    out = edition_measure(out.withColumn("simd_edition", F.lit("e2")), "simd_edition",
                          {"simd_rank": "rank", "gov_crime_domain_rank": "crime_domain_rank"}, TEST, source="source_")
    return out.select("id", "postcode_status", "simd_edition", "simd_rank", "gov_crime_domain_rank")


@query("newest_life_per_key", "WITH " + t.LIVES_SQL + """
SELECT pc_norm, max(introduced_on) AS introduced_on, arg_max(zone, introduced_on) AS zone FROM lives GROUP BY pc_norm""")
def _(spark, sf):
    return newest_lives(directory(spark, sf), L, ["zone"])


@query("latest_per_base", LATEST_SQL + """
SELECT pc_base, pc_norm, introduced_on, CASE WHEN ties > 1 THEN 'ambiguous_postcode' WHEN tier <> 'A' THEN 'split_a_missing' ELSE 'resolved' END AS comparison_status
FROM rep""")
def _(spark, sf):
    return latest_per_base(directory(spark, sf), L).select("pc_base", "pc_norm", "introduced_on", "comparison_status")


# ---- a lookup of whole latest keys ----

MAIN_SQL = LATEST_SQL.rsplit("answer AS", 1)[0].rstrip().rstrip(",") + """,
main AS (SELECT pc_base AS pc_norm, introduced_on, deleted_on, is_current, spd_user_type, link, zone,
   CASE WHEN pc_norm <> pc_base THEN 'Y' ELSE 'N' END AS split FROM rep),
address AS (SELECT pc_norm AS k, zone FROM main WHERE spd_user_type = 'small_user'
   UNION ALL SELECT pc_norm || 'A', zone FROM main WHERE spd_user_type = 'small_user' AND split = 'Y'),
"""


def main_table(spark, sf):
    """One record of every base under its whole key, as a latest-key lookup has it."""
    best = latest_per_base(directory(spark, sf), L, ["zone"])
    return best.select(F.col("pc_base").alias("pc_norm"), "introduced_on", "deleted_on", "is_current", "spd_user_type", "link", "zone",
                       F.when(F.col("pc_norm") != F.col("pc_base"), F.lit("Y")).otherwise(F.lit("N")).alias("SplitIndicator"))


@query("lookup_link_suffix_address", MAIN_SQL + """
answer AS (SELECT a.id, a.postcode_key, m.pc_norm AS matched_pc_norm, CAST(g.zone AS BIGINT) AS source_zone,
   CASE WHEN a.postcode_key IS NULL THEN 'missing_postcode' WHEN m.pc_norm IS NULL THEN 'not_found'
     WHEN m.spd_user_type = 'large_user' AND m.link = 'NO LINKP' THEN 'po_box'
     WHEN m.spd_user_type = 'large_user' AND coalesce(m.link, 'NO LINK') = 'NO LINK' THEN 'unlinked_large_user'
     WHEN g.k IS NULL THEN 'linked_small_user_not_found' WHEN m.spd_user_type = 'large_user' THEN 'linked_small_user'
     WHEN m.split = 'Y' THEN 'a_part' ELSE 'matched' END AS postcode_status
  FROM asked a LEFT JOIN main m ON m.pc_norm = a.postcode_key
  LEFT JOIN address g ON g.k = CASE WHEN m.spd_user_type = 'small_user' THEN m.pc_norm ELSE upper(replace(m.link, ' ', '')) END)
SELECT id, postcode_key, postcode_status, matched_pc_norm, source_zone FROM answer""")
def _(spark, sf):
    out = link_lookup(t.cohort(spark, sf), main_table(spark, sf), lives=L, source=["zone"])
    return out.select("id", "postcode_key", "postcode_status", "matched_pc_norm", "source_zone")


@query("product_agreement", LATEST_SQL.rsplit("answer AS", 1)[0].rstrip().rstrip(",") + """,
current_main AS (SELECT pc_base AS k, max(introduced_on) AS introduced_on, true AS is_current, arg_max(spd_user_type, pc_norm) AS spd_user_type, max(zone) AS zone
   FROM lives WHERE is_current GROUP BY pc_base),
j AS (SELECT m.k AS mk, r.pc_base AS hk, m.introduced_on AS mi, r.introduced_on AS hi, m.is_current AS mc, r.is_current AS hc,
   m.spd_user_type AS mu, r.spd_user_type AS hu, m.zone AS mz, r.zone AS hz,
   CASE WHEN ties > 1 THEN 'ambiguous_postcode' WHEN tier <> 'A' THEN 'split_a_missing' WHEN tier = 'A' THEN 'resolved' END AS st
   FROM current_main m FULL JOIN rep r ON r.pc_base = m.k),
f AS (SELECT *, mk IS NOT NULL AND hk IS NOT NULL AND coalesce(st = 'resolved', false) AS ok FROM j)
SELECT u.section, u.metric, u.value FROM (SELECT unnest([
  {'section': 'grain', 'metric': 'main_rows', 'value': count(mk)}, {'section': 'grain', 'metric': 'history_whole_postcodes', 'value': count(hk)},
  {'section': 'grain', 'metric': 'shared', 'value': count(*) FILTER (mk IS NOT NULL AND hk IS NOT NULL)},
  {'section': 'grain', 'metric': 'only_in_main', 'value': count(*) FILTER (hk IS NULL)}, {'section': 'grain', 'metric': 'only_in_history', 'value': count(*) FILTER (mk IS NULL)},
  {'section': 'unresolved', 'metric': 'ambiguous_postcode', 'value': count(*) FILTER (st = 'ambiguous_postcode')},
  {'section': 'unresolved', 'metric': 'split_a_missing', 'value': count(*) FILTER (st = 'split_a_missing')},
  {'section': 'grain', 'metric': 'shared_resolved', 'value': count(*) FILTER (ok)},
  {'section': 'grain', 'metric': 'shared_and_current_in_both', 'value': count(*) FILTER (ok AND mc AND hc)},
  {'section': 'record', 'metric': 'introduced_on', 'value': count(*) FILTER (ok AND mi IS DISTINCT FROM hi)},
  {'section': 'record', 'metric': 'is_current', 'value': count(*) FILTER (ok AND mc IS DISTINCT FROM hc)},
  {'section': 'record', 'metric': 'spd_user_type', 'value': count(*) FILTER (ok AND mu IS DISTINCT FROM hu)},
  {'section': 'all', 'metric': 'zone', 'value': count(*) FILTER (ok AND mz IS DISTINCT FROM hz)},
  {'section': 'current', 'metric': 'zone', 'value': count(*) FILTER (ok AND mc AND hc AND mz IS DISTINCT FROM hz)}]) AS u FROM f)""")
def _(spark, sf):
    lives = directory(spark, sf)
    main = lives.where("is_current").groupBy(F.col("pc_base").alias("pc_norm")).agg(
        F.max("introduced_on").alias("introduced_on"), F.lit(True).alias("is_current"),
        F.max_by("spd_user_type", "pc_norm").alias("spd_user_type"), F.max("zone").alias("zone"))
    return product_agreement(main, lives, ["zone"], L)


@query("current_candidates", "WITH " + t.LIVES_SQL + "," + t.COHORT_SQL + """,
n AS (SELECT pc_base, count(*) AS c FROM lives WHERE is_current GROUP BY pc_base), keys AS (SELECT DISTINCT postcode FROM cohort)
SELECT postcode, coalesce(c, 0) AS candidate_count, CASE WHEN c IS NULL THEN 'not_found' WHEN c = 1 THEN 'unique' ELSE 'ambiguous' END AS selection_status
FROM keys LEFT JOIN n ON pc_base = upper(replace(postcode, ' ', ''))""")
def _(spark, sf):
    return current_candidates(directory(spark, sf), t.cohort(spark, sf).select("postcode").distinct(), "postcode", L)


# ---- years ----

@query("era_edition_by_year", "WITH " + t.COHORT_SQL + """,
y AS (SELECT id, coalesce(CASE WHEN id % 5 = 0 THEN CAST(1990 + id % 13 AS INT) WHEN id % 31 = 1 THEN 0 WHEN id % 31 = 2 THEN 10000 END, year(address_date)) AS analysis_year FROM cohort),
e(a, b, edition, vintage) AS (VALUES (1996, 1997, 'e1', 2001), (1998, 1999, 'e2', 2001), (2000, 9999, 'e3', 2011)),
v(a, b, version) AS (VALUES (1997, 1999, '1997-1998'), (2000, 9999, '2000'))
SELECT id, CAST(analysis_year AS INT) AS analysis_year, edition AS simd_edition, vintage AS data_zone_vintage, version AS rurality_version,
  CASE WHEN analysis_year IS NULL THEN 'missing_year' WHEN analysis_year < 1 OR analysis_year > 9999 THEN 'invalid_year' WHEN edition IS NULL THEN 'no_edition' ELSE 'ok' END AS edition_status
FROM y LEFT JOIN e ON analysis_year BETWEEN e.a AND e.b LEFT JOIN v ON analysis_year BETWEEN v.a AND v.b""")
def _(spark, sf):
    i = F.col("id")
    override = (F.when(i % 5 == 0, (1990 + i % 13).cast("int")).when(i % 31 == 1, F.lit(0)).when(i % 31 == 2, F.lit(10000)))
    out = t.cohort(spark, sf).withColumn("analysis_year", analysis_year(override, "address_date"))
    out = out.withColumns({"simd_edition": edition_for("analysis_year", TEST), "data_zone_vintage": vintage_for("analysis_year", TEST),
                           "rurality_version": version_for("analysis_year", TEST)})
    out = out.withColumn("edition_status", edition_status("analysis_year", "simd_edition"))
    return out.select("id", "analysis_year", "simd_edition", "data_zone_vintage", "rurality_version", "edition_status")


# ---- one measure attached to events ----

ATTACH_SQL = "WITH " + HISTORY_SQL + "," + t.COHORT_SQL + """,
split_keys AS (SELECT DISTINCT pc_norm FROM history WHERE pc_norm <> pc_base),
route AS (SELECT pc_base AS rk, * FROM history WHERE pc_base NOT IN (SELECT pc_norm FROM split_keys)
  UNION ALL SELECT pc_norm AS rk, * FROM history WHERE pc_norm <> pc_base),
event AS (SELECT *, CASE WHEN id % 4 = 0 THEN postcode_key || 'B' ELSE postcode_key END AS ek FROM asked),
"""


def events(spark, sf):
    """The cohort with every fourth key asked for as a B part."""
    i = F.col("id")
    c = t.cohort(spark, sf)
    return c.withColumn("postcode", F.when(i % 4 == 0, F.concat("postcode", F.lit("B"))).otherwise(F.col("postcode")))


def _attach_sql(dated: bool, value: str, choices: str = "", a_part: bool = True, extra_status: str = "", sig: str | None = None) -> str:
    sig = sig or f"coalesce(CAST({value} AS VARCHAR), '~')"
    valid = ("introduced_on <= e.address_date AND (deleted_on IS NULL OR deleted_on > e.address_date)" if dated else "is_current")
    req = "SELECT DISTINCT ek, address_date FROM event" if dated else "SELECT DISTINCT ek, CAST(NULL AS DATE) AS address_date FROM event"
    gone = "CASE WHEN deleted_on <= e.address_date AND introduced_on < deleted_on THEN deleted_on END" if dated else "CAST(NULL AS DATE)"
    no_date = "WHEN st.ek IS NOT NULL AND e.address_date IS NULL THEN 'missing_date'" if dated else ""
    a_rule = "WHEN kept > 1 AND n_a = 1 THEN 'a_part'" if a_part else ""
    return ATTACH_SQL + f"""
p AS (SELECT e.ek, e.address_date AS ad, r.*, {valid} AS open_then, {gone} AS gone_on, {value} AS val, {sig} AS sig,
   coalesce(r.link, '') NOT IN ('NO LINKP', 'NO LINK') AS in_scope, substr(pc_norm, length(pc_base) + 1) AS part
   FROM ({req}) e JOIN route r ON r.rk = e.ek),
q AS (SELECT *, bool_or(open_then) OVER w AS any_open, max(gone_on) OVER w AS last_gone FROM p WINDOW w AS (PARTITION BY ek, ad)),
s AS (SELECT *, open_then OR (NOT any_open AND coalesce(gone_on = last_gone, false)) AS valid FROM q),
g AS (SELECT ek, ad, bool_or(valid AND NOT any_open) AS from_previous, count(*) FILTER (valid) AS n_valid, count(*) FILTER (valid AND in_scope) AS kept,
   count(*) FILTER (valid AND in_scope AND part = 'A') AS n_a, count(DISTINCT sig) FILTER (valid AND in_scope) AS n_sig,
   arg_min(s, pc_norm) FILTER (valid AND in_scope) AS f, arg_min(s, pc_norm) FILTER (valid AND in_scope AND part = 'A') AS fa FROM s GROUP BY ek, ad),
st AS (SELECT *, CASE {a_rule} WHEN kept > 1 AND n_sig = 1 THEN 'split_consensus' WHEN kept > 1 THEN 'split_conflict' WHEN kept = 1 THEN 'unique'
   WHEN n_valid = 0 THEN 'deleted' ELSE 'not_found' END AS base_status FROM g),
out AS (SELECT e.id, e.address_date, coalesce(CASE {no_date} WHEN from_previous AND base_status IN ('unique', 'a_part', 'split_consensus') THEN 'previous_life' ELSE base_status END, 'not_found') AS status,
   CASE base_status WHEN 'a_part' THEN fa.val WHEN 'unique' THEN f.val WHEN 'split_consensus' THEN f.val END AS val,
   CASE base_status WHEN 'a_part' THEN fa ELSE CASE WHEN base_status IN ('unique', 'split_consensus') THEN f END END AS rec,
   CASE base_status WHEN 'a_part' THEN fa.pc_norm WHEN 'unique' THEN f.pc_norm END AS pc
   FROM event e LEFT JOIN st ON st.ek = e.ek""" + (" AND st.ad IS NOT DISTINCT FROM e.address_date)" if dated else ")")


ATTACH_SELECT = " SELECT id, status AS simd_status, CAST(val AS BIGINT) AS simd_value, pc AS simd_pc_norm FROM out"
ATTACH_COLUMNS = ["id", "simd_status", "simd_value", "simd_pc_norm"]


@query("attach_current", _attach_sql(False, "simde3_rank") + ATTACH_SELECT)
def _(spark, sf):
    return attach(events(spark, sf), history(spark, sf), "postcode", None, "e3", "rank", registry=TEST, lives=L).select(*ATTACH_COLUMNS)


@query("attach_dated", _attach_sql(True, "simde3_rank") + ATTACH_SELECT)
def _(spark, sf):
    return attach(events(spark, sf), history(spark, sf), "postcode", "address_date", "e3", "rank", registry=TEST, lives=L).select(*ATTACH_COLUMNS)


@query("attach_dated_sorted", _attach_sql(True, "simde3_rank") + ATTACH_SELECT)
def _(spark, sf):
    return attach(events(spark, sf), history(spark, sf), "postcode", "address_date", "e3", "rank", registry=TEST, lives=L,
                  strategy="sorted").select(*ATTACH_COLUMNS)


@query("attach_split_report", _attach_sql(True, "simde3_rank", a_part=False) + ATTACH_SELECT)
def _(spark, sf):
    return attach(events(spark, sf), history(spark, sf), "postcode", "address_date", "e3", "rank", registry=TEST, lives=L,
                  split="report").select(*ATTACH_COLUMNS)


@query("attach_unpublished_measure", _attach_sql(True, "CAST(NULL AS DOUBLE)") +
       " SELECT id, status AS simd_status, CAST(NULL AS DOUBLE) AS simd_value, pc AS simd_pc_norm FROM out")
def _(spark, sf):
    return attach(events(spark, sf), history(spark, sf), "postcode", "address_date", "e1", "crime_domain_rank", registry=TEST,
                  lives=L).select(*ATTACH_COLUMNS)


_YEAR = "CASE WHEN year(e.address_date) BETWEEN 1996 AND 1997 THEN {} WHEN year(e.address_date) BETWEEN 1998 AND 1999 THEN {} WHEN year(e.address_date) >= 2000 THEN {} END"


@query("attach_by_era", _attach_sql(True, _YEAR.format("simde1_rank", "simde2_rank", "simde3_rank")) + """
SELECT id, CASE WHEN address_date IS NULL THEN 'missing_date' WHEN year(address_date) < 1996 THEN 'no_edition' ELSE status END AS simd_status,
  CASE WHEN year(address_date) >= 1996 THEN CAST(val AS BIGINT) END AS simd_value, CASE WHEN year(address_date) >= 1996 THEN pc END AS simd_pc_norm,
  CASE WHEN year(address_date) BETWEEN 1996 AND 1997 THEN 'e1' WHEN year(address_date) BETWEEN 1998 AND 1999 THEN 'e2' WHEN year(address_date) >= 2000 THEN 'e3' END AS simd_edition FROM out""")
def _(spark, sf):
    return attach_by_era(events(spark, sf), history(spark, sf), "postcode", "address_date", "rank", registry=TEST,
                         lives=L).select(*ATTACH_COLUMNS, "simd_edition")


_R = "CASE WHEN year(e.address_date) BETWEEN 1997 AND 1999 THEN {} WHEN year(e.address_date) >= 2000 THEN {} END"


@query("attach_rurality", _attach_sql(True, _R.format("r97", "r00"), sig="coalesce(CAST(" + _R.format("r97", "r00") + " AS VARCHAR), '~') || coalesce(" + _R.format("r97s", "r00s") + ", '~')") + """
, named AS (SELECT *, CASE WHEN year(address_date) BETWEEN 1997 AND 1999 THEN rec.r97s WHEN year(address_date) >= 2000 THEN rec.r00s END AS reason FROM out)
SELECT id, CASE WHEN address_date IS NULL THEN 'missing_date' WHEN year(address_date) < 1997 THEN 'before_first_version'
    WHEN status IN ('unique', 'a_part', 'split_consensus', 'previous_life') AND reason IS NOT NULL THEN reason ELSE status END AS rurality_status,
  CASE WHEN year(address_date) >= 1997 THEN CAST(val AS TINYINT) END AS rurality_value,
  CASE WHEN year(address_date) BETWEEN 1997 AND 1999 THEN '1997-1998' WHEN year(address_date) >= 2000 THEN '2000' END AS rurality_version FROM named""")
def _(spark, sf):
    return attach_rurality(events(spark, sf), history(spark, sf), "postcode", "address_date", 6, registry=TEST,
                           lives=L).select("id", "rurality_status", "rurality_value", "rurality_version")
