"""Queries of the build and check operators over the test tables, each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import date_shape_ok, day, is_po_box, normalised, part, request_key, tier, valid_on
from ..functions.values import half_unit, stored, turned, whole
from ..operators import bands as b
from ..operators import digest as g
from ..operators import enrich as en
from ..operators import profile as p
from ..operators import rings as rg
from ..operators import snapshot as sn
from ..operators import spatial as sp
from ..operators import weighted as w
from ..operators.checks import Checks, repeated, summary, union_checks, unique_key, values_within
from ..operators.ordered import falls
from ..registry import EIGHT_TO_SIX, AgreementGate, Edition, Registry, RuralityVersion
from ..sources.binary import read_dbf, read_edges
from . import standin as t
from .groundtruth import band_edges, pick_records
from .publish import scratch_folder

L = t.TEST_LIVES
QUERIES: dict = {}
ORACLE: dict = {}
LIVES = "WITH " + t.LIVES_SQL


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def directory(spark, sf):
    return t.lives(spark, sf).persist()


# ---- keys and dates ----

@query("key_normalise_validate", """
SELECT c_custkey, upper(replace(c_name, ' ', '')) AS key, regexp_full_match(upper(replace(c_name, ' ', '')), '[A-Z]+#[0-9]{9}') AS shaped,
  nullif(upper(replace(repeat(' ', CAST(c_custkey % 3 AS INT)) || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE lower(c_mktsegment) END, ' ', '')), '') AS request_key FROM customer""")
def _(spark, sf):
    c = t.table(spark, sf, "customer")
    i = F.col("c_custkey")
    asked = F.concat(F.repeat(F.lit(" "), (i % 3).cast("int")), F.when(i % 4 == 0, F.lit("")).otherwise(F.lower("c_mktsegment")))
    return c.select("c_custkey", normalised("c_name").alias("key"), normalised("c_name").rlike("^[A-Z]+#[0-9]{9}$").alias("shaped"),
                    request_key(asked).alias("request_key"))


@query("date_parse", """
SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed, true AS shaped FROM orders""")
def _(spark, sf):
    o = t.table(spark, sf, "orders")
    d = F.date_format("o_orderdate", "d/M/yyyy")
    text = F.when(F.col("o_orderkey") % 9 == 0, F.lit("")).when(F.col("o_orderkey") % 2 == 0, F.concat(d, F.lit(" 00:00:00"))).otherwise(d)
    o = o.withColumn("text", text)
    return o.select("o_orderkey", day("text").alias("parsed"), date_shape_ok("text").alias("shaped"))


@query("split_parts_and_tiers", LIVES + """
SELECT substr(pc_norm, length(pc_base) + 1) AS part, CASE WHEN pc_norm = pc_base THEN 'A' ELSE substr(pc_norm, length(pc_base) + 1) END AS tier,
  count(*) AS n, count(*) FILTER (spd_user_type = 'large_user' AND coalesce(link, '') = 'NO LINKP') AS po_boxes FROM lives GROUP BY 1, 2""")
def _(spark, sf):
    return directory(spark, sf).groupBy(part().alias("part"), tier().alias("tier")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_po_box("spd_user_type", "link")).alias("po_boxes"))


@query("valid_on_day", LIVES + """
SELECT spd_user_type, count(*) AS n FROM lives WHERE introduced_on <= DATE '1998-06-15' AND (deleted_on IS NULL OR deleted_on > DATE '1998-06-15') GROUP BY 1""")
def _(spark, sf):
    when = F.lit("1998-06-15").cast("date")
    return p.value_counts(directory(spark, sf).where(valid_on("introduced_on", "deleted_on", when)), "spd_user_type", "spd_user_type")


# ---- profiles ----

@query("directory_profile", LIVES + """
SELECT count(*) AS n_rows, count(*) FILTER (is_current) AS live, count(*) FILTER (NOT is_current) AS deleted,
  count(*) FILTER (spd_user_type = 'small_user') AS small_user, count(*) FILTER (spd_user_type = 'large_user') AS large_user,
  count(*) FILTER (introduced_on = deleted_on) AS same_day, min(introduced_on) AS first_introduced, max(introduced_on) AS last_introduced FROM lives""")
def _(spark, sf):
    return p.directory_profile(directory(spark, sf), L, None)


@query("key_group_sizes", LIVES + """
, n AS (SELECT pc_norm, count(*) AS size FROM lives GROUP BY 1) SELECT size, count(*) AS n_keys FROM n WHERE size >= 2 GROUP BY 1""")
def _(spark, sf):
    return p.group_sizes(directory(spark, sf), "pc_norm")


@query("key_repeats", LIVES + """
, n AS (SELECT pc_norm, count(*) AS c FROM lives GROUP BY 1) SELECT count(*) FILTER (c > 1) AS repeated_keys, max(c) AS max_repeats FROM n""")
def _(spark, sf):
    return p.repeats(directory(spark, sf), "pc_norm")


@query("ambiguous_bases", LIVES + """
, n AS (SELECT pc_base, count(DISTINCT zone) AS c FROM lives WHERE is_current GROUP BY 1) SELECT count(*) FILTER (c > 1) AS ambiguous FROM n""")
def _(spark, sf):
    return p.ambiguous_groups(directory(spark, sf).where("is_current"), "pc_base", "zone")


@query("link_profile", LIVES + """
, small AS (SELECT DISTINCT pc_norm FROM lives WHERE spd_user_type = 'small_user')
SELECT CASE WHEN link IN ('NO LINKP', 'NO LINK') THEN link WHEN s.pc_norm IS NOT NULL THEN 'linked' ELSE 'unresolved' END AS link_class, count(*) AS n
FROM lives l LEFT JOIN small s ON s.pc_norm = upper(replace(l.link, ' ', '')) WHERE l.spd_user_type = 'large_user' GROUP BY 1""")
def _(spark, sf):
    lives = directory(spark, sf)
    links = p.classified_links(lives.where("spd_user_type = 'large_user'"), lives.where("spd_user_type = 'small_user'").select("pc_norm"), "link")
    return p.value_counts(links, "link_class", "link_class")


@query("build_figures", LIVES + """
, small AS (SELECT DISTINCT pc_norm FROM lives WHERE spd_user_type = 'small_user'),
k AS (SELECT CASE WHEN link IN ('NO LINKP', 'NO LINK') THEN link WHEN s.pc_norm IS NOT NULL THEN 'linked' ELSE 'unresolved' END AS c
  FROM lives l LEFT JOIN small s ON s.pc_norm = upper(replace(l.link, ' ', '')) WHERE l.spd_user_type = 'large_user')
SELECT 'totals' AS section, 'all' AS metric, count(*) AS value FROM lives UNION ALL SELECT 'totals', 'live', count(*) FROM lives WHERE is_current
UNION ALL SELECT 'totals', 'deleted', count(*) FROM lives WHERE NOT is_current UNION ALL SELECT 'totals', 'same_day', count(*) FROM lives WHERE introduced_on = deleted_on
UNION ALL SELECT 'user_type', spd_user_type, count(*) FROM lives GROUP BY 2 UNION ALL SELECT 'key_length', CAST(length(pc_norm) AS VARCHAR), count(*) FROM lives GROUP BY 2
UNION ALL SELECT 'links', c, count(*) FROM k GROUP BY 2""")
def _(spark, sf):
    return p.build_figures(directory(spark, sf), L)


BESIDES = LIVES + """
, besides AS (SELECT pc_norm, introduced_on, deleted_on, spd_user_type FROM lives UNION ALL
  SELECT pc_norm, introduced_on, introduced_on, 'large_user' FROM lives WHERE zone % 13 = 0 AND introduced_on IS DISTINCT FROM deleted_on)
"""


def with_days_beside(lives):
    """The directory with same-day records beside some lives that start that day."""
    few = lives.where((F.col("zone") % 13 == 0) & ~F.col("introduced_on").eqNullSafe(F.col("deleted_on")))
    day = few.withColumns({"deleted_on": F.col("introduced_on"), "spd_user_type": F.lit("large_user")})
    return lives.unionByName(day)


@query("interval_touching", BESIDES + """
SELECT a.pc_norm, a.introduced_on AS first_start, a.deleted_on AS meets_on, b.deleted_on AS second_end, a.spd_user_type AS first_role, b.spd_user_type AS second_role
FROM besides a JOIN besides b ON a.pc_norm = b.pc_norm AND a.deleted_on = b.introduced_on AND NOT (a.introduced_on = b.introduced_on AND a.deleted_on IS NOT DISTINCT FROM b.deleted_on)""")
def _(spark, sf):
    return p.touching_pairs(with_days_beside(directory(spark, sf)), L)


@query("interval_transitions", BESIDES + """
SELECT a.spd_user_type || ':' || b.spd_user_type AS transition, count(*) AS pairs
FROM besides a JOIN besides b ON a.pc_norm = b.pc_norm AND a.deleted_on = b.introduced_on AND NOT (a.introduced_on = b.introduced_on AND a.deleted_on IS NOT DISTINCT FROM b.deleted_on) GROUP BY 1""")
def _(spark, sf):
    return p.touching_transitions(with_days_beside(directory(spark, sf)), L)


@query("interval_overlaps", LIVES + """
, r AS (SELECT *, row_number() OVER () AS i, coalesce(deleted_on, DATE '9999-12-31') AS e FROM lives WHERE deleted_on IS NULL OR introduced_on < deleted_on)
SELECT a.pc_base, count(*) AS overlaps FROM r a JOIN r b ON a.pc_base = b.pc_base AND a.i < b.i AND a.introduced_on < b.e AND b.introduced_on < a.e GROUP BY 1""")
def _(spark, sf):
    """By base, where parts do overlap; by full key none may."""
    return p.strict_overlaps(directory(spark, sf), L, ["pc_base"])


@query("overlapping_lives", LIVES + """
, r AS (SELECT *, max(coalesce(deleted_on, DATE '9999-12-31')) OVER (PARTITION BY pc_norm ORDER BY introduced_on ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM lives WHERE deleted_on IS NULL OR introduced_on < deleted_on)
SELECT count(*) FILTER (reach > introduced_on) AS n FROM r""")
def _(spark, sf):
    return p.overlapping_lives(directory(spark, sf), L).agg(F.count(F.lit(1)).alias("n"))


# ---- bands ----

def zones(spark, sf):
    return t.table(spark, sf, "part").select(F.col("p_partkey").alias("dz_code"), F.col("p_retailprice").alias("rank"), F.col("p_size").alias("population"),
                                             F.col("p_brand").alias("area"))


def _bands_sql(k):
    return f"""
WITH blocks AS (SELECT p_retailprice AS rank, CAST(sum(p_size) AS BIGINT) AS block FROM part GROUP BY 1),
run AS (SELECT rank, block, CAST(sum(block) OVER (ORDER BY rank) AS BIGINT) AS upto, CAST(sum(block) OVER () AS BIGINT) AS total FROM blocks),
cut AS (SELECT rank, CAST(least({k}, greatest(1, ((2 * upto - block) * {k} + 2 * total - 1) // (2 * total))) AS INT) AS band FROM run)
"""


@query("population_bands_quintile", _bands_sql(5) + "SELECT p_partkey AS dz_code, band FROM part JOIN cut ON rank = p_retailprice")
def _(spark, sf):
    return w.population_bands(zones(spark, sf), [], "rank", "population", {"band": 5}).select("dz_code", "band")


@query("population_bands_decile", _bands_sql(10) + "SELECT p_partkey AS dz_code, band FROM part JOIN cut ON rank = p_retailprice")
def _(spark, sf):
    return w.population_bands(zones(spark, sf), [], "rank", "population", {"band": 10}).select("dz_code", "band")


@query("population_bands_by_area", """
WITH blocks AS (SELECT p_brand AS area, p_retailprice AS rank, CAST(sum(p_size) AS BIGINT) AS block FROM part GROUP BY 1, 2),
run AS (SELECT *, CAST(sum(block) OVER (PARTITION BY area ORDER BY rank) AS BIGINT) AS upto, CAST(sum(block) OVER (PARTITION BY area) AS BIGINT) AS total FROM blocks)
SELECT p_partkey AS dz_code, CAST(greatest(1, least(5, ((2 * upto - block) * 5 + 2 * total - 1) // (2 * total))) AS INT) AS quintile,
  CAST(greatest(1, least(10, ((2 * upto - block) * 10 + 2 * total - 1) // (2 * total))) AS INT) AS decile
FROM part JOIN run ON area = p_brand AND rank = p_retailprice""")
def _(spark, sf):
    return w.population_bands(zones(spark, sf), ["area"], "rank", "population", {"quintile": 5, "decile": 10}).select("dz_code", "quintile", "decile")


@query("band_share_deviation", _bands_sql(10) + """
, s AS (SELECT band, sum(p_size) AS people FROM part JOIN cut ON rank = p_retailprice GROUP BY 1)
SELECT round(max(abs(people / (SELECT sum(p_size) FROM part) * 100 - 10)), 4) AS max_share_deviation_pp FROM s""")
def _(spark, sf):
    cut = w.population_bands(zones(spark, sf), [], "rank", "population", {"band": 10})
    return w.share_deviation(cut, [], "band", "population", 10)


@query("band_inversion", """
SELECT p_partkey AS dz_code, CAST(11 - (p_size % 10 + 1) AS INT) AS decile, CAST(p_size % 10 + 1 AS INT) AS as_published, p_retailprice % 1 = 0 AS is_whole,
  (p_retailprice * 2) % 1 = 0 AS is_half_unit FROM part""")
def _(spark, sf):
    d = (F.col("p_size") % 10 + 1).cast("int")
    return t.table(spark, sf, "part").select(F.col("p_partkey").alias("dz_code"), turned(d, 10).alias("decile"), turned(d, 10, False).alias("as_published"),
                                             whole("p_retailprice").alias("is_whole"), half_unit("p_retailprice").alias("is_half_unit"))


@query("band_monotone_violations", """
WITH o AS (SELECT p_brand AS area, p_size, lag(p_size) OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_size) AS prev FROM part)
SELECT area, count(*) FILTER (p_size < prev) AS falls FROM o GROUP BY 1""")
def _(spark, sf):
    return falls(zones(spark, sf), ["area"], "rank", "population")


@query("rank_dense_check", """
SELECT p_partkey // 1000 AS area, min(p_partkey % 1000 + 1) = 1 AND max(p_partkey % 1000 + 1) = count(*) AND count(DISTINCT p_partkey % 1000) = count(*) AS dense,
  count(DISTINCT p_size) = count(*) AS size_unique FROM part GROUP BY 1""")
def _(spark, sf):
    r = (F.col("p_partkey") % 1000 + 1)
    n = F.count(F.lit(1))
    return t.table(spark, sf, "part").groupBy(F.floor(F.col("p_partkey") / 1000).alias("area")).agg(
        ((F.min(r) == 1) & (F.max(r) == n) & (F.count_distinct(r) == n)).alias("dense"), (F.count_distinct(F.col("p_size")) == n).alias("size_unique"))


@query("tied_ranks", "WITH v AS (SELECT p_size, count(*) AS c FROM part GROUP BY 1) SELECT count(*) FILTER (c > 1) AS tied_values FROM v")
def _(spark, sf):
    return p.tied_values(t.table(spark, sf, "part"), "p_size")


@query("split_ties", """
WITH v AS (SELECT p_brand, p_size, count(DISTINCT p_partkey % 10) AS c FROM part GROUP BY 1, 2) SELECT p_brand AS area, count(*) FILTER (c > 1) AS split_ties FROM v GROUP BY 1""")
def _(spark, sf):
    z = zones(spark, sf).withColumn("band", F.col("dz_code") % 10)
    return p.split_ties(z, ["area"], "population", "band")


@query("pivot_long_measurements", """
SELECT l_partkey AS zone, l_linestatus AS domain, max(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS "A",
  max(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS "N", max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS "R" FROM lineitem GROUP BY 1, 2""")
def _(spark, sf):
    return (t.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("zone"), F.col("l_linestatus").alias("domain"))
            .pivot("l_returnflag", ["A", "N", "R"]).agg(F.max("l_quantity")))


@query("pinned_exception_match", """
WITH found AS (SELECT p_partkey AS zone, CAST(p_size AS DOUBLE) AS ours, CASE WHEN p_partkey % 17 = 0 THEN p_size + 1.0 ELSE p_size END AS theirs FROM part),
f AS (SELECT * FROM found WHERE ours <> theirs), pin AS (SELECT p_partkey AS zone, CAST(p_size AS DOUBLE) AS ours, p_size + 1.0 AS theirs FROM part WHERE p_partkey % 17 = 0 AND p_partkey % 5 <> 0)
SELECT coalesce(f.zone, pin.zone) AS zone, coalesce(f.ours = pin.ours AND f.theirs = pin.theirs, false) AS as_pinned FROM f FULL JOIN pin ON f.zone = pin.zone""")
def _(spark, sf):
    z = t.table(spark, sf, "part").select(F.col("p_partkey").alias("zone"), F.col("p_size").cast("double").alias("ours"))
    k = F.col("zone")
    found = z.withColumn("theirs", F.when(k % 17 == 0, F.col("ours") + 1).otherwise(F.col("ours"))).where("ours <> theirs")
    pinned = z.where((k % 17 == 0) & (k % 5 != 0)).withColumn("theirs", F.col("ours") + 1)
    return b.pinned_match(found, pinned, ["zone"], ["ours", "theirs"]).select("zone", "as_pinned")


@query("published_rank_agreement", """
SELECT p_partkey AS dz_code, p_size + 0.5 AS shapefile_rank, CASE WHEN p_partkey % 3 = 0 THEN p_size + 1.0 ELSE p_size + 0.0 END AS published_rank
FROM part WHERE p_partkey % 3 <> 0""")
def _(spark, sf):
    """Half ranks published rounded up agree; the rest are listed with both ranks."""
    k, half = F.col("p_partkey"), F.col("p_size") + 0.5
    pairs = t.table(spark, sf, "part").select(k.alias("dz_code"), F.lit("income").alias("domain"), half.alias("ours"),
                                              F.when(k % 3 == 0, half + 0.5).otherwise(half - 0.5).alias("Rank"))
    return b.rank_disagreements(pairs, "rounded_up").drop("domain")


@query("two_source_rank_check", """
WITH s AS (SELECT l_partkey AS z, CAST(max(l_quantity) AS INT) AS r FROM lineitem GROUP BY 1)
SELECT count(*) FILTER (s.z IS NULL OR p_partkey IS NULL) AS unmatched, count(*) FILTER (s.z IS NOT NULL AND p_partkey IS NOT NULL AND r <> p_size) AS differing,
  count(*) FILTER (s.z IS NOT NULL AND p_partkey IS NOT NULL) AS shared FROM part FULL JOIN s ON s.z = p_partkey""")
def _(spark, sf):
    a = t.table(spark, sf, "part").select(F.col("p_partkey").alias("z"), F.col("p_size").alias("_a"))
    s = t.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("z")).agg(F.max("l_quantity").cast("int").alias("_b"))
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return a.join(s, "z", "full_outer").agg(F.count_if(~both).alias("unmatched"), F.count_if(both & (F.col("_a") != F.col("_b"))).alias("differing"),
                                            F.count_if(both).alias("shared"))


@query("boundary_cases", _bands_sql(10) + """
, z AS (SELECT p_partkey, p_retailprice AS r, band FROM part JOIN cut ON rank = p_retailprice)
SELECT band AS value, 'first' AS edge, arg_min(p_partkey, (r, p_partkey)) AS dz_code, min(r) AS rank FROM z GROUP BY 1
UNION ALL SELECT band, 'last', arg_max(p_partkey, (r, p_partkey)), max(r) FROM z GROUP BY 1""")
def _(spark, sf):
    cut = w.population_bands(zones(spark, sf), [], "rank", "population", {"band": 10})
    return band_edges(cut, [], "band").select("value", "edge", "dz_code", "rank")


@query("boundary_postcodes", LIVES + """
, c AS (SELECT zone, pc_norm, max(introduced_on) AS introduced_on, min(CASE WHEN is_current AND spd_user_type = 'small_user' AND pc_norm = pc_base
    AND coalesce(link, '') NOT IN ('NO LINK', 'NO LINKP') THEN 0 WHEN is_current THEN 1 ELSE 2 END) AS stage FROM lives GROUP BY 1, 2)
SELECT zone, arg_min(pc_norm, (stage, sha256(pc_norm || '|2026'))) AS pc_norm, CASE min(stage) WHEN 0 THEN 'current_ordinary' WHEN 1 THEN 'current_any' ELSE 'deleted_any' END AS selection
FROM c GROUP BY 1""")
def _(spark, sf):
    return pick_records(directory(spark, sf), "zone", 2026, L).select("zone", "pc_norm", "selection")


# ---- enrichment ----

@query("enrich_zone_ladder", """
SELECT l_orderkey * 10 + l_linenumber AS id, p.p_size AS e1_population, p.p_brand AS e1_area, q.p_retailprice AS e2_rank
FROM lineitem LEFT JOIN part p ON p.p_partkey = l_partkey LEFT JOIN part q ON q.p_partkey = l_suppkey""")
def _(spark, sf):
    rows = t.table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "l_partkey", "l_suppkey")
    z = zones(spark, sf)
    out = en.join_edition(rows, z, "l_partkey", ["population", "area"], "e1_")
    return en.join_edition(out, z, "l_suppkey", ["rank"], "e2_").select("id", "e1_population", "e1_area", "e2_rank")


@query("enrich_checks", """
WITH j AS (SELECT l_partkey, p_partkey, p_size FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)
SELECT 'rows' AS name, count(*) = (SELECT count(*) FROM lineitem) AS passed, CAST(count(*) AS VARCHAR) AS actual FROM j
UNION ALL SELECT 'empty_cells', count(*) FILTER (p_size IS NULL) = 0, CAST(count(*) FILTER (p_size IS NULL) AS VARCHAR) FROM j
UNION ALL SELECT 'population.range', count(*) FILTER (NOT coalesce(p_size BETWEEN 1 AND 40, false)) = 0, CAST(count(*) FILTER (NOT coalesce(p_size BETWEEN 1 AND 40, false)) AS VARCHAR) FROM j""")
def _(spark, sf):
    rows = t.table(spark, sf, "lineitem").select("l_partkey")
    out = en.join_edition(rows, zones(spark, sf), "l_partkey", ["population"], "")
    n = rows.count()
    return Checks().rows(n).required(["population"], "empty_cells").between("population", 1, 40).run(out).select("name", "passed", "actual")


@query("union_structural_nulls", """
SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS phone, 'small_user' AS role FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, '', 'large_user' FROM supplier""")
def _(spark, sf):
    a = t.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.lit("small_user").alias("role"))
    s = t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.lit("").alias("phone"), F.lit("large_user").alias("role"))
    return a.unionByName(s, allowMissingColumns=True)


ZONE = "zone"
TRACE = Registry(editions=(Edition(key="e1", vintage=2001, rows=0, first_year=1996, last_year=1999, domains=("income",)),
                           Edition(key="e2", vintage=2011, rows=0, first_year=2000, last_year=9999, domains=("income", "crime"), status_domains=("crime",))))


def source_value(edition: int, k: int, measure: str, zone: str) -> str:
    """What a zone's row holds, in words of both engines: some ranks are missing, and a status is text."""
    if measure.endswith("_source_status"):
        return f"CASE WHEN {zone} % 5 = 1 THEN 'rank_sources_disagree' END"
    gap = f"{zone} % 19 <> {k % 19}" if measure.endswith("rank") else f"{zone} IS NOT NULL"
    return f"CASE WHEN {gap} THEN CAST(({zone} * {k + 3}) % 89 + {edition} AS DOUBLE) / 2 END"


def saved_value(edition: int, k: int, measure: str, zone: str) -> str:
    """What a record has saved: its zone's value, but for one record in 97 and measure, which has another or none."""
    wrong = "NULL" if k % 2 else ("'?'" if measure.endswith("_source_status") else "CAST(-1 AS DOUBLE)")
    return f"CASE WHEN {zone} % 97 = {(k * 7 + edition) % 97} THEN {wrong} ELSE {source_value(edition, k, measure, zone)} END"


def trace_tables(spark, sf):
    """A table of records with measures of two editions attached, and the two publishers' long tables they came from."""
    zone = t.table(spark, sf, "part").select(F.col("p_partkey").alias("zone"))
    of = lambda names: en.stacked([zone.select(F.lit(e.key).alias("edition"), F.concat(F.lit("Z"), F.col("zone").cast("string")).alias("dz_code"), *[
        F.expr(source_value(i, k, m, "zone")).alias(m) for k, m in enumerate(e.measures()) if m in names(e)]) for i, e in enumerate(TRACE.editions)])
    saved = directory(spark, sf).select("pc_norm", "introduced_on", *[F.concat(F.lit("Z"), F.col("zone").cast("string")).alias(f"DataZone{e.vintage}Code") for e in TRACE.editions], *[
        F.expr(saved_value(i, k, m, "zone")).alias(e.column(m)) for i, e in enumerate(TRACE.editions) for k, m in enumerate(e.measures())])
    return saved, of(lambda e: e.service_measures()), of(lambda e: e.government_measures())


def _trace_sql(where: str, columns: str) -> str:
    """Cell by cell; zones that have no row have no source."""
    cells = []
    for i, e in enumerate(TRACE.editions):
        for k, m in enumerate(e.measures()):
            text = m.endswith("_source_status")
            cells.append(f"SELECT pc_norm, introduced_on, '{e.key}' AS edition, 'Z' || zone AS dz_code, '{m}' AS measure, {'NULL' if text else saved_value(i, k, m, 'zone')} AS a, "
                         f"{'NULL' if text else f'CASE WHEN p_partkey IS NOT NULL THEN {source_value(i, k, m, ZONE)} END'} AS b, "
                         f"{saved_value(i, k, m, 'zone') if text else 'NULL'} AS ta, {f'CASE WHEN p_partkey IS NOT NULL THEN {source_value(i, k, m, ZONE)} END' if text else 'NULL'} AS tb "
                         "FROM lives LEFT JOIN part ON p_partkey = zone")
    return LIVES + "SELECT pc_norm, introduced_on, edition, dz_code, measure, " + columns + " FROM (" + " UNION ALL ".join(cells) + ") WHERE " + where


SAVED_SQL = "CASE WHEN ta IS NOT NULL THEN ta ELSE CAST(a AS VARCHAR) END AS saved, CASE WHEN tb IS NOT NULL THEN tb ELSE CAST(b AS VARCHAR) END AS source"


@query("trace_records", _trace_sql("pc_norm IN (SELECT pc_norm FROM lives WHERE spd_user_type = 'large_user' AND is_current)", SAVED_SQL + ", a IS NOT DISTINCT FROM b AND ta IS NOT DISTINCT FROM tb AS same"))
def _(spark, sf):
    """Every attached value of the records of some keys beside its source's, looked up again."""
    saved, service, gov = trace_tables(spark, sf)
    keys = directory(spark, sf).where("spd_user_type = 'large_user' and is_current").select("pc_norm").distinct()
    return en.traced(saved.join(keys, "pc_norm", "left_semi"), service, gov, saved, ["pc_norm", "introduced_on"], TRACE)


@query("relookup_unequal", _trace_sql("a IS DISTINCT FROM b OR ta IS DISTINCT FROM tb", SAVED_SQL))
def _(spark, sf):
    """Every attached value of every record that is not its source's."""
    return en.unequal_cells(*trace_tables(spark, sf), ["pc_norm", "introduced_on"], TRACE)


# ---- snapshots ----

def _after(spark, sf):
    o = t.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.where(k % 13 != 0).withColumns({
        "o_orderkey": F.when(k % 29 == 0, k + 100000000).otherwise(k), "o_orderstatus": F.when(k % 7 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")),
        "o_orderpriority": F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))})


AFTER_SQL = """WITH a AS (SELECT CASE WHEN o_orderkey % 29 = 0 THEN o_orderkey + 100000000 ELSE o_orderkey END AS o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice, o_orderdate, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 13 <> 0),
j AS (SELECT o.o_orderkey AS ok, a.o_orderkey AS ak, o.o_orderstatus IS DISTINCT FROM a.o_orderstatus AS ds, o.o_orderpriority IS DISTINCT FROM a.o_orderpriority AS dp
  FROM orders o FULL JOIN a ON a.o_orderkey = o.o_orderkey)
"""


@query("snapshot_diff", AFTER_SQL + """SELECT count(*) FILTER (ok IS NULL) AS added_records, count(*) FILTER (ak IS NULL) AS removed_records,
  count(*) FILTER (ok IS NOT NULL AND ak IS NOT NULL) AS common_records, count(*) FILTER (ok IS NOT NULL AND ak IS NOT NULL AND (ds OR dp)) AS changed_records, 0 AS newly_deleted_records FROM j""")
def _(spark, sf):
    return sn.snapshot_diff(t.table(spark, sf, "orders"), _after(spark, sf), ["o_orderkey"])


@query("snapshot_changed_fields", AFTER_SQL + """SELECT 'o_orderstatus' AS field, count(*) FILTER (ok IS NOT NULL AND ak IS NOT NULL AND ds) AS changed FROM j
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (ok IS NOT NULL AND ak IS NOT NULL AND dp) FROM j""")
def _(spark, sf):
    return sn.changed_fields(t.table(spark, sf, "orders"), _after(spark, sf), ["o_orderkey"])


@query("snapshot_report", AFTER_SQL + """SELECT 'compared' AS status, CAST(NULL AS VARCHAR) AS reason, count(*) FILTER (ok IS NULL) AS added_records, count(*) FILTER (ak IS NULL) AS removed_records,
  count(*) FILTER (ok IS NOT NULL AND ak IS NOT NULL) AS common_records, count(*) FILTER (ok IS NOT NULL AND ak IS NOT NULL AND (ds OR dp)) AS changed_records,
  'o_orderpriority ' || count(*) FILTER (ok IS NOT NULL AND ak IS NOT NULL AND dp) || ', o_orderstatus ' || count(*) FILTER (ok IS NOT NULL AND ak IS NOT NULL AND ds) AS fields,
  'o_more' AS added_columns, 'o_clerk' AS removed_columns FROM j""")
def _(spark, sf):
    """The whole comparison of two snapshots in one row, lists as text."""
    before = t.table(spark, sf, "orders").withColumn("o_clerk", F.lit("c"))
    out = sn.compare_with_previous(before, _after(spark, sf).withColumn("o_more", F.lit(1)), ["o_orderkey"])
    fields = F.array_sort(F.transform("fields", lambda f: F.concat(f["field"], F.lit(" "), f["changed"].cast("string"))))
    return out.select("status", "reason", "added_records", "removed_records", "common_records", "changed_records", F.array_join(fields, ", ").alias("fields"),
                      F.array_join("added_columns", ",").alias("added_columns"), F.array_join("removed_columns", ",").alias("removed_columns"))


@query("key_difference", """SELECT count(*) FILTER (p IS NULL) AS only_left, count(*) FILTER (z IS NULL) AS only_right, count(*) FILTER (p IS NOT NULL AND z IS NOT NULL) AS both
FROM (SELECT DISTINCT l_partkey + 3 AS z FROM lineitem) l FULL JOIN (SELECT p_partkey AS p FROM part) r ON z = p""")
def _(spark, sf):
    left = t.table(spark, sf, "lineitem").select((F.col("l_partkey") + 3).alias("z"))
    return sn.key_difference(left, t.table(spark, sf, "part").select(F.col("p_partkey").alias("z")), ["z"])


# ---- digest, export, load ----

SUPPLIER = g.ExportContract(fields=(("s_suppkey", "string", False), ("s_name", "string", False), ("s_nationkey", "int8", True), ("half", "rank", True), ("live", "bool", False), ("since", "date32", True)), key=("s_suppkey",))


def _supplier(spark, sf):
    k = F.col("s_suppkey")
    return t.table(spark, sf, "supplier").select(
        k.cast("string").alias("s_suppkey"), "s_name", F.col("s_nationkey").cast("tinyint").alias("s_nationkey"), (k / 2).alias("half"), (k % 2 == 0).alias("live"),
        F.date_add(F.lit("2000-01-01").cast("date"), (k % 3650).cast("int")).alias("since"))


DIGEST_SQL = """SELECT count(*) AS n_rows, CAST(sum(CASE WHEN u >= 9223372036854775808 THEN u - 18446744073709551616 ELSE u END) AS VARCHAR) AS total
FROM (SELECT CAST(CAST('0x' || substr(sha256({line}), 1, 16) AS UBIGINT) AS HUGEINT) AS u FROM {table})"""


@query("row_digest_part", DIGEST_SQL.format(line="concat_ws(chr(31), CAST(p_partkey AS VARCHAR), p_name, p_brand, CAST(p_size AS VARCHAR), printf('%.1f', p_retailprice))", table="part"))
def _(spark, sf):
    c = g.ExportContract(fields=(("p_partkey", "long", False), ("p_name", "string", False), ("p_brand", "string", False), ("p_size", "long", False), ("p_retailprice", "rank", False)), key=("p_partkey",))
    return g.row_digest(g.render(t.table(spark, sf, "part"), c))


@query("row_digest_lineitem", DIGEST_SQL.format(line="concat_ws(chr(31), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), l_returnflag, strftime(l_shipdate, '%Y-%m-%d'))", table="lineitem"))
def _(spark, sf):
    c = g.ExportContract(fields=(("l_orderkey", "long", False), ("l_linenumber", "long", False), ("l_returnflag", "string", False), ("l_shipdate", "date32", False)), key=("l_orderkey",))
    return g.row_digest(g.render(t.table(spark, sf, "lineitem"), c))


@query("render_supplier", """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey, printf('%.1f', s_suppkey / 2.0) AS half,
  CASE WHEN s_suppkey % 2 = 0 THEN '1' ELSE '0' END AS live, strftime(DATE '2000-01-01' + CAST(s_suppkey % 3650 AS INT), '%Y-%m-%d') AS since FROM supplier""")
def _(spark, sf):
    return g.render(_supplier(spark, sf), SUPPLIER)


@query("typed_load_restore", """SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 3 = 1 THEN '' ELSE s_name END AS note, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_name END AS never_blank,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 5 = 1 THEN NULL ELSE CAST((s_suppkey % 10000) / 2.0 AS DECIMAL(6, 1)) END AS rank, CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE DATE '2000-01-01' + CAST(s_suppkey % 3650 AS INT) END AS since,
  s_suppkey % 2 = 0 AS live FROM supplier""")
def _(spark, sf):
    """Text cells back to types: a blank is null for the role a column does not exist for, else a blank;
    a rank with two decimals is refused."""
    k = F.col("s_suppkey")
    text = t.table(spark, sf, "supplier").select(
        "s_suppkey", F.when(k % 3 == 0, F.lit("large_user")).otherwise(F.lit("small_user")).alias("role"), F.when(k % 3 == 2, F.col("s_name")).otherwise(F.lit("")).alias("note"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.col("s_name")).alias("never_blank"),
        F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.concat((k % 10000).cast("string"), F.lit(".54"))).otherwise(F.format_string("%.1f", (k % 10000) / 2)).alias("rank"),
        F.when(k % 6 == 0, F.lit("")).otherwise(F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), (k % 3650).cast("int")), "yyyy-MM-dd")).alias("since"),
        F.when(k % 2 == 0, F.lit("1")).otherwise(F.lit("0")).alias("live"))
    return text.select("s_suppkey", stored("note", "string", role="role", null_for_role="large_user").alias("note"), stored("never_blank", "string", blank_is_null=True).alias("never_blank"),
                       stored("rank", "rank").alias("rank"), stored("since", "date32").alias("since"), stored("live", "bool").alias("live"))


@query("loaded_table_check", """SELECT 'loaded.columns' AS name, true AS passed UNION ALL SELECT 'loaded.key_unique', count(*) = count(DISTINCT p_partkey) FROM part UNION ALL SELECT 'loaded.key_nonnull', count(*) = count(p_partkey) FROM part
UNION ALL SELECT 'loaded.p_partkey.reserved_characters', true UNION ALL SELECT 'loaded.p_name.reserved_characters', count(*) FILTER (p_partkey % 40 = 3) = 0 FROM part UNION ALL SELECT 'loaded.rows', count(*) = count(p_partkey) FROM part
UNION ALL SELECT 'loaded.digest', count(*) FILTER (p_partkey % 40 = 3 OR p_partkey % 50 = 7 AND p_size <> 1) = 0 FROM part""")
def _(spark, sf):
    """A loaded copy against the row count and digest of the exported table: some sizes were changed on the way, some names hold a character of the framing."""
    k = F.col("p_partkey")
    n = t.table(spark, sf, "part").select(k.cast("string").alias("p_partkey"), "p_name", F.col("p_size").cast("tinyint").alias("p_size"))
    c = g.ExportContract(fields=(("p_partkey", "string", False), ("p_name", "string", False), ("p_size", "int8", False)), key=("p_partkey",))
    exported = g.row_digest(g.render(n, c)).first()
    loaded = n.withColumns({"p_size": F.when(k % 50 == 7, F.lit(1)).otherwise(F.col("p_size")).cast("tinyint"),
                            "p_name": F.when(k % 40 == 3, F.concat("p_name", F.lit("\x1f"))).otherwise(F.col("p_name"))})
    return g.loaded_table(loaded, c, exported["n_rows"], exported["total"]).select("name", "passed")


@query("cell_readback", """SELECT 'csv.header' AS name, true AS passed, CAST(NULL AS VARCHAR) AS differing UNION ALL SELECT 'csv.rows', true, '0'
UNION ALL SELECT 'csv.o_orderstatus.cells', count(*) FILTER (o_orderkey % 97 = 0 AND o_orderstatus <> 'Z') = 0, CAST(count(*) FILTER (o_orderkey % 97 = 0 AND o_orderstatus <> 'Z') AS VARCHAR) FROM orders
UNION ALL SELECT 'csv.o_comment.cells', true, '0'""")
def _(spark, sf):
    """A CSV written to the shared folder and read again, cell by cell, against a table of which some cells differ: quotes, commas and blanks are kept."""
    k = F.col("o_orderkey")
    o = t.table(spark, sf, "orders").select(k.cast("string").alias("o_orderkey"), "o_orderstatus", F.when(k % 3 == 0, F.lit("")).otherwise(
        F.concat(F.lit('a "quoted", '), F.col("o_orderpriority"))).alias("o_comment"), F.lit("x").alias("o_hidden"))
    c = g.ExportContract(fields=tuple((n, "string", True) for n in o.columns), key=("o_orderkey",), exclude=("o_hidden",))
    path = f"{scratch_folder(spark)}/csv"
    g.write_csv(o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 97 == 0, F.lit("Z")).otherwise(F.col("o_orderstatus"))), c, path)
    out = g.cells_equal(g.read_csv(spark, c, path), g.render(o, c, ""), ["o_orderkey"])
    return out.select("name", "passed", F.when(F.col("name") != "csv.header", F.col("actual")).alias("differing"))


LOADED = g.ExportContract(fields=(("s_suppkey", "string", False), ("role", "string", False), ("note", "string", True), ("always", "string", True), ("half", "rank", True),
                                  ("since", "date32", True), ("size", "int16", True), ("live", "bool", False), ("hidden", "string", True)),
                          key=("s_suppkey",), exclude=("hidden",), role_column="role", null_for_role={"note": "large_user"}, empty_is_null=("always",))
LOADED_SQL = """exported AS (SELECT CAST(k AS VARCHAR) AS s_suppkey, CASE WHEN k % 3 = 0 THEN 'large_user' ELSE 'small_user' END AS role,
  CASE WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN '' ELSE s_name || ', "x"' END AS note, CASE WHEN k % 4 = 0 THEN NULL ELSE s_name END AS always,
  CASE WHEN k % 5 <> 0 THEN (k % 10000) / 2.0 END AS half, CASE WHEN k % 6 <> 0 THEN DATE '2000-01-01' + CAST(k % 3650 AS INT) END AS since,
  CASE WHEN k % 7 <> 0 THEN CAST(k % 30000 AS SMALLINT) END AS size, k % 2 = 0 AS live, k % 11 = 4 AS spoilt FROM (SELECT *, s_suppkey AS k FROM supplier))"""


def loaded(spark, sf):
    """Suppliers exported as CSV, some with a cell that is no date, and loaded again: the contract's digest, and what the load gives."""
    k = F.col("s_suppkey")
    rows = t.table(spark, sf, "supplier").select(
        k.cast("string").alias("s_suppkey"), F.when(k % 3 == 0, F.lit("large_user")).otherwise(F.lit("small_user")).alias("role"),
        F.when(k % 3 == 1, F.lit("")).when(k % 3 == 2, F.concat("s_name", F.lit(', "x"'))).alias("note"), F.when(k % 4 != 0, F.col("s_name")).alias("always"),
        F.when(k % 5 != 0, k % 10000 / 2).alias("half"), F.when(k % 6 != 0, F.date_add(F.lit("2000-01-01").cast("date"), (k % 3650).cast("int"))).alias("since"),
        F.when(k % 7 != 0, k % 30000).cast("smallint").alias("size"), (k % 2 == 0).alias("live"), F.lit("h").alias("hidden"))
    exported = g.row_digest(g.render(rows, LOADED)).first()
    folder = scratch_folder(spark)
    spoilt = rows.withColumn("since", F.when(k % 11 == 4, F.lit("30 June")).otherwise(F.date_format("since", "yyyy-MM-dd")))
    as_text = g.ExportContract(**{**LOADED.__dict__, "fields": tuple((n, "string" if n == "since" else kind, null) for n, kind, null in LOADED.fields)})
    g.write_csv(spoilt, as_text, f"{folder}/csv")
    return exported, g.load_csv(spark, LOADED, f"{folder}/csv", f"{folder}/loaded")


@query("csv_load", "WITH " + LOADED_SQL + " SELECT s_suppkey, role, note, always, CAST(half AS DECIMAL(6, 1)) AS half, since, size, live FROM exported WHERE NOT spoilt")
def _(spark, sf):
    return loaded(spark, sf)[1][0]


@query("csv_load_refused", "WITH " + LOADED_SQL + " SELECT s_suppkey, '30 June' AS since, 'since' AS refused FROM exported WHERE spoilt")
def _(spark, sf):
    return loaded(spark, sf)[1][1].select("s_suppkey", "since", F.array_join("refused", ",").alias("refused"))


@query("csv_load_checks", "WITH " + LOADED_SQL + """,
line AS (SELECT spoilt, concat_ws(chr(31), s_suppkey, role, coalesce(note, chr(0)), coalesce(always, chr(0)), coalesce(printf('%.1f', half), chr(0)), coalesce(CAST(since AS VARCHAR), chr(0)),
  coalesce(CAST(size AS VARCHAR), chr(0)), CASE WHEN live THEN '1' ELSE '0' END) AS l FROM exported),
u AS (SELECT spoilt, CAST(CAST('0x' || substr(sha256(l), 1, 16) AS UBIGINT) AS HUGEINT) AS u FROM line),
d AS (SELECT spoilt, CASE WHEN u >= 9223372036854775808 THEN u - 18446744073709551616 ELSE u END AS d FROM u)
SELECT 'load.rows' AS name, count(*) FILTER (spoilt) = 0 AS passed, CAST(count(*) AS VARCHAR) AS expected, CAST(count(*) FILTER (NOT spoilt) AS VARCHAR) AS actual FROM d
UNION ALL SELECT 'load.total', sum(d) = sum(d) FILTER (NOT spoilt), CAST(sum(d) AS VARCHAR), CAST(sum(d) FILTER (NOT spoilt) AS VARCHAR) FROM d
UNION ALL SELECT 'load.cut_wrongly', true, '0', '0' UNION ALL SELECT 'load.refused', count(*) FILTER (spoilt) = 0, '0', CAST(count(*) FILTER (spoilt) AS VARCHAR) FROM d""")
def _(spark, sf):
    exported, (_, _, observed) = loaded(spark, sf)
    return g.load_checks(spark, observed, exported["n_rows"], exported["total"]).select("name", "passed", "expected", "actual")


# ---- checks ----

@query("quality_checks", LIVES + """
SELECT 'key_nonnull' AS name, count(*) FILTER (pc_norm IS NULL OR introduced_on IS NULL) = 0 AS passed, CAST(count(*) FILTER (pc_norm IS NULL OR introduced_on IS NULL) AS VARCHAR) AS actual FROM lives
UNION ALL SELECT 'deleted_before_introduced', count(*) FILTER (deleted_on < introduced_on) = 0, CAST(count(*) FILTER (deleted_on < introduced_on) AS VARCHAR) FROM lives
UNION ALL SELECT 'small_user_links_blank', count(*) FILTER (spd_user_type = 'small_user' AND link IS NOT NULL) = 0, CAST(count(*) FILTER (spd_user_type = 'small_user' AND link IS NOT NULL) AS VARCHAR) FROM lives
UNION ALL SELECT 'live', true, CAST(count(*) FILTER (is_current) AS VARCHAR) FROM lives
UNION ALL SELECT 'primary_key_unique', count(*) = count(DISTINCT (pc_norm, introduced_on)), CAST(count(*) - count(DISTINCT (pc_norm, introduced_on)) AS VARCHAR) FROM lives
UNION ALL SELECT 'current_key_unique', count(*) = count(DISTINCT pc_base), CAST(count(*) - count(DISTINCT pc_base) AS VARCHAR) FROM lives WHERE is_current
UNION ALL SELECT 'roles', true, 'large_user,small_user'""")
def _(spark, sf):
    lives = directory(spark, sf)
    c = Checks().required(["pc_norm", "introduced_on"], "key_nonnull").zero("deleted_before_introduced", F.col("deleted_on") < F.col("introduced_on"))
    c.zero("small_user_links_blank", (F.col("spd_user_type") == "small_user") & F.col("link").isNotNull()).observe("live", F.count_if("is_current"))
    return union_checks(c.run(lives), unique_key(lives, ["pc_norm", "introduced_on"]), unique_key(lives.where("is_current"), ["pc_base"], "current_key_unique"),
                        values_within(lives, "spd_user_type", ["small_user", "large_user"], "roles")).select("name", "passed", "actual")


@query("check_summary", """
WITH c AS (SELECT count(*) FILTER (l_quantity < 1) AS a, count(*) FILTER (l_discount > 0.05) AS b FROM lineitem)
SELECT 2 AS checks, (a = 0)::INT + (b = 0)::INT AS blocking_passed, (a <> 0)::INT + (b <> 0)::INT AS blocking_failed FROM c""")
def _(spark, sf):
    rows = t.table(spark, sf, "lineitem")
    return summary(Checks().zero("quantity", F.col("l_quantity") < 1).zero("discount", F.col("l_discount") > 0.05).observe("most", F.max("l_tax")).run(rows))


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, sf):
    return repeated(t.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---- placing points ----

VERSIONS = (RuralityVersion("2016", 2016), RuralityVersion("2022", 2022))


def layer(spark, sf):
    """Two versions of a layer of squares, one square a nation, side 20 km; the second stands 5 km east."""
    n = F.col("n_nationkey")
    six = F.create_map(*[F.lit(x) for kv in EIGHT_TO_SIX.items() for x in kv])
    boxes = t.table(spark, sf, "nation").select(
        n.alias("poly"), (n % 8 + 1).alias("eightfold"), six[n % 8 + 1].alias("sixfold"), ((n % 5) * 20000).alias("bx0"), (F.floor(n / 5) * 20000).alias("by0"),
        F.inline(F.array(*[F.struct(F.lit(v.key).alias("version"), F.lit(shift).alias("shift")) for v, shift in zip(VERSIONS, (0, 5000))])))
    boxes = boxes.withColumn("bx0", F.col("bx0") + F.col("shift")).withColumns({"bx1": F.col("bx0") + 20000, "by1": F.col("by0") + 20000})
    return sp.box_edges(boxes, ["version", "poly", "sixfold", "eightfold"])


LAYER_SQL = """WITH box AS (SELECT v.version, n_nationkey AS poly, n_nationkey % 8 + 1 AS eight, (n_nationkey % 5) * 20000 + v.shift AS x0, CAST(floor(n_nationkey / 5) AS INT) * 20000 AS y0
  FROM nation, (VALUES ('2016', 0), ('2022', 5000)) v(version, shift)),
nest(eight, six) AS (VALUES (1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 5), (7, 6), (8, 6)),
"""


@query("point_in_polygon_class", LAYER_SQL + """
pt AS (SELECT DISTINCT (o_orderkey * 250) % 110000 AS x, (o_custkey * 1250) % 105000 AS y FROM orders),
q AS (SELECT pt.*, version FROM pt, (VALUES ('2016'), ('2022')) v(version)),
h AS (SELECT q.x, q.y, q.version, min(b.eight) AS lo, max(b.eight) AS hi FROM q LEFT JOIN box b ON b.version = q.version AND q.x BETWEEN x0 AND x0 + 20000 AND q.y BETWEEN y0 AND y0 + 20000 GROUP BY 1, 2, 3)
SELECT CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, version, CASE WHEN lo = hi THEN six END AS sixfold, CASE WHEN lo = hi THEN lo END AS eightfold,
  CASE WHEN lo IS NULL THEN 'outside_polygons' WHEN lo <> hi THEN 'ambiguous_polygons' END AS status FROM h LEFT JOIN nest ON eight = lo""")
def _(spark, sf):
    points = t.table(spark, sf, "orders").select((F.col("o_orderkey") * 250 % 110000).alias("x"), (F.col("o_custkey") * 1250 % 105000).alias("y"))
    return sp.placed(points, layer(spark, sf), [v.key for v in VERSIONS])


POINTS_SQL = LAYER_SQL + LIVES[5:] + """,
rec AS (SELECT *, CAST(zone AS BIGINT) * 370 % 110000 AS e, CAST(zone AS BIGINT) * 530 % 105000 AS n FROM lives),
q AS (SELECT DISTINCT e, n, version FROM rec, (VALUES ('2016'), ('2022')) v(version)),
h AS (SELECT q.e, q.n, q.version, min(b.eight) AS lo, max(b.eight) AS hi FROM q LEFT JOIN box b ON b.version = q.version AND q.e BETWEEN x0 AND x0 + 20000 AND q.n BETWEEN y0 AND y0 + 20000 GROUP BY 1, 2, 3),
c AS (SELECT h.e, h.n, h.version, CASE WHEN lo = hi THEN six END AS six, CASE WHEN lo = hi THEN lo END AS eight, CASE WHEN lo IS NULL THEN 'outside_polygons' WHEN lo <> hi THEN 'ambiguous_polygons' END AS st FROM h LEFT JOIN nest ON eight = lo)
"""


def points(spark, sf):
    z = F.col("zone")
    return directory(spark, sf).withColumns({
        "GridReferenceEasting": (z * 370 % 110000).cast("string"), "GridReferenceNorthing": (z * 530 % 105000).cast("string"),
        "GridLinkPositionalAccuracy": F.when(z % 2 == 0, F.lit("1")).otherwise(F.lit(" "))})


@query("rurality_all_versions", POINTS_SQL + """
SELECT pc_norm, introduced_on, CASE WHEN NOT box THEN a.six END AS urbanrural2016_6fold, CASE WHEN NOT box THEN a.eight END AS urbanrural2016_8fold, CASE WHEN box THEN 'po_box' ELSE a.st END AS urbanrural2016_status,
  CASE WHEN NOT box THEN b.six END AS urbanrural2022_6fold, CASE WHEN NOT box THEN b.eight END AS urbanrural2022_8fold, CASE WHEN box THEN 'po_box' ELSE b.st END AS urbanrural2022_status
FROM (SELECT *, coalesce(spd_user_type = 'large_user' AND link = 'NO LINKP', false) AS box FROM rec) r JOIN c a ON a.e = r.e AND a.n = r.n AND a.version = '2016' JOIN c b ON b.e = r.e AND b.n = r.n AND b.version = '2022'""")
def _(spark, sf):
    out = sp.withhold_po_boxes(sp.classify(points(spark, sf), layer(spark, sf), VERSIONS), VERSIONS, L)
    return out.select("pc_norm", "introduced_on", *[f"{v.stem}_{c}" for v in VERSIONS for c in ("6fold", "8fold", "status")])


@query("rurality_agreement", POINTS_SQL + """
, r AS (SELECT rec.*, coalesce(c.six = CAST(zone % 6 + 1 AS INT) AND c.eight = CAST(zone % 8 + 1 AS INT), false) AS ok FROM rec JOIN c ON c.e = rec.e AND c.n = rec.n AND c.version = '2022')
SELECT k.cohort, k.lives, k.agreeing FROM (SELECT unnest([
  {'cohort': 'current_small_user', 'lives': count(*) FILTER (is_current AND spd_user_type = 'small_user'), 'agreeing': count(*) FILTER (ok AND is_current AND spd_user_type = 'small_user')},
  {'cohort': 'deleted_small_user', 'lives': count(*) FILTER (NOT is_current AND spd_user_type = 'small_user'), 'agreeing': count(*) FILTER (ok AND NOT is_current AND spd_user_type = 'small_user')},
  {'cohort': 'current_large_user', 'lives': count(*) FILTER (is_current AND spd_user_type <> 'small_user'), 'agreeing': count(*) FILTER (ok AND is_current AND spd_user_type <> 'small_user')},
  {'cohort': 'deleted_large_user', 'lives': count(*) FILTER (NOT is_current AND spd_user_type <> 'small_user'), 'agreeing': count(*) FILTER (ok AND NOT is_current AND spd_user_type <> 'small_user')},
  {'cohort': 'po_box', 'lives': count(*) FILTER (link = 'NO LINKP'), 'agreeing': count(*) FILTER (ok AND link = 'NO LINKP')},
  {'cohort': 'split_part', 'lives': count(*) FILTER (pc_norm <> pc_base), 'agreeing': count(*) FILTER (ok AND pc_norm <> pc_base)},
  {'cohort': 'deleted_blank_positional_accuracy', 'lives': count(*) FILTER (NOT is_current AND zone % 2 = 1), 'agreeing': count(*) FILTER (ok AND NOT is_current AND zone % 2 = 1)}]) AS k FROM r)""")
def _(spark, sf):
    z = F.col("zone")
    out = sp.classify(points(spark, sf), layer(spark, sf), VERSIONS).withColumns({
        "UrbanRural6Fold2022Code": (z % 6 + 1).cast("string"), "UrbanRural8Fold2022Code": (z % 8 + 1).cast("string")})
    return sp.agreement(out, AgreementGate(), L).select("cohort", "lives", "agreeing")


@query("polygon_areas", "SELECT p_partkey AS poly, (p_size * 700.0) * (p_size % 9 * 300.0 + 250.0) AS area, (p_size * 700.0) * (p_size % 9 * 300.0 + 250.0) AS banded_area FROM part")
def _(spark, sf):
    """A box per part: its area from its edges, and from the pieces of its edges in every band."""
    k, size = F.col("p_partkey"), F.col("p_size")
    boxes = t.table(spark, sf, "part").select(F.lit("2022").alias("version"), k.alias("poly"), (k % 500 * 1000).alias("bx0"), (k % 300 * 1000 + 125).alias("by0"), size.alias("s"))
    boxes = boxes.withColumns({"bx1": F.col("bx0") + F.col("s") * 700, "by1": F.col("by0") + F.col("s") % 9 * 300 + 250})
    edges = sp.box_edges(boxes, ["version", "poly"])
    both = sp.polygon_area(edges).join(sp.banded_area(edges), ["version", "poly"])
    return both.select("poly", F.round("area", 3).alias("area"), F.round("banded_area", 3).alias("banded_area"))


@query("crossing_rings", "SELECT p_partkey AS poly FROM part WHERE p_size % 2 = 1")
def _(spark, sf):
    """A ring per part, twisted where the size is odd: the rings whose edges cross."""
    k, odd = F.col("p_partkey"), F.col("p_size") % 2 == 1
    x, y = (k % 500 * 1000).cast("double"), (k % 300 * 1000).cast("double")
    c = {"a": (x, y), "b": (x + 700, y), "c": (x + 700, y + 700), "d": (x, y + 700)}
    edge = lambda p, q: F.struct(p[0].alias("x1"), p[1].alias("y1"), q[0].alias("x2"), q[1].alias("y2"))
    ring = lambda names: F.array(*[edge(c[i], c[j]) for i, j in zip(names, names[1:])])
    edges = t.table(spark, sf, "part").select(F.lit("2022").alias("version"), k.alias("poly"), F.lit(0).alias("ring"),
                                              F.inline(F.when(odd, ring("abdca")).otherwise(ring("abcda"))))
    return sp.crossing_rings(edges).select("poly")


# Shapes of rings on a square of a given side, in halves of it: the kinds of fault each has, and its rings, edges and area (in squares) when rebuilt.
RINGS = (("whole", [(0, 0), (2, 0), (2, 2), (0, 2)], (), 1, 4, 1.0), ("bow", [(0, 0), (2, 2), (2, 0), (0, 2)], ("crossing",), 2, 6, 0.5),
         ("touching", [(0, 0), (2, 0), (2, 2), (1, 0), (0, 2)], ("touch",), 2, 6, 0.5),
         ("spike", [(0, 0), (2, 0), (2, 2), (2, 4), (2, 2), (0, 2)], ("overlap", "vertex"), 1, 4, 1.0),
         ("eight", [(0, 0), (1, 1), (2, 0), (2, 2), (1, 1), (0, 2)], ("vertex",), 2, 6, 0.5))


def ring_layer(spark, sf):
    """A ring per part, one of RINGS by its key, its side by its size."""
    k, half = F.col("p_partkey"), F.col("p_size") * 30
    x, y = k % 500 * 1000, k % 300 * 1000
    edge = lambda p, q: F.struct(*[(o + half * c).cast("double").alias(n) for n, o, c in (("x1", x, p[0]), ("y1", y, p[1]), ("x2", x, q[0]), ("y2", y, q[1]))])
    shapes = F.array(*[F.array(*[edge(p, q) for p, q in zip(s, s[1:] + s[:1])]) for _, s, *_ in RINGS])
    return t.table(spark, sf, "part").select(F.lit("2022").alias("version"), k.alias("poly"), F.lit(1).alias("sixfold"), F.lit(1).alias("eightfold"),
                                             F.lit(0).alias("ring"), F.inline(F.get(shapes, (k % len(RINGS)).cast("int"))))


@query("ring_faults", " UNION ALL ".join(f"SELECT p_partkey AS poly, '{kind}' AS kind FROM part WHERE p_partkey % {len(RINGS)} = {k}"
                                         for k, r in enumerate(RINGS) for kind in r[2]))
def _(spark, sf):
    return rg.ring_faults(ring_layer(spark, sf)).select("poly", "kind")


@query("ring_repair", " UNION ALL ".join(f"SELECT p_partkey AS poly, {'true' if r[2] else 'false'} AS rebuilt, CAST({r[3]} AS BIGINT) AS n_rings, CAST({r[4]} AS BIGINT) AS n_edges, "
                                         f"CAST(p_size AS DOUBLE) * p_size * {3600 * r[5]} AS area FROM part WHERE p_partkey % {len(RINGS)} = {k}" for k, r in enumerate(RINGS)))
def _(spark, sf):
    """Each ring rebuilt: the area is that of its edges, added up with the inside on the left."""
    piece = (F.col("x1") + F.col("x2")) / 2 * (F.col("y2") - F.col("y1"))
    return rg.repaired(ring_layer(spark, sf)).groupBy("poly", "rebuilt").agg(F.count_distinct("ring").alias("n_rings"), F.count(F.lit(1)).alias("n_edges"),
                                                                            F.round(F.sum(piece), 3).alias("area"))


# ---- binary sources ----

@query("dbf_source", """
SELECT o_orderkey AS orderkey, o_orderstatus AS status, CASE WHEN o_orderkey % 9 <> 4 THEN CAST(o_totalprice AS DOUBLE) END AS price,
  CASE WHEN o_custkey % 7 <> 3 THEN CAST(o_orderdate AS DATE) END AS day, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey % 2 = 0 END AS even FROM orders""")
def _(spark, sf):
    """Orders written as dBase files into the shared folder, one a partition, and read again: numbers, stars, text, dates and flags."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    fields = [("ORDERKEY", "N", 12, 0), ("STATUS", "C", 3, 0), ("PRICE", "N", 16, 2), ("DAY", "D", 8, 0), ("EVEN", "L", 1, 0)]
    cells = [
        k.cast("string"), F.col("o_orderstatus"), F.when(k % 9 == 4, F.lit("*" * 16)).otherwise(F.format_string("%.2f", F.col("o_totalprice").cast("double"))),
        F.when(c % 7 != 3, F.date_format("o_orderdate", "yyyyMMdd")), F.when(c % 5 == 0, F.lit("?")).when(c % 2 == 0, F.lit("T")).otherwise(F.lit("n"))]
    rows = t.table(spark, sf, "orders").select(*[cell.alias(name) for cell, (name, *_) in zip(cells, fields)])
    path = t.source_files(rows, t.dbf_files(fields), f"{scratch_folder(spark)}/dbf")
    return read_dbf(spark, path).drop("record_number")


@query("shape_source", " UNION ALL ".join(f"""SELECT 0 AS ring, CAST({a} AS DOUBLE) AS x1, CAST({b} AS DOUBLE) AS y1, CAST({c} AS DOUBLE) AS x2, CAST({d} AS DOUBLE) AS y2
  FROM (SELECT p_partkey % 500 * 1000 AS x0, p_partkey % 300 * 1000 + 0.5 AS y0, p_partkey % 500 * 1000 + p_size AS xx, p_partkey % 300 * 1000 + 0.5 + p_size AS yy FROM part)"""
                                          for a, b, c, d in (("x0", "y0", "x0", "yy"), ("x0", "yy", "xx", "yy"), ("xx", "yy", "xx", "y0"), ("xx", "y0", "x0", "y0"))))
def _(spark, sf):
    """A box a part, written as shapefiles into the shared folder, and its edges read again."""
    k, size = F.col("p_partkey"), F.col("p_size")
    x, y = (k % 500 * 1000).cast("double"), (k % 300 * 1000).cast("double") + 0.5
    boxes = t.table(spark, sf, "part").select(x.alias("x0"), y.alias("y0"), (x + size).alias("x1"), (y + size).alias("y1"))
    return read_edges(spark, t.source_files(boxes, t.box_files, f"{scratch_folder(spark)}/shapes")).drop("record_number")
