"""Source files written from the given tables and read as published ones are: directory files with faults, both files under one
another, and editions joined onto records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrich as en
from ..registry import GEOGRAPHIES, Registry
from ..sources.text import directory_file, history_index
from . import standin as t
from .publish import scratch_folder
from .queries_data import TRACE, directory, source_value, trace_tables

QUERIES: dict = {}
ORACLE: dict = {}
HEADER = ["Postcode", "SplitIndicator", "DateOfIntroduction", "DateOfDeletion", "DataZone2001Code", "DataZone2011Code"]
RELEASE = Registry(history_release="r7")


def query(name: str, sql: str):
    def add(fn):
        QUERIES[name], ORACLE[name] = fn, sql
        return fn
    return add


# Cells of a small-user file by a customer's key k, in words of both engines; a letter by its number.
LETTER = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST({} % 26 AS INT) + 1, 1)"
KEY = ("concat('A', " + LETTER.format("floor(k / 67600)") + ", CAST(k % 10 AS VARCHAR(9)), {gap}, CAST(CAST(floor(k / 10) AS INT) % 10 AS VARCHAR(9)), "
       + LETTER.format("floor(k / 100)") + ", " + LETTER.format("floor(k / 2600)") + ")")
SUFFIX = "CASE WHEN k % 9 = 4 THEN substr('ABC', CAST(k % 3 AS INT) + 1, 1) ELSE '' END"
FLAG = "CASE WHEN k % 70 = 13 THEN 'X' WHEN k % 9 = 4 THEN 'Y' ELSE 'N' END"
STRAIGHT, SPOILT = "k % 50 = 7", "k % 80 = 17"
TEXT = f"CASE WHEN {STRAIGHT} THEN lower(concat({KEY.format(gap=repr(''))}, {SUFFIX})) ELSE concat({KEY.format(gap=repr(' '))}, {SUFFIX}) END"
BEGAN = "date_add(DATE '2000-01-01', CAST(k % 3650 AS INT))"
ENDED = "date_add(DATE '2000-01-01', CAST(k % 3650 + k % 400 - CASE WHEN k % 90 = 23 THEN 500 ELSE 0 END AS INT))"
DELETED = "k % 4 = 1"
ZONES = ["CASE WHEN k % 200 = 31 THEN '' ELSE concat('S', CAST(k % 300 AS VARCHAR(9))) END", "concat('T', CAST(k % 70 AS VARCHAR(9)))"]


def small_rows(spark, sf):
    """One record a customer, some of them twice: keys without a space, wrong flags, split parts, dates with a time and dates that are none."""
    day = lambda d: F.concat(F.date_format(d, "d/M/yyyy"), F.when(F.expr("k % 5 = 2"), F.lit(" 00:00:00")).otherwise(F.lit("")))
    rows = t.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    rows = rows.unionByName(rows.where("k % 250 = 3"))
    return rows.select(
        F.expr(TEXT).alias("Postcode"), F.expr(FLAG).alias("SplitIndicator"), F.when(F.expr(SPOILT), F.lit("31/2/2001")).otherwise(day(F.expr(BEGAN))).alias("DateOfIntroduction"),
        F.when(F.expr(DELETED), day(F.expr(ENDED))).otherwise(F.lit("")).alias("DateOfDeletion"), *[F.expr(z).alias(c) for z, c in zip(ZONES, HEADER[4:])])


def small_file(spark, sf):
    path = f"{scratch_folder(spark)}/small"
    small_rows(spark, sf).write.option("header", True).option("emptyValue", "").csv(path)
    return directory_file(spark, path, "small_user", RELEASE, HEADER)


def _sql(text: str) -> str:
    return text.replace("date_add(DATE '2000-01-01', ", "(DATE '2000-01-01' + ")


SMALL_SQL = "WITH rows AS (SELECT c_custkey AS k FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 250 = 3),\n" + _sql(f"""small AS (SELECT k, {TEXT} AS text, {FLAG} AS flag,
  upper(replace({TEXT}, ' ', '')) AS pc_norm, CASE WHEN {SPOILT} THEN NULL ELSE {BEGAN} END AS introduced_on, CASE WHEN {DELETED} THEN {ENDED} END AS deleted_on FROM rows)""")


@query("directory_source", SMALL_SQL + """
SELECT text AS "Postcode", flag AS "SplitIndicator", pc_norm, CASE WHEN flag = 'Y' THEN substr(pc_norm, 1, length(pc_norm) - 1) ELSE pc_norm END AS pc_base,
  introduced_on, deleted_on, deleted_on IS NULL AS is_current, 'small_user' AS spd_user_type, 'r7' AS spd_release FROM small""")
def _(spark, sf):
    """A small-user file read back with its keys, dates and provenance."""
    return small_file(spark, sf)[0].select("Postcode", "SplitIndicator", "pc_norm", "pc_base", "introduced_on", "deleted_on", "is_current", "spd_user_type", "spd_release")


@query("directory_source_checks", SMALL_SQL + """,
c AS (SELECT count(*) AS rows_, count(*) FILTER (deleted_on IS NULL) AS live, count(*) FILTER (introduced_on = deleted_on) AS same_day, count(*) FILTER (flag = 'Y') AS split,
  count(*) FILTER (k % 50 = 7 OR flag = 'X' OR (k % 9 = 4 AND flag <> 'Y')) AS keys,
  count(*) FILTER (introduced_on IS NULL OR coalesce(deleted_on < introduced_on, false)) AS dates, count(*) - count(DISTINCT k) AS twice FROM small)
SELECT unnest(['spd.small_user.schema', 'spd.small_user.keys_well_formed', 'spd.small_user.dates_well_formed', 'spd.small_user.rows', 'spd.small_user.live', 'spd.small_user.same_day',
    'spd.small_user.split_records', 'spd.small_user.identical_duplicates']) AS name,
  unnest([true, keys = 0, dates = 0, true, true, true, true, twice = 0]) AS passed, unnest([NULL, keys, dates, rows_, live, same_day, split, twice]) AS found FROM c""")
def _(spark, sf):
    report = small_file(spark, sf)[1]
    return report.select("name", "passed", F.col("actual").try_cast("bigint").alias("found"))


LINK = "CASE WHEN k % 5 = 0 THEN 'NO LINKP' WHEN k % 5 = 1 THEN 'NO LINK' WHEN k % 5 = 2 THEN 'ZZ9 9ZZ' ELSE concat('AA', CAST(k % 10 AS VARCHAR(9)), ' 0', 'AA') END"


@query("history_source", SMALL_SQL.replace("c_custkey % 250 = 3", "false") + _sql(f""",
large AS (SELECT s_suppkey AS k FROM supplier)
SELECT pc_norm, 'small_user' AS spd_user_type, introduced_on, CASE WHEN k % 200 = 31 THEN '' ELSE 'S' || (k % 300) END AS "DataZone2001Code", 'n' || (k % 3) AS "NeverDigitised",
  CAST(NULL AS VARCHAR) AS "LinkedSmallUserPostcode" FROM small WHERE k % 3 = 0
UNION ALL SELECT replace({KEY.format(gap=repr(' '))}, ' ', '') || 'L', 'large_user', {BEGAN}, '', NULL, {LINK} FROM large"""))
def _(spark, sf):
    """Both directory files under one another: what one file lacks is null there, a blank stays blank."""
    folder = scratch_folder(spark)
    k = F.col("k")
    day = F.date_format(F.expr(BEGAN), "d/M/yyyy")
    small = t.table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).where("k % 3 = 0").select(
        F.expr(TEXT).alias("Postcode"), F.expr(FLAG).alias("SplitIndicator"), F.when(F.expr(SPOILT), F.lit("31/2/2001")).otherwise(day).alias("DateOfIntroduction"), F.lit("").alias("DateOfDeletion"),
        F.expr(ZONES[0]).alias("DataZone2001Code"), F.expr(ZONES[1]).alias("DataZone2011Code"), F.concat(F.lit("n"), (k % 3).cast("string")).alias("NeverDigitised"))
    large = t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k")).select(
        F.concat(F.expr(KEY.format(gap=repr(" "))), F.lit("L")).alias("Postcode"), F.lit("N").alias("SplitIndicator"), day.alias("DateOfIntroduction"), F.lit("").alias("DateOfDeletion"),
        F.expr(LINK).alias("LinkedSmallUserPostcode"), F.lit("").alias("DataZone2001Code"), F.expr(ZONES[1]).alias("DataZone2011Code"))
    files = {}
    for name, rows in (("small", small), ("large", large)):
        rows.write.option("header", True).option("emptyValue", "").csv(f"{folder}/{name}")
        files[name] = directory_file(spark, f"{folder}/{name}", f"{name}_user", RELEASE, rows.columns)[0]
    index, _ = history_index(files["small"], files["large"], TRACE)
    return index.select("pc_norm", "spd_user_type", "introduced_on", "DataZone2001Code", "NeverDigitised", "LinkedSmallUserPostcode")


def _attached(e_number: int, k: int, measure: str) -> str:
    return f"CASE WHEN p_partkey IS NOT NULL THEN {source_value(e_number, k, measure, 'zone')} END"


def _enriched_sql() -> str:
    cells = [f"CASE WHEN p_partkey IS NOT NULL THEN '{g}{e.vintage}-' || (zone % 14) END AS phs_dz{e.vintage}_{g}" for e in TRACE.editions for g in GEOGRAPHIES]
    cells += [f"{_attached(i, k, m)} AS {e.column(m)}" for i, e in enumerate(TRACE.editions) for k, m in enumerate(e.measures())]
    return "WITH " + t.LIVES_SQL + f"SELECT pc_norm, introduced_on, {', '.join(cells)} FROM lives LEFT JOIN part ON p_partkey = zone"


@query("enrich_editions", _enriched_sql())
def _(spark, sf):
    """Every measure of every edition on every record, the editions of a vintage laid side by side first, with the areas of its first edition."""
    index = directory(spark, sf).select("pc_norm", "introduced_on", *[F.concat(F.lit("Z"), F.col("zone").cast("string")).alias(f"DataZone{e.vintage}Code") for e in TRACE.editions])
    _, service, gov = trace_tables(spark, sf)
    number = F.substring("dz_code", F.lit(2), F.length("dz_code")).cast("bigint")
    vintage = F.when(F.col("edition") == "e1", F.lit("2001")).otherwise(F.lit("2011"))
    service = service.select("*", *[F.concat(F.lit(g), vintage, F.lit("-"), (number % 14).cast("string")).alias(g) for g in GEOGRAPHIES])
    return en.enrich(index, service, gov, TRACE).drop(*[f"DataZone{e.vintage}Code" for e in TRACE.editions])
