"""Views over the star-schema test tables that stand in for a directory, a cohort and zones."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, Window as W

from ..functions.keys import Lives

TEST_LIVES = Lives(link="link")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's order days as lives of a location key: gaps, same-day lives, split parts,
    large users and links included."""
    days = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("d")).distinct()
    k, d, n = F.col("k"), F.col("d"), F.col("n")
    ended = (F.when(n.isNull() & (k % 4 == 0), F.lit(None).cast("date"))
             .when(n.isNull(), F.date_add(d, 30))
             .when((k % 11 == 0) & (F.day(d) < 4), d)
             .when(k % 3 == 1, F.date_add(d, F.floor(F.datediff(n, d) / 2).cast("int")))
             .otherwise(n))
    spans = days.withColumn("n", F.lead("d").over(W.partitionBy("k").orderBy("d"))).select(
        "k", F.floor(k / 3).cast("int").alias("g"), d.alias("introduced_on"), ended.alias("deleted_on"))
    g = F.col("g")
    # Of an odd group each customer is a key of its own; of an even one they are parts of one key.
    own = F.when((g % 2 == 0) | (k % 3 == 0), F.lit("")).when(k % 3 == 1, F.lit("X")).otherwise(F.lit("Y"))
    base = F.concat(F.lit("P"), g.cast("string"), own)
    suffix = F.when(g % 2 == 1, F.lit("")).otherwise(F.substring(F.lit("ABC"), (k % 3).cast("int") + 1, F.lit(1)))
    link = (F.when(k % 7 != 0, F.lit(None).cast("string")).when(k % 5 == 0, F.lit("NO LINKP")).when(k % 5 == 1, F.lit("NO LINK"))
            .otherwise(F.concat(F.lit("P "), (g + 1).cast("string"), F.when(g % 2 == 1, F.lit("A")).otherwise(F.lit("")))))
    return spans.select(
        base.alias("pc_base"), F.concat(base, suffix).alias("pc_norm"), "introduced_on", "deleted_on",
        F.col("deleted_on").isNull().alias("is_current"),
        F.when(k % 7 == 0, F.lit("large_user")).otherwise(F.lit("small_user")).alias("spd_user_type"),
        link.alias("link"), k.alias("zone"))


LIVES_SQL = """
ev AS (SELECT DISTINCT o_custkey k, CAST(o_orderdate AS DATE) d FROM orders),
nx AS (SELECT k, d, lead(d) OVER (PARTITION BY k ORDER BY d) n FROM ev),
iv AS (SELECT k, d AS introduced_on,
         CASE WHEN n IS NULL AND k % 4 = 0 THEN NULL WHEN n IS NULL THEN d + 30
              WHEN k % 11 = 0 AND day(d) < 4 THEN d
              WHEN k % 3 = 1 THEN d + CAST(floor((n - d) / 2) AS INT)
              ELSE n END AS deleted_on FROM nx),
gv AS (SELECT *, CAST(floor(k / 3) AS INT) g FROM iv),
lives AS (SELECT 'P' || g || own AS pc_base,
       'P' || g || own || CASE WHEN g % 2 = 1 THEN '' ELSE substr('ABC', CAST(k % 3 AS INT) + 1, 1) END AS pc_norm,
       introduced_on, deleted_on, deleted_on IS NULL AS is_current,
       CASE WHEN k % 7 = 0 THEN 'large_user' ELSE 'small_user' END AS spd_user_type,
       CASE WHEN k % 7 <> 0 THEN NULL WHEN k % 5 = 0 THEN 'NO LINKP' WHEN k % 5 = 1 THEN 'NO LINK'
            ELSE 'P ' || (g + 1) || CASE WHEN g % 2 = 1 THEN 'A' ELSE '' END END AS link, k AS zone
  FROM (SELECT *, CASE WHEN g % 2 = 0 OR k % 3 = 0 THEN '' WHEN k % 3 = 1 THEN 'X' ELSE 'Y' END AS own FROM gv))
"""


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as dated requests; the id repeats on purpose. Keys grow with the table: one is asked by a tenth of the rows, most by
    a few, some are unknown or null, and some rows have no date."""
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    key = F.concat(F.floor(part / 4).cast("string"), F.when(part % 4 == 1, F.lit("x")).otherwise(F.lit("")))
    postcode = (F.when(order % 97 == 0, F.lit(None).cast("string")).when(order % 31 == 0, F.concat(F.lit("q "), key))
                .when(order % 10 == 0, F.lit("p 7")).otherwise(F.concat(F.lit("p "), key)))
    return table(spark, sf_dir, "lineitem").select(
        (order * 10 + F.col("l_linenumber")).alias("id"), postcode.alias("postcode"),
        F.when(~((F.col("l_linenumber") == 3) & (order % 5 == 0)), F.to_date("l_shipdate")).alias("address_date"))


COHORT_SQL = """
cohort AS (SELECT l_orderkey * 10 + l_linenumber AS id,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 31 = 0 THEN 'q ' || k WHEN l_orderkey % 10 = 0 THEN 'p 7' ELSE 'p ' || k END AS postcode,
       CASE WHEN NOT (l_linenumber = 3 AND l_orderkey % 5 = 0) THEN CAST(l_shipdate AS DATE) END AS address_date
  FROM (SELECT *, CAST(floor(l_partkey / 4) AS INT) || CASE WHEN l_partkey % 4 = 1 THEN 'x' ELSE '' END AS k FROM lineitem)),
asked AS (SELECT *, nullif(upper(replace(postcode, ' ', '')), '') AS postcode_key FROM cohort)
"""


def source_files(rows: DataFrame, files, path: str) -> str:
    """A folder with one binary file a partition of `rows`, of the bytes that `files` makes of the partition's batches. Spark's text writer
    ends each with the byte that ends a dBase file, which a shapefile's own length leaves out."""
    made = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(files, "raw binary")
    made.select(F.col("raw").cast("string")).write.option("lineSep", "\x1a").text(path)
    return path


def dbf_files(fields: list[tuple[str, str, int, int]]):
    """A dBase file of text columns, each cell as it stands in the file; blanks where there is none."""
    def files(batches):
        width = 1 + sum(w for _, _, w, _ in fields)
        lines = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                lines.append(b" " + b"".join((v or "").encode("latin-1")[:w].rjust(w) if kind in "NF" else (v or "").encode("latin-1")[:w].ljust(w)
                                             for v, (_, kind, w, _) in zip(row, fields, strict=True)))
        head = struct.pack("<B3BIHH20x", 3, 126, 1, 1, len(lines), 33 + 32 * len(fields), width)
        head += b"".join(name.upper().encode()[:11].ljust(11, b"\0") + kind.encode() + b"\0" * 4 + bytes([w, d]) + b"\0" * 14 for name, kind, w, d in fields)
        yield pa.RecordBatch.from_arrays([pa.array([head + b"\r" + b"".join(lines)], pa.binary())], names=["raw"])
    return files


def box_files(batches):
    """A shapefile of boxes (x0, y0, x1, y1) as closed rings."""
    shapes = []
    for batch in batches:
        for x0, y0, x1, y1 in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            points = ((x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0))
            body = struct.pack("<i4d2ii", 5, x0, y0, x1, y1, 1, 5, 0) + b"".join(struct.pack("<2d", *p) for p in points)
            shapes.append(struct.pack(">2i", len(shapes) + 1, len(body) // 2) + body)
    body = b"".join(shapes)
    head = struct.pack(">i5ii", 9994, 0, 0, 0, 0, 0, 50 + len(body) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8)
    yield pa.RecordBatch.from_arrays([pa.array([head + body], pa.binary())], names=["raw"])
