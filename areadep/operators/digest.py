"""Exported text, its order-independent digest, and reading it back."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F

from ..functions.values import NULL_MARK, SEPARATOR, SPARK_TYPES, refused, rendered, reserved_in, row_number64, same, stored
from .checks import Checks, repeated, static_check, union_checks


@dataclass(frozen=True)
class ExportContract:
    """What leaves the build and how an empty cell is told apart on the way back."""

    fields: tuple                                  # (name, kind, nullable), in order
    key: tuple
    exclude: tuple = ()
    role_column: str = "spd_user_type"
    null_for_role: dict = field(default_factory=dict)     # column -> role it does not exist for
    empty_is_null: tuple = ()

    def columns(self) -> list[tuple]:
        unknown = set(self.exclude) - {n for n, _, _ in self.fields}
        if unknown:
            raise ValueError(f"excluded columns are not in the schema: {sorted(unknown)}")
        return [f for f in self.fields if f[0] not in self.exclude]

    def names(self) -> list[str]:
        return [n for n, _, _ in self.columns()]

    def kind(self, name: str) -> str:
        return next(k for n, k, _ in self.fields if n == name)


# Columns that exist in only one of the two directory files, and columns that are never blank.
HISTORY_NULL_FOR_ROLE = {
    **{f"Census{what}Count{year}": "large_user" for year in (2022, 2011, 2001, 1991) for what in ("Household", "Population")},
    "NeverDigitised": "large_user", "LinkedSmallUserPostcode": "small_user",
}
HISTORY_EXCLUDED = ("GridReferenceEasting", "GridReferenceNorthing", "Latitude", "Longitude")
MAIN_EXCLUDED = ("GridReferenceEasting", "GridReferenceNorthing")


def render(df: DataFrame, contract: ExportContract, null_mark: str = NULL_MARK) -> DataFrame:
    """Every exported value as text, nulls marked."""
    return df.select(*[rendered(n, k, null_mark).alias(n) for n, k, _ in contract.columns()])


def reserved_characters(df: DataFrame, contract: ExportContract, label: str = "export") -> DataFrame:
    """Check rows: no text column holds a character the digest framing uses."""
    c = Checks(f"{label}.")
    for n, k, _ in contract.columns():
        if k == "string":
            c.zero(f"{n}.reserved_characters", reserved_in(n))
    return c.run(df)


def row_digest(text: DataFrame) -> DataFrame:
    """One row of rows and total: the signed first eight bytes of each row's SHA-256, summed exactly.
    The sum does not depend on row order, and partial sums are taken where the rows are."""
    value = row_number64(F.concat_ws(SEPARATOR, *text.columns))
    return text.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(value), F.lit(0).cast("decimal(38,0)")).cast("string").alias("total"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Digest of the rows alone, over every column as text."""
    return row_digest(df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)).alias(c) for c in df.columns]))


def write_csv(df: DataFrame, contract: ExportContract, path: str) -> None:
    """Gzip CSV in key order; a null and a blank are the same empty cell."""
    text = render(df, contract, "").orderBy(*contract.key)
    (text.write.mode("overwrite").option("header", True).option("compression", "gzip")
     .option("emptyValue", "").option("nullValue", "").option("escape", '"').csv(path))


def read_csv(spark, contract: ExportContract, path: str) -> DataFrame:
    """The written text, blanks as blanks."""
    schema = ", ".join(f"`{n}` string" for n in contract.names())
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"').csv(path).na.fill("")


def restore(text: DataFrame, contract: ExportContract) -> DataFrame:
    """Staged text back to declared types, with the contract's rules for empty cells."""
    return text.select(*[stored(n, k, role=contract.role_column, null_for_role=contract.null_for_role.get(n),
                                blank_is_null=n in contract.empty_is_null).alias(n) for n, k, _ in contract.columns()])


def load_csv(spark, contract: ExportContract, path: str, target: str) -> tuple[DataFrame, DataFrame, dict]:
    """An exported CSV as a typed table, written to `target` in one pass: the table, the rows it refuses, and what was observed on the way.

    A row is refused if it has more or fewer cells than the contract, or a cell that is no value of its type; it keeps its cells as text,
    the line if it was cut wrongly, and the columns that were refused. Rows, their digest and the refusals are counted while the rows are
    written, so nothing is read twice; the digest is that of the values as they were loaded."""
    columns = contract.columns()
    schema = ", ".join(f"`{n}` string" for n in contract.names()) + ", _line string"
    text = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").csv(path).na.fill("", contract.names()))
    typed = {n: stored(n, k, role=contract.role_column, null_for_role=contract.null_for_role.get(n), blank_is_null=n in contract.empty_is_null) for n, k, _ in columns}
    rows = text.select(F.struct(*contract.names(), "_line").alias("text"), F.struct(*[v.alias(n) for n, v in typed.items()]).alias("row"))
    wrong = F.array_compact(F.array(*[F.when(refused(f"text.{n}", f"row.{n}", k), F.lit(n)) for n, k, _ in columns]))
    rows = rows.withColumn("refused", wrong)
    good = F.col("text._line").isNull() & (F.size("refused") == 0)
    line = F.concat_ws(SEPARATOR, *[rendered(F.col(f"row.{n}"), k) for n, k, _ in columns])
    seen = Observation("load")
    rows.observe(seen, F.count_if(good).alias("rows"), F.coalesce(F.sum(F.when(good, row_number64(line))), F.lit(0).cast("decimal(38,0)")).cast("string").alias("total"),
                 F.count_if(F.col("text._line").isNotNull()).alias("cut_wrongly"), F.count_if(F.col("text._line").isNull() & ~good).alias("refused")).write.parquet(target)
    kept = spark.read.parquet(target)
    good = F.col("text._line").isNull() & (F.size("refused") == 0)
    return kept.where(good).select("row.*"), kept.where(~good).select("text.*", "refused"), dict(seen.get)


def load_checks(spark, observed: dict, rows: int, total: str, label: str = "load") -> DataFrame:
    """Check rows of a load: as many rows as were exported, with their digest, and none refused."""
    wanted = {"rows": rows, "total": total, "cut_wrongly": 0, "refused": 0}
    return union_checks(*[static_check(spark, f"{label}.{n}", observed[n], want) for n, want in wanted.items()])


def cells_equal(saved: DataFrame, expected: DataFrame, key: list[str], label: str = "csv") -> DataFrame:
    """Check rows of a cell-by-cell comparison by key."""
    value = [c for c in expected.columns if c not in key]
    pack = lambda df, name: df.select(*key, F.struct(*(value or key)).alias(name))
    pairs = pack(saved, "a").join(pack(expected, "b"), key, "full_outer")
    c = Checks(f"{label}.").zero("rows", F.col("a").isNull() | F.col("b").isNull())
    for name in value:
        c.zero(f"{name}.cells", F.col("a").isNotNull() & F.col("b").isNotNull() & ~same(f"a.{name}", f"b.{name}"))
    return union_checks(static_check(saved.sparkSession, f"{label}.header", list(saved.columns), list(expected.columns)), c.run(pairs))


def loaded_table(df: DataFrame, contract: ExportContract, rows: int, total: str, label: str = "loaded") -> DataFrame:
    """Whether a loaded table is the exported one: columns in order and type, key unique and present, no
    reserved characters, row count and digest. Every check is reported; none is skipped as passed."""
    spark = df.sparkSession
    declared = [(n, "decimal(6,1)" if k == "rank" else SPARK_TYPES[k].simpleString()) for n, k, _ in contract.columns()]
    found = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    shape = static_check(spark, f"{label}.columns", found, declared)
    if found != declared:
        failed = [(f"{label}.{n}", False, "checked", "not run", "columns differ") for n in ("key", "reserved", "rows", "digest")]
        return union_checks(shape, spark.createDataFrame(failed, shape.schema))
    digest = row_digest(render(df, contract))
    extra = F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0))
    return union_checks(
        shape,
        Checks(f"{label}.").equal("key_unique", extra, 0).run(repeated(df, list(contract.key))),
        Checks(f"{label}.").required(contract.key, "key_nonnull").run(df),
        reserved_characters(df, contract, label),
        Checks(f"{label}.").equal("rows", F.max("n_rows"), rows).equal("digest", F.max("total"), total).run(digest))
