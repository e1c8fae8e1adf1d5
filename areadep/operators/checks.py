"""Named data-quality checks. All checks of a table are expressions of one aggregation; the outcome is
a DataFrame of check rows (name, passed, expected, actual, detail), blocking unless observed."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import total

CHECK_SCHEMA = "name string, passed boolean, expected string, actual string, detail string"


class ChecksFailed(ValueError):
    """At least one blocking check failed."""


def count_if(test: Column) -> Column:
    return F.count_if(F.coalesce(test, F.lit(False)))


@dataclass
class Checks:
    """Checks and observations of one table, evaluated together in one pass over it."""

    prefix: str = ""
    items: list = field(default_factory=list)      # (name, aggregate, expected text or None to observe, detail)

    def equal(self, name: str, actual: Column, expected, detail: str = "") -> "Checks":
        text = str(expected).lower() if isinstance(expected, bool) else str(expected)
        self.items.append((self.prefix + name, actual.cast("string"), text, detail))
        return self

    def zero(self, name: str, bad: Column, detail: str = "") -> "Checks":
        """No row may meet the condition."""
        return self.equal(name, count_if(bad), 0, detail)

    def holds(self, name: str, aggregate: Column, detail: str = "") -> "Checks":
        return self.equal(name, F.coalesce(aggregate, F.lit(False)), True, detail)

    def observe(self, name: str, value: Column, detail: str = "") -> "Checks":
        self.items.append((self.prefix + name, value.cast("string"), None, detail))
        return self

    # ---- the usual checks of a table ----

    def rows(self, declared: int, name="rows"):
        return self.equal(name, F.count(F.lit(1)), declared)

    def required(self, columns, name="required_values_nonnull"):
        bad = total([count_if(F.col(c).isNull()) for c in columns])
        return self.equal(name, bad, 0, f"{len(list(columns))} columns")

    def blanks(self, columns, name="blanks"):
        bad = total([count_if(F.col(c) == "") for c in columns])
        return self.equal(name, bad, 0)

    def between(self, column: str, low, high, name=None):
        return self.equal(name or f"{column}.range", F.count_if(~F.coalesce(F.col(column).between(low, high), F.lit(False))), 0)

    def binary(self, column: str, name=None):
        return self.equal(name or f"{column}.binary", F.count_if(~F.coalesce(F.col(column).isin(0, 1), F.lit(False))), 0)

    def dense_rank(self, column: str, n: int, name="rank_dense"):
        """Every value 1..n once."""
        ok = ((F.min(column) == 1) & (F.max(column) == n) & (F.count_distinct(F.col(column)) == n) & (F.count(F.lit(1)) == n))
        return self.holds(name, ok)

    def run(self, df: DataFrame) -> DataFrame:
        if not self.items:
            return df.sparkSession.createDataFrame([], CHECK_SCHEMA)
        values = df.agg(*[a.alias(f"v{i}") for i, (_, a, _, _) in enumerate(self.items)])
        rows = [F.struct(F.lit(n).alias("name"), (F.lit(True) if e is None else F.col(f"v{i}").eqNullSafe(F.lit(e))).alias("passed"),
                         F.lit(e).cast("string").alias("expected"), F.col(f"v{i}").alias("actual"), F.lit(d).alias("detail"))
                for i, (n, _, e, d) in enumerate(self.items)]
        return values.select(F.inline(F.array(*rows)))


def static_check(spark, name: str, actual, expected, detail: str = "") -> DataFrame:
    """A check of something known without reading rows, such as a header."""
    return spark.createDataFrame([(name, actual == expected, str(expected), str(actual), detail)], CHECK_SCHEMA)


def header(df: DataFrame, expected: list[str], name: str = "schema") -> DataFrame:
    """Names and order of the columns."""
    return static_check(df.sparkSession, name, list(df.columns), list(expected))


def typed_columns(df: DataFrame, fields: list[tuple[str, str]], name: str = "columns") -> DataFrame:
    """Names, order and Spark types of the columns."""
    return static_check(df.sparkSession, name, [(f.name, f.dataType.simpleString()) for f in df.schema.fields], list(fields))


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every key held by more than one row, with how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def unique_key(df: DataFrame, keys: list[str], name: str = "primary_key_unique") -> DataFrame:
    """Rows beyond the first of their key: none."""
    extra = F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0))
    return Checks().equal(name, extra, 0, f"key {keys}").run(repeated(df, keys))


def identical_duplicates(df: DataFrame, name: str = "identical_duplicates") -> DataFrame:
    return unique_key(df, df.columns, name)


LISTED = 20      # undeclared values a report names


def values_within(df: DataFrame, column: str, declared: list, name: str) -> DataFrame:
    """The distinct values of a code column are exactly the declared ones, and none is null. Beyond LISTED more than declared
    the report names the first in order of text and how many there are."""
    value = F.coalesce(F.col(column).cast("string"), F.lit("<null>"))
    declared = sorted({str(v) for v in declared})
    distinct = df.select(value.alias("value")).distinct()
    named = distinct.orderBy("value").limit(len(declared) + LISTED)
    all_of_them = distinct.agg(F.count(F.lit(1))).scalar()
    shown = F.concat_ws(",", F.array_sort(F.collect_list("value")))
    more = F.when(all_of_them > len(declared) + LISTED, F.concat(F.lit(",... of "), all_of_them.cast("string"))).otherwise("")
    return Checks().equal(name, F.concat(shown, more), ",".join(declared)).run(named)


def union_checks(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def settle(report: DataFrame) -> DataFrame:
    """The check rows worked out now and kept as plain rows, so that a long run does not carry the plan
    of every check it has made. Checks are declared, so their rows are few."""
    rows = [tuple(r) for r in report.collect()]
    return report.sparkSession.createDataFrame(rows, CHECK_SCHEMA).coalesce(1)


def require(report: DataFrame) -> None:
    """Stop if any check failed, naming how many and the first by name. Checks are declared, so their rows are few."""
    failed = report.where(~F.col("passed")).select("name", "expected", "actual").collect()
    if failed:
        first = min(failed, key=lambda r: r["name"])
        raise ChecksFailed(f"{len(failed)} blocking check(s) failed; first: {first['name']}: expected {first['expected']}, got {first['actual']}")


def summary(report: DataFrame) -> DataFrame:
    judged = F.col("expected").isNotNull()
    return report.agg(F.count_if(judged).alias("checks"), F.count_if(judged & F.col("passed")).alias("blocking_passed"),
                      F.count_if(~F.col("passed")).alias("blocking_failed"))
