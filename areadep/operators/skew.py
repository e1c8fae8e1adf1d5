"""Joins to a table that holds one row per key, when some keys carry much of the other side.

Two physical ways, chosen by size and never by hope:

* the keyed table is measured and small: it is broadcast, and the large side is not shuffled;
* otherwise the large side is shuffled by key, and of heavy keys by key and share. A key is heavy when
  it holds more than 1/HEAVY of all rows, so there are fewer than HEAVY heavy keys whatever the data:
  that is the size bound of the one broadcast used here, of these keys alone. Rows of heavy keys are
  dealt over their shares instead of meeting in one task, and each share has a copy of the match.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

HEAVY = 1024
BROADCAST_BYTES = 128 << 20      # that a broadcast may have: eight for each cell, and the length of what is longer


def all_null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def key_counts(df: DataFrame, keys: list[str], name: str = "n_rows") -> DataFrame:
    """Rows per key. Partial counts are taken before the shuffle, so a heavy key costs nothing here."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def heavy_keys(counts: DataFrame, keys: list[str], name: str = "n_rows", heavy: int = HEAVY, copies: str | None = None) -> DataFrame:
    """Keys that hold more than 1/heavy of the rows: at most `heavy` of them. `copies` names a column for how many such shares a key holds."""
    threshold = counts.agg(F.sum(name) / F.lit(heavy)).scalar()
    shares = [F.ceil(F.col(name) / threshold).cast("long").alias(copies)] if copies else []
    return counts.where(F.col(name) > threshold).select(*keys, *shares)


def row_bytes(schema: T.StructType, prefix: str = "") -> Column:
    """About how many bytes a row takes: eight a cell, and the length of text, binary values, lists and maps."""
    # The texts in a row, not a sum of hundreds of lengths: Spark walks a chain of sums on the stack.
    texts = long_cells(schema, prefix)
    held = F.octet_length(F.concat_ws("", *texts)).cast("long") if texts else F.lit(0).cast("long")
    return F.lit(8 * cells(schema)).cast("long") + held


def cells(schema: T.StructType) -> int:
    return sum(cells(f.dataType) if isinstance(f.dataType, T.StructType) else 1 for f in schema.fields)


def long_cells(schema: T.StructType, prefix: str = "") -> list[Column]:
    """Text, binary values, lists and maps as text."""
    texts = []
    for f in schema.fields:
        name = f"{prefix}`{f.name}`"
        if isinstance(f.dataType, T.StructType):
            texts += long_cells(f.dataType, name + ".")
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            texts.append(F.col(name).cast("string"))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            texts.append(F.to_json(F.struct(name)))
    return texts


def measured(df: DataFrame, most: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """The table, kept for reuse, and whether its rows, all measured, are small enough to broadcast."""
    kept = df.persist()
    size = kept.agg(F.sum(row_bytes(kept.schema))).first()[0]
    return kept, (size or 0) <= most


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], *, counts: DataFrame | None = None,
                small: bool = False) -> DataFrame:
    """Left join to a table with one row per key (null equals null). `small` says its size was checked.
    `counts` is key_counts(left, on) where the caller has it already."""
    value = [c for c in right.columns if c not in on]
    pairs = [(c, f"_r_{c}") for c in on]
    if small:
        flat = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], *value)
        return left.join(F.broadcast(flat), all_null_safe(left, flat, pairs), "left").select(*[left[c] for c in left.columns], *[flat[c] for c in value])
    packed = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], F.struct(*value).alias("_v"))

    counts = counts if counts is not None else key_counts(left, on)
    heavy = heavy_keys(counts, on, copies="_copies").withColumnsRenamed({c: f"_h_{c}" for c in on})
    copied = lambda df, names: df.join(F.broadcast(heavy), all_null_safe(df, heavy, [(n, f"_h_{c}") for n, c in zip(names, on)]), "left")
    tagged = copied(left, on)
    tagged = tagged.select(*[left[c] for c in left.columns], F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_copies")), F.lit(0)).alias("_spread"))
    # A heavy key's row once for each share, fewer than 2 * HEAVY in all, so that it does not travel with each of the rows it answers.
    names = [f"_r_{c}" for c in on]
    shares = copied(packed, names).select(*names, "_v", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_copies", F.lit(1)) - 1)).alias("_rs"))
    joined = tagged.join(shares, all_null_safe(tagged, shares, pairs) & (tagged["_spread"] == shares["_rs"]), "left")
    return joined.select(*left.columns, *[F.col(f"_v.{c}").alias(c) for c in value])
