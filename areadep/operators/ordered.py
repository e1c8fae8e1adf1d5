"""Ordered passes over groups of any size, as a scan of range partitions.

A window over a whole group runs in one task. Here rows are put in order over all partitions by
repartitionByRange, whose bounds are drawn from the data, so outliers and hot groups only move the
bounds. The ordered rows are checkpointed, since bounds are sampled anew whenever a plan runs. Each
partition is then summed up; only its first group can have begun in an earlier one, so what is
carried in is one value a partition. Last, each partition is passed over once, batch by batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..session import ensure_checkpoint_dir


def in_order(df: DataFrame, groups: list[str], order: str) -> DataFrame:
    """The rows, sorted over all partitions by group and ordering value, with the number of their partition as `_part`."""
    ensure_checkpoint_dir(df.sparkSession)
    keys = [*groups, order]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id()).checkpoint()


def carried(rows: DataFrame, groups: list[str], summary: Column, across) -> dict[int, object]:
    """Per partition what its first group brings along: `across` of the summaries of earlier partitions with that group. One value a
    partition at most, since a group that begins inside a partition has no earlier one."""
    per = rows.groupBy("_part", *groups).agg(summary.alias("_s"))
    before = across(W.partitionBy(*groups).orderBy("_part"))
    return {r["_part"]: r["_c"] for r in per.select("_part", before.alias("_c")).where("_c is not null").collect()}


def _begins(batch: pa.RecordBatch, groups: list[str], last: pa.RecordBatch | None) -> np.ndarray:
    """Which rows begin a group, given the row before the batch (the first row of a partition does not)."""
    out = np.zeros(batch.num_rows, bool)
    for g in groups:
        column = batch.column(batch.schema.get_field_index(g))
        before = pa.concat_arrays([last.column(last.schema.get_field_index(g)) if last is not None else column.slice(0, 1), column.slice(0, len(column) - 1)])
        differ = pc.or_(pc.fill_null(pc.not_equal(column, before), False), pc.xor(pc.is_null(column), pc.is_null(before)))
        out |= differ.to_numpy(zero_copy_only=False)
    return out


def _passed(rows: DataFrame, groups: list[str], out: T.StructField, step) -> DataFrame:
    """Rows with one column more, by `step(batch, begins, part, state)`, which returns the column and the state for the next batch."""
    schema = T.StructType([f for f in rows.schema.fields if f.name != "_part"] + [out])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            if batch.num_rows:
                part = batch.column(batch.schema.get_field_index("_part"))[0].as_py()
                column, state = step(batch, _begins(batch, groups, last), part, state)
                last = batch.slice(batch.num_rows - 1)
                kept = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != "_part"]
                yield pa.RecordBatch.from_arrays([*kept, column], names=schema.names)

    return rows.mapInArrow(scan, schema)


def running_total(df: DataFrame, groups: list[str], order: str, value: str, out: str) -> DataFrame:
    """Sum of value up to and including each row, in order inside each group; a missing value counts as nothing. The ordering value
    must be unique inside a group (sum equal ones first), and the value a whole number or a double."""
    whole = isinstance(df.schema[value].dataType, T.IntegralType)
    if not whole and not isinstance(df.schema[value].dataType, T.FractionalType):
        raise TypeError(f"{value} must be whole numbers or doubles")
    rows = in_order(df, groups, order)
    kind = T.LongType() if whole else T.DoubleType()
    sums = carried(rows, groups, F.sum(F.col(value).cast(kind)), lambda w: F.sum("_s").over(w.rowsBetween(W.unboundedPreceding, -1)))

    def step(batch, begins, part, state):
        values = pc.fill_null(batch.column(batch.schema.get_field_index(value)), 0).to_numpy(zero_copy_only=False).astype(np.int64 if whole else float)
        so_far = sums.get(part, 0) if state is None else state
        upto = np.cumsum(values)
        at = np.flatnonzero(begins)
        # What the groups before a row's own have summed up to; negative while its group is the one carried in.
        gone = np.append(-so_far, upto[at] - values[at])[np.searchsorted(at, np.arange(len(values)), "right")]
        total = upto - gone
        return pa.array(total, pa.int64() if whole else pa.float64()), total[-1]

    return _passed(rows, groups, T.StructField(out, kind), step)


def previous_value(df: DataFrame, groups: list[str], order: str, value: str, out: str) -> DataFrame:
    """The value of the row before, in order inside each group; the ordering value is unique there."""
    rows = in_order(df, groups, order)
    lasts = carried(rows, groups, F.max_by(value, order), lambda w: F.lag("_s").over(w))

    def step(batch, begins, part, state):
        column = batch.column(batch.schema.get_field_index(value))
        before = pa.array([lasts.get(part)], column.type) if state is None else state
        moved = pa.concat_arrays([before, column.slice(0, len(column) - 1)])
        return pc.if_else(pa.array(begins), pa.scalar(None, column.type), moved), column.slice(len(column) - 1)

    return _passed(rows, groups, T.StructField(out, df.schema[value].dataType), step)


def falls(df: DataFrame, groups: list[str], rank: str, band: str) -> DataFrame:
    """Per group: how often a band falls as the rank rises. Zones of equal rank are taken in band
    order, so only the step from one rank to the next can fall."""
    steps = df.groupBy(*groups, rank).agg(F.min(band).alias("_low"), F.max(band).alias("_high"))
    steps = previous_value(steps, groups, rank, "_high", "_prev")
    return steps.groupBy(*groups).agg(F.count_if(F.coalesce(F.col("_low") < F.col("_prev"), F.lit(False))).alias("falls"))
