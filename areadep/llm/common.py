"""What the corpus operators share: written intermediate tables, runs of equal keys in Arrow batches, components of a graph.

Every intermediate table is written as Parquet in the shared folder of the session (spark.checkpoint.dir), so a lost
executor costs the tasks that were running and never a recomputation of the whole lineage.
"""

from __future__ import annotations

import atexit
import gc
import time
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import ensure_checkpoint_dir


class Scratch:
    """Tables written below the shared folder; dropped one by one when later ones are written, and all when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        gc.collect()
        self.spark._jvm.System.gc()         # lets Spark delete the shuffle files of what has been written
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Waits until Spark has let go of what written steps had shuffled: references first, then the files behind them."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(1)

    def drop(self, name: str = "") -> None:
        try:
            jvm = self.spark._jvm
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session is gone: the folder's owner clears it
            pass


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def extended(schema: T.StructType, more: str) -> T.StructType:
    return T.StructType(schema.fields + T.StructType.fromDDL(more).fields)


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal integer keys in batches sorted by them, as tables; a run may span batches and is held alone in memory."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        if last is not None and first != last:
            yield pa.Table.from_batches(held)
            held = []
        starts = np.flatnonzero(change)
        at = 0
        for s in starts:
            held.append(batch.slice(at, s - at))
            yield pa.Table.from_batches(held)
            held, at = [], s
        held.append(batch.slice(at))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole groups of an integer key, of batches sorted by it, with the bounds of their groups: for many small groups."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        keys = held.column(key).to_numpy()
        starts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if len(starts):
            yield held.slice(0, starts[-1]), np.concatenate([[0], starts])
            held = held.slice(starts[-1])
    if held is not None:
        yield held, np.array([0, held.num_rows])


def numpy_of(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    return table.column(name).to_numpy() if isinstance(table, pa.Table) else table.column(name).to_numpy(zero_copy_only=False)


def bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array without a copy, and the offsets of its rows in them."""
    if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, kind)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat, at


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(id, component): the smallest id reachable over the edges (a, b), for every id on an edge.

    Local contraction: every node moves to the neighbour (or itself) that comes first in a random order, edges follow their
    ends, and the rest is solved in the same way; each two rounds leave a fixed share of the nodes on average. What a round
    aggregates is reduced before the shuffle; its joins are plain, so a hub's edges are split by adaptive skew handling.
    """
    moves: list[DataFrame] = []
    e = scratch.keep(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-e0")
    level = 0
    while not e.isEmpty():
        order = lambda c: F.struct(F.xxhash64(F.lit(level // 2), F.col(c)).alias("o"), F.col(c).alias("v"))  # noqa: B023, E731
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(order("b")).alias("m"))
        move = scratch.keep(first.select(F.col("a").alias("id"), F.least("m", order("a"))["v"].alias("to")), f"{name}-m{level}")
        moves.append(move)
        on_a = e.join(move.select(F.col("id").alias("a"), F.col("to").alias("ta")), "a").select("ta", "b")
        on_b = on_a.join(move.select(F.col("id").alias("b"), F.col("to").alias("tb")), "b").where("ta <> tb")
        level += 1
        e = scratch.keep(on_b.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), f"{name}-e{level}")
    if not moves:
        return edges.select(F.col("a").alias("id"), F.col("a").alias("component")).limit(0)
    root = moves[-1]
    for move in reversed(moves[:-1]):
        root = move.join(root.select(F.col("id").alias("to"), F.col("to").alias("root")), "to", "left").select("id", F.coalesce("root", "to").alias("to"))
    root = scratch.keep(root, f"{name}-root")
    least = root.groupBy("to").agg(F.min("id").alias("component"))
    return root.join(least, "to").select("id", "component")
