"""Near duplicates among embeddings: sign hashing by random hyperplanes in several tables, exact cosines, components.

Vectors that are equal are one class with a count, so copies never meet each other. Two classes of one label whose signs
agree in any table are compared in double precision. A pair is counted in the first table in which it meets, so links are
counted and joined to components without ever being listed. A bucket with more than BLOCK classes is dealt into blocks, and
each two blocks of it are one task's work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, components, extended, numpy_of, runs

COSINE = 0.93
MISS = 2e-4         # chance that a pair just at the threshold meets in no table
FULL = 64           # classes a bucket of the largest label should hold
BLOCK = 1024        # classes of a bucket that one task holds, twice at most
SEED = 7


def usable(vector: str = "embedding"):
    """Neither null, empty or zero, nor with a null or non-finite component."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(flat: np.ndarray, width: int) -> np.ndarray:
    x = flat.reshape(-1, width).astype(float)
    x /= np.abs(x).max(axis=1, keepdims=True)       # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def plan(largest: int, cosine: float, miss: float = MISS, full: int = FULL) -> tuple[int, int]:
    """Bits of a table and number of tables: bits from the classes of the largest label, tables so that the chance to miss stays."""
    bits = min(24, max(4, math.ceil(math.log2(max(largest, 1) / full)) if largest > full else 4))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - meet)))


def classes(vectors: DataFrame, scratch: Scratch) -> DataFrame:
    """(space, embedding, id, n): usable vectors with a label, equal ones together; id is the smallest vec_id. Vectors of one
    label and one width are a space; what is in different spaces is never compared."""
    rows = vectors.where(usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    grouped = rows.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"))
    return scratch.keep(grouped.select(F.xxhash64("label", F.size("embedding")).alias("space"), "label", "embedding", "id", "n"), "classes")


def signs(found: DataFrame, bits: int, tables: int, seed: int = SEED) -> DataFrame:
    """With `codes`: for each table, on which side of each of its hyperplanes a vector lies."""
    schema = extended(found.schema, "codes array<int>")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            column = batch.column("embedding")
            widths = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False)
            out = np.zeros((batch.num_rows, tables), np.int32)
            starts = np.concatenate([[0], np.cumsum(widths)])
            for w in np.unique(widths).tolist():
                if w not in planes:
                    planes[w] = np.random.default_rng((seed, w)).standard_normal((w, tables * bits))
                at = np.flatnonzero(widths == w)
                x = unit(flat[(starts[at][:, None] + np.arange(w)).ravel()], w)
                side = (x @ planes[w] > 0).reshape(len(at), tables, bits)
                out[at] = side @ (1 << np.arange(bits))
            codes = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * tables, pa.int32()), pa.array(out.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, codes], names=schema.names)

    return found.mapInArrow(code, schema)


def _linked(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["space", "t", "code", "i", "j"]):
            m = part.num_rows
            if m < 2:
                continue
            ids, n, t = numpy_of(part, "id"), numpy_of(part, "n"), int(part.column("t")[0].as_py())
            vectors = part.column("embedding").combine_chunks()
            x = unit(vectors.flatten().to_numpy(zero_copy_only=False), len(vectors.flatten()) // m)
            near = x @ x.T >= cosine
            block = numpy_of(part, "block")
            if block.min() != block.max():                  # two blocks: pairs within one are another task's
                near &= block[:, None] != block[None, :]
            a, b = np.nonzero(np.triu(near, 1))
            if t and len(a):
                codes = part.column("codes").combine_chunks().flatten().to_numpy().reshape(m, -1)[:, :t]
                new = np.concatenate([~(codes[a[k:k + 50_000]] == codes[b[k:k + 50_000]]).any(axis=1) for k in range(0, len(a), 50_000)])
                a, b = a[new], b[new]
            if not len(a):
                continue
            links = np.bincount(a, weights=n[b], minlength=m) + np.bincount(b, weights=n[a], minlength=m)
            root = np.arange(m)
            while True:
                low = np.minimum(root[a], root[b])
                after = root.copy()
                np.minimum.at(after, a, low)
                np.minimum.at(after, b, low)
                after = after[after]
                if (after == root).all():
                    break
                root = after
            hit = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(ids[root[hit]]), pa.array(links[hit].astype(np.int64))], names=["id", "other", "links"])
    return run


def near_duplicates(vectors: DataFrame, scratch: Scratch, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, embedding, label).

    Linked are other rows of the same label with cosine >= `cosine`. Vectors null, empty, zero or with null or non-finite
    components, rows without label or vec_id, and vectors of different width link with nothing; a row without links is its own
    component. A vec_id that occurs twice is two vectors. Pairs are found by the hash tables, see MISS; what is found is exact.
    """
    found = classes(vectors.select("vec_id", "embedding", "label"), scratch)
    largest = found.groupBy("space").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(largest, cosine)
    coded = scratch.keep(signs(found.drop("label"), bits, tables), "codes")
    posted = coded.select("space", F.posexplode("codes").alias("t", "code"), "id")
    crowded = posted.groupBy("space", "t", "code").count().where(F.col("count") > block).select(
        "space", "t", "code", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    rows = coded.select("space", F.posexplode("codes").alias("t", "code"), "id", "n", "embedding", "codes").join(crowded, ["space", "t", "code"], "left")
    b = F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).cast("int")
    rows = rows.withColumn("block", b).withColumn("o", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    rows = rows.select("space", "t", "code", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "id", "n", "embedding", "codes")
    key = ["space", "t", "code", "i", "j"]
    linked = scratch.keep(rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(_linked(cosine), "id long, other long, links long"), "linked")
    part_of = components(linked.select(F.col("id").alias("a"), F.col("other").alias("b")), scratch)
    counts = linked.groupBy("id").agg(F.sum("links").alias("links"))
    answer = found.join(counts, "id", "left").join(part_of, "id", "left").select(
        "label", "embedding", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    kept = F.coalesce("component_id", "vec_id")
    return vectors.select("vec_id", "label", F.when(usable(), F.col("embedding")).alias("embedding")).join(answer, ["label", "embedding"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), kept.alias("component_id"), F.coalesce(kept == F.col("vec_id"), F.lit(True)).alias("kept"))
