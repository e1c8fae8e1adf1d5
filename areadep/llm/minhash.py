"""Near duplicates among documents: improved consistent weighted sampling over TF-IDF shingles, in bands, verified.

Texts with equal shingles are one class, named by a digest of these. A class is sampled DRAWS times in proportion to its
weights (Ioffe's improved scheme, whose draws are looked up by bits of a hash of the shingle); BANDS groups of draws name its
buckets. Classes that share a bucket are compared by weighted Jaccard similarity of all their shingles, and what reaches the
threshold is joined to components. Buckets with the same members are verified once. Only spanning links leave a task. A
bucket of more than BLOCK classes is cut in blocks: first each block is joined within, then one class of each
component with those of the other blocks, and only where a bucket still has several components its blocks meet in twos.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, components, extended, numpy_of, runs
from .shingles import COMMON, SIZE, Hasher, Weights, common_shingles

SIMILAR = 0.8
ROWS, BANDS = 3, 10     # draws of a band, bands: a pair just at 0.8 shares a bucket with 1 - (1 - 0.8³)^10 = 0.9992
BLOCK = 400
SEED = 17


class Sampler:
    """Draws of improved consistent weighted sampling: for each, r and ln c (Gamma(2, 1)) and b (uniform) by 16 bits of a hash each."""

    def __init__(self, draws: int):
        rng = np.random.default_rng(SEED)
        self.r = rng.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
        self.c = np.log(rng.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)
        self.b = ((rng.permutation(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)
        self.salts = rng.integers(1, 1 << 63, draws, dtype=np.uint64) | np.uint64(1)

    def draw(self, d: int, s: np.ndarray, log_w: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each document (its part of the arrays), which element is drawn, and its level."""
        z = s * self.salts[d]
        z ^= z >> np.uint64(29)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        bits = z.view(np.uint16).reshape(-1, 4)
        r, b = self.r[bits[:, 1]], self.b[bits[:, 2]]
        t = np.floor(log_w / r + b)
        a = self.c[bits[:, 3]] - r * (t - b + 1)
        least = np.minimum.reduceat(a, starts)
        hit = np.flatnonzero(a == np.repeat(least, counts))
        first = np.empty(len(starts), np.int64)
        doc = np.searchsorted(starts, hit, "right") - 1
        first[doc[::-1]] = hit[::-1]            # of equals the smaller shingle
        return first, t[first]


def _signatures(shared, size: int, rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, hasher, sampler = Weights(*shared.value), Hasher(size), Sampler(rows * bands)
        with np.errstate(over="ignore"):
            for batch in batches:
                n = batch.num_rows
                digests, named = np.zeros((n, 2), np.uint64), np.zeros((n, bands), np.uint64)
                some = np.zeros(n, bool)
                for i, j, row, s, times in hasher.batch(batch.column("text")):
                    if not len(s):
                        continue
                    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                    counts, at = np.diff(starts, append=len(s)), i + row[starts]
                    some[at] = True
                    u, log_w = s.view(np.uint64), np.log(weights.of(s, times)).astype(np.float32)
                    for k, salt in enumerate((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)):
                        z = (u ^ (times.astype(np.uint64) << np.uint64(48))) * np.uint64(salt)
                        z ^= z >> np.uint64(32)
                        digests[at, k] = np.add.reduceat(z * np.uint64(salt), starts)
                    for d in range(rows * bands):
                        first, t = sampler.draw(d, u, log_w, starts, counts)
                        z = named[at, d // rows] ^ u[first] ^ (t.astype(np.int64).view(np.uint64) << np.uint64(48))
                        z = (z + np.uint64(d + 1)) * np.uint64(0x94D049BB133111EB)
                        named[at, d // rows] = z ^ (z >> np.uint64(31))
                at = np.flatnonzero(some)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * bands, pa.int32()), pa.array(named[at].view(np.int64).ravel()))
                keep = pa.array(at)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(keep), batch.column("x").take(keep), pa.array(digests[at, 0].view(np.int64)),
                                                  pa.array(digests[at, 1].view(np.int64)), lists], names=["doc_id", "x", "d1", "d2", "bands"])
    return run


def _weighted(shared, size: int):
    """The shingles of a text and their weights, sorted by shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, hasher = Weights(*shared.value), Hasher(size)
        for batch in batches:
            for i, j, row, s, times in hasher.batch(batch.column("text")):
                ends = pa.array(np.searchsorted(row, np.arange(j - i + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("x").slice(i, j - i), pa.ListArray.from_arrays(ends, pa.array(s)),
                                                  pa.ListArray.from_arrays(ends, pa.array(weights.of(s, times)))], names=["x", "s", "w"])
    return run


def _verify(similar: float):
    """Spanning links between the members of each group: what is already in one component is not compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["bucket", "i", "j"]):
            m = part.num_rows
            if m < 2:
                continue
            x, block = numpy_of(part, "x"), numpy_of(part, "block")
            root = np.unique(numpy_of(part, "comp"), return_inverse=True)[1]
            lists = part.column("s").combine_chunks()
            s, w = lists.flatten().to_numpy(), part.column("w").combine_chunks().flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
            of = np.repeat(np.arange(m), np.diff(starts))
            total = np.bincount(of, weights=w, minlength=m)
            out: list[tuple[int, int]] = []
            two = block.min() != block.max()

            def meet(p: int) -> None:
                others = np.flatnonzero((root != root[p]) & ((block != block[p]) if two else True))  # noqa: B023
                if not len(others):
                    return
                a, b = starts[p], starts[p + 1]  # noqa: B023
                at = np.minimum(np.searchsorted(s[a:b], s), b - a - 1)  # noqa: B023
                hit = s[a:b][at] == s  # noqa: B023
                both = np.bincount(of[hit], weights=np.minimum(w[hit], w[a:b][at[hit]]), minlength=m)  # noqa: B023
                near = others[both[others] >= similar * (total[p] + total[others] - both[others]) - 1e-9]  # noqa: B023
                for q in near[np.unique(root[near], return_index=True)[1]].tolist():  # noqa: B023
                    out.append((x[p], x[q]))  # noqa: B023
                root[np.isin(root, root[near])] = root[p]  # noqa: B023

            first = np.zeros(m, bool)       # those that no earlier one took
            for p in range(m):
                if (root[:p] != root[p]).all():
                    first[p] = True
                    meet(p)
            for p in np.flatnonzero(~first).tolist():
                if (root == root[0]).all():
                    break
                meet(p)
            if out:
                a, b = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def _compare(members: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """members: bucket, i, j, block, x, comp."""
    rows = members.join(sets, "x").select("bucket", "i", "j", "block", "x", "comp", "s", "w")
    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "x").mapInArrow(_verify(similar), "a long, b long")


def _in_blocks(members: DataFrame, block: int) -> DataFrame:
    """Members of each bucket dealt into blocks of about `block`, with the number of its blocks."""
    sizes = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    return members.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("x", "bucket"), "blocks").cast("int"))


def links(members: DataFrame, sets: DataFrame, scratch: Scratch, similar: float, block: int = BLOCK) -> DataFrame:
    """(a, b) that span the components of all links within the buckets of (bucket, x)."""
    dealt = scratch.keep(_in_blocks(members, block), "dealt")
    alone = [F.col("block").alias("i"), F.col("block").alias("j"), "block", "x"]
    found = scratch.keep(_compare(dealt.select("bucket", *alone, F.col("x").alias("comp")), sets, similar), "links0")
    big = dealt.where("blocks > 1")
    if big.isEmpty():
        return found

    def joined(rows: DataFrame, name: str) -> DataFrame:
        part_of = components(found, scratch, name).select(F.col("id").alias("x"), F.col("component").alias("c"))
        return rows.join(part_of, "x", "left").select("bucket", "blocks", "block", "x", F.coalesce("c", "x").alias("comp"))

    now = scratch.keep(joined(big, "cc1"), "now1")
    leaders = _in_blocks(now.groupBy("bucket", "comp").agg(F.min("x").alias("x")), block)
    found = found.union(scratch.keep(_compare(leaders.select("bucket", *alone, "comp"), sets, similar), "links1"))
    now = scratch.keep(joined(big, "cc2"), "now2")
    still = now.groupBy("bucket").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("bucket")
    rest = now.join(still, "bucket").withColumn("o", F.explode(F.expr("filter(sequence(0, blocks - 1), o -> o <> block)")))
    pairs = rest.select("bucket", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "x", "comp")
    return found.union(scratch.keep(_compare(pairs, sets, similar), "links2"))


def near_duplicates(docs: DataFrame, scratch: Scratch, similar: float = SIMILAR, size: int = SIZE, rows: int = ROWS, bands: int = BANDS,
                    common: int = COMMON, block: int = BLOCK) -> DataFrame:
    """(doc_id, x, class_id, kept) of each row of (doc_id, text).

    class_id: the smallest doc_id of the texts joined by links of weighted Jaccard similarity `similar` or more; kept: the one of a
    class that stays, by doc_id and then by x, a hash of doc_id and text by which the rows can be joined. Texts null, empty or
    without words link with nothing, not with each other. Equal rows have equal answers.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.xxhash64("doc_id", text).alias("x"), text.alias("text"))
    texts = docs.where("text is not null").select("text")
    n = docs.count()
    shared = docs.sparkSession.sparkContext.broadcast((common_shingles(texts, n, size, common), n, common))      # bounded: see there
    schema = extended(keyed.select("doc_id", "x").schema, "d1 long, d2 long, bands array<long>")
    signed = scratch.keep(keyed.mapInArrow(_signatures(shared, size, rows, bands), schema), "signed")
    kinds = scratch.keep(signed.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "x")).alias("first"), F.first("bands").alias("bands")).select(
        "d1", "d2", "first.x", "bands"), "kinds")
    posted = kinds.select("x", F.posexplode("bands").alias("k", "h"))
    shape = posted.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("x").cast("decimal(20,0)")).alias("sum"))
    chosen = shape.where("n > 1").groupBy("n", "sum").agg(F.min(F.struct("k", "h")).alias("b")).select("b.k", "b.h")      # same members: once
    members = scratch.keep(posted.join(chosen, ["k", "h"]).select(F.xxhash64("k", "h").alias("bucket"), "x"), "members")
    wanted = members.select("x").distinct()
    sets = scratch.keep(keyed.join(wanted.hint("merge"), "x").dropDuplicates(["x"]).select("x", "text").mapInArrow(_weighted(shared, size), "x long, s array<long>, w array<double>"), "sets")
    part_of = components(links(members, sets, scratch, similar, block), scratch)
    named = kinds.join(part_of.select(F.col("id").alias("x"), "component"), "x", "left").select("d1", "d2", F.coalesce("component", "x").alias("c"))
    rows_of = scratch.keep(signed.select("doc_id", "x", "d1", "d2").join(named, ["d1", "d2"]).select("doc_id", "x", "c"), "classes")
    first = rows_of.groupBy("c").agg(F.min(F.struct("doc_id", "x")).alias("first"))
    done = rows_of.join(first, "c").select("doc_id", "x", F.col("first.doc_id").alias("class_id"), (F.col("x") == F.col("first.x")).alias("kept"))
    rest = keyed.select("doc_id", "x").join(signed.select("x"), "x", "left_anti")
    return done.union(rest.select("doc_id", "x", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept")))
