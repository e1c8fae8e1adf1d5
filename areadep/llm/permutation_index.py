"""Nearest neighbours by a permutation index.

Equal vectors are one, indexed once with the smallest ids of its copies, so copies take no place of another vector; they are told
apart again after the rerank. A vector is represented by its nearest pivots in order. The vectors are dealt into blocks; each block posts its vectors in
inverted files, one for each pivot, with the pivot's place in the vector's order. A query walks the files of its own nearest
pivots and adds up, for each vector posted there, what gives the footrule distance of the two orders; the vectors first by it
are reranked by their exact cosine. The best of all blocks are merged.

With places from 0 and `near` for a pivot that is not in an order, the footrule distance of two orders is
near·(near + 1) - 2·Σ (near - max(place, place')) over the pivots in both, so the sum over shared postings ranks the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import Scratch, numpy_of, runs
from .neardup_vectors import unit, usable

PIVOTS = 256        # taken from the distinct vectors by a hash of their id: a bounded sample; every vector is indexed
NEAR = 64           # pivots in a vector's order
SHARE = 0.2         # of a block's distinct vectors that are reranked for a query, at least LEAST
LEAST = 500
BLOCK = 8192        # distinct vectors of a block, as a mean
QUERIES = 1024      # queries that meet a block at a time, as a mean


def _best(pivots: np.ndarray, near: int, share: float, least: int, k: int):
    near = min(near, max(1, len(pivots) // 2))

    def order(x: np.ndarray) -> np.ndarray:
        return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :near]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["block", "ask"]):
            asks = numpy_of(part, "is_query").astype(bool)
            if asks.all() or not asks.any():
                continue
            ids = numpy_of(part, "vec_id")
            vectors = part.column("embedding").combine_chunks()
            x = unit(vectors.flatten().to_numpy(zero_copy_only=False), pivots.shape[1])
            by_id = np.argsort(ids, kind="stable")
            rows = by_id[~asks[by_id]]
            u, n = x[rows], len(rows)
            copies = part.column("copies").combine_chunks().take(pa.array(rows))
            names, starts = copies.flatten().to_numpy(), copies.offsets.to_numpy()
            starts, counts = starts[:-1] - starts[0], np.diff(starts)
            places = order(u)
            of, row = places.ravel(), np.repeat(np.arange(n), near)
            place = np.tile(np.arange(near), n)
            sort = np.argsort(of, kind="stable")
            row, place = row[sort], place[sort]
            ends = np.searchsorted(of[sort], np.arange(len(pivots) + 1))
            many = min(n, max(least, int(share * n)))
            out: list[tuple] = []
            for q in np.flatnonzero(asks):
                gain = np.zeros(n, np.int64)
                for at, p in enumerate(order(x[q:q + 1])[0].tolist()):
                    a, b = ends[p], ends[p + 1]
                    gain[row[a:b]] += near - np.maximum(place[a:b], at)      # a vector is in a file once
                key = -(gain * n) + np.arange(n)                             # ties: the smaller id first
                first = np.argpartition(key, many - 1)[:many] if many < n else np.arange(n)
                score = np.repeat((u[first] * x[q]).sum(axis=1), counts[first])
                each = np.repeat(starts[first] - np.cumsum(counts[first]) + counts[first], counts[first]) + np.arange(len(score))
                name = names[each]
                top = np.lexsort((name, -score))
                top = top[name[top] != ids[q]][:k]
                out += [(ids[q], name[t], score[t]) for t in top]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])
    return run


def distinct(rows: DataFrame, k: int) -> DataFrame:
    """(vec_id, embedding, width, copies): equal vectors once, with the ids of the first copies. Any k of them without one id are among the
    k + 1 smallest ids, each k times at most. The window drops the others before its shuffle."""
    ids = rows.groupBy("width", "embedding", "vec_id").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(W.partitionBy("width", "embedding").orderBy("vec_id"))
    few = ids.withColumn("place", place).where(F.col("place") <= k + 1)
    lists = few.groupBy("width", "embedding").agg(F.sort_array(F.collect_list(F.struct("vec_id", F.least("n", F.lit(k)).cast("int").alias("n")))).alias("ids"))
    copies = F.flatten(F.transform("ids", lambda i: F.array_repeat(i["vec_id"], i["n"])))
    return lists.select(F.col("ids")[0]["vec_id"].alias("vec_id"), "embedding", "width", copies.alias("copies"))


def nearest(vectors: DataFrame, queries: DataFrame, scratch: Scratch, k: int = 5, pivots: int = PIVOTS, near: int = NEAR,
            share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of `vectors` with the largest cosine to each row of `queries`, its own id excepted.

    Both have (vec_id, embedding). Vectors null, empty, zero or with null or non-finite components take no part, nor do rows
    without vec_id; vectors of different width do not meet. Ties go to the smaller vec_id. Fewer than k candidates: all of them.
    """
    fine = usable() & F.col("vec_id").isNotNull()
    rows = scratch.keep(distinct(vectors.where(fine).select("vec_id", "embedding", F.size("embedding").alias("width")), k), "vectors")
    asked = scratch.keep(queries.where(fine).select("vec_id", "embedding", F.size("embedding").alias("width")), "asked")
    found = None
    asks = {r["width"]: r["count"] for r in asked.groupBy("width").count().collect()}         # one row a width
    for r in rows.groupBy("width").count().collect():
        width, count = r["width"], r["count"]
        if width not in asks:
            continue
        mine = rows.where(F.col("width") == width)
        sample = mine.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("embedding").collect()
        pivot = unit(np.array([x[0] for x in sample], float).ravel(), width)
        blocks, parts = -(-count // BLOCK), -(-asks[width] // QUERIES)
        spread = lambda df, salt, n: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
        kept = mine.select(spread(mine, 1, blocks).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("ask"), "vec_id", "embedding", "copies", F.lit(0).alias("is_query"))
        wants = asked.where(F.col("width") == width)
        wants = wants.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), spread(wants, 2, parts).alias("ask"), "vec_id", "embedding", F.array("vec_id").alias("copies"), F.lit(1).alias("is_query"))
        met = kept.union(wants).repartition("block", "ask").sortWithinPartitions("block", "ask")
        best = met.mapInArrow(_best(pivot, near, share, least, k), "query_id long, vec_id long, score double")
        found = best if found is None else found.union(best)
    if found is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
