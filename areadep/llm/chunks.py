"""Substring dedup by content-defined chunks.

A gear rolling hash of the last 32 bytes cuts texts where its upper bits are zero, so cuts depend on content alone and an
insertion moves only the chunks it touches. Chunks are deduplicated by digest: the first, by doc_id and place, stays. The query
counts every repeated chunk (run=1). With a larger `run`, RUN by default, only runs of so many repeated bytes count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, bytes_of, extended
from .repeats import _remove, keyed

BITS = 5            # a cut is expected after 2^BITS bytes beyond LEAST
LEAST, MOST = 16, 512
RUN = 128
PART = 1 << 20
SEED = 29


class Gear:
    def __init__(self, bits: int = BITS):
        self.values = np.random.default_rng(SEED).integers(0, 1 << 32, 256, dtype=np.uint32)
        self.shift = np.uint32(32 - bits)

    def cuts(self, flat: np.ndarray) -> np.ndarray:
        """Ends of possible chunks. The hash is the sum of values of the last 32 bytes, each shifted by its distance."""
        h = self.values[flat]
        for k in (1, 2, 4, 8, 16):
            h[k:] += h[:-k] << np.uint32(k)
        return np.flatnonzero(h >> self.shift == 0) + 1

    def bounds(self, flat: np.ndarray, ends: np.ndarray, least: int, most: int) -> list[int]:
        """Chunk ends in the documents that end at `ends`, theirs included; flat may be long."""
        parts = [self.cuts(flat[max(0, a - 31):a + PART]) for a in range(0, len(flat), PART)]
        parts = [p[p > (31 if k else 0)] + (k * PART - (31 if k else 0)) for k, p in enumerate(parts)]
        cuts = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        out, last, k = [], 0, 0
        cut = cuts.tolist()
        for end in ends.tolist():
            if end == last:
                continue
            begin = last
            while k < len(cut) and cut[k] < end:
                c = cut[k]
                k += 1
                if c - begin < max(least, 32) or c - last < least:      # the first 32 bytes' hash depends on what stands before
                    continue
                while c - last > most:
                    last += most
                    out.append(last)
                out.append(c)
                last = c
            while end - last > most:
                last += most
                out.append(last)
            out.append(end)
            last = end
        return out


def _chunks(bits: int, least: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear = Gear(bits)
        for batch in batches:
            flat, at = bytes_of(batch.column("text"))
            i = 0
            while i < batch.num_rows:
                j = max(i + 1, int(np.searchsorted(at, at[i] + PART, "right")) - 1)
                data = flat[at[i]:at[j]]
                ends = np.array(gear.bounds(data, at[i + 1:j + 1] - at[i], least, most), np.int64)
                starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                raw = data.tobytes()
                digest = b"".join(hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
                two = np.frombuffer(digest, np.int64).reshape(-1, 2)
                doc = np.searchsorted(at[i + 1:j + 1] - at[i], starts, "right")
                rows = pa.array(doc + i)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in ("doc_id", "x1", "x2")), pa.array((starts - (at[i:j] - at[i])[doc]).astype(np.int32)),
                                                  pa.array((ends - starts).astype(np.int32)), pa.array(two[:, 0].copy()), pa.array(two[:, 1].copy())], names=names)
                i = j
    names = ["doc_id", "x1", "x2", "start", "size", "d1", "d2"]
    return run


def _spans(run_bytes: int):
    """From a document's repeated chunks: how many bytes are in long enough runs, and the parts of these that are not first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("at")
            rows = lists.flatten()
            counts = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), counts)
            start, size = (rows.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "size"))
            first = rows.field("first").to_numpy(zero_copy_only=False).astype(bool)
            order = np.lexsort((start, row))
            row, start, size, first = row[order], start[order], size[order], first[order]
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + size[:-1])]) if len(row) else np.zeros(0, bool)
            of = np.cumsum(new) - 1
            total = np.bincount(of, weights=size) if len(of) else np.zeros(0)
            long = total[of] >= run_bytes if len(of) else np.zeros(0, bool)
            repeated = np.bincount(row[long], weights=size[long], minlength=batch.num_rows).astype(np.int64)
            out = long & ~first
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[out], minlength=batch.num_rows))])
            spans = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(start[out]), pa.array(start[out] + size[out])], ["a", "b"]))
            yield pa.RecordBatch.from_arrays([batch.column("x1"), batch.column("x2"), pa.array(repeated), spans], names=["x1", "x2", "n_repeated", "spans"])
    return run


def dedup(docs: DataFrame, scratch: Scratch, run: int = RUN, bits: int = BITS, least: int = LEAST, most: int = MOST, texts: bool = True) -> DataFrame:
    """Each row of (doc_id, text) without chunks that occur before, in runs of `run` bytes or more of repeated chunks.

    Returns doc_id, n_repeated (bytes in such runs, first occurrences included), n_bytes, n_removed, n_spans, kept_sha256 and, if
    `texts`, kept_text and span_edges. Text null: empty. Equal rows are one document to this operator, as they have the same places:
    each keeps what the first of them keeps. Rows without doc_id come first.
    """
    rows = keyed(docs)
    found = scratch.keep(rows.mapInArrow(_chunks(bits, least, most), extended(rows.select("doc_id").schema, "x1 long, x2 int, start int, size int, d1 long, d2 long")), "chunks")
    # Each step is written, so its shuffle is gone before the next, and the joins have shuffles of their own, which can be split.
    often = scratch.keep(found.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1", "d2"), "digests")
    many = scratch.keep(found.join(often, ["d1", "d2"]), "repeated")
    scratch.drop("chunks")
    ones = scratch.keep(many.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "x1", "x2", "start")).alias("one")).select(
        "d1", "d2", F.col("one.x1").alias("f1"), F.col("one.x2").alias("f2"), F.col("one.start").alias("f3")), "first")
    first = (F.col("x1") == F.col("f1")) & (F.col("x2") == F.col("f2")) & (F.col("start") == F.col("f3"))
    again = many.join(ones, ["d1", "d2"]).select("x1", "x2", F.struct("start", "size", first.alias("first")).alias("at"))
    lists = again.groupBy("x1", "x2").agg(F.collect_set("at").alias("at"))      # bounded by the text
    spans = scratch.keep(lists.mapInArrow(_spans(run), "x1 long, x2 int, n_repeated long, spans array<struct<a: long, b: long>>"), "spans")
    for done in ("digests", "repeated", "first"):
        scratch.drop(done)
    joined = rows.join(spans.hint("merge"), ["x1", "x2"], "left").select("doc_id", F.coalesce("n_repeated", F.lit(0)).cast("long").alias("n_repeated"), "text", "spans")
    fields = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string, span_edges array<long>" if texts else "")
    return joined.mapInArrow(_remove(["doc_id", "n_repeated"], texts), extended(joined.select("doc_id", "n_repeated").schema, fields))
