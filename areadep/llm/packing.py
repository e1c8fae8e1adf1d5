"""Best-fit packing of tokenised documents into sequences, with certified bin counts and exchange between partitions.

Pieces are dealt evenly into partitions of bounded size. Each partition is packed by best-fit decreasing, and dual-feasible
functions of its lengths give a lower bound: a partition that reaches it is certified and settled. The others have a gap;
they give up the documents of their emptiest sequences, these are dealt anew among few partitions and packed again, and a
repacked pool is taken only where it needs fewer sequences. No partition ever holds more than about TARGET tokens.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, extended, numpy_of, runs

CAPACITY = 2048
TARGET = 8_000_000      # tokens of a partition, as a mean
RELEASE = 64            # emptiest sequences that a partition with a gap gives up
ROUNDS = 5              # of exchange
MEMO = 400_000          # words with their ids that a task remembers at a time
SLICE = 1_000_000       # characters encoded at a time

SPLIT = re.compile(r" (?=\S)")      # no token spans such a place: a space joins the word that follows it
ODD = re.compile(r" (?!\S)")
PLAIN = re.compile(r"[\x00-ɏ]*")    # characters on whose classes all libraries agree


@dataclass
class Vocabulary:
    """Where the byte-level BPE is: as `tokenizers` reads it, and the same vocabulary as ranks."""
    json: str = "byte_bpe_50k.json"
    ranks: str = "byte_bpe_50k.tiktoken"
    special: str = "<|endoftext|>"
    end: int = 0

    def encoder(self) -> Encoder:
        return Encoder(self)


class Words(dict):
    """Ids of a piece of text between two places where no token crosses, as little-endian unsigned 32-bit bytes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        self[word] = ids = self.encode(word)
        return ids


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(public_tokenizers.path(vocabulary.json))
        with open(public_tokenizers.path(vocabulary.ranks), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = vocabulary.special
        self.first, self.later = Words(self.word), Words(lambda w: self.word(" " + w))

    def word(self, text: str) -> bytes:
        ids = self.fast.encode_ordinary(text) if PLAIN.fullmatch(text) else self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """The ids that the whole text has, found word by word; the same as encoding it at once."""
        if self.special in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        out, at, words = [], 0, self.first
        while at < len(text):
            cut = SPLIT.search(text, at + SLICE) if len(text) - at > SLICE else None
            part = text[at:cut.start() if cut else len(text)]
            head, *rest = SPLIT.split(part) if ODD.search(part) else part.split(" ")
            out.append(words[head])
            out.extend(map(self.later.__getitem__, rest))
            at, words = (cut.end(), self.later) if cut else (len(text), words)
        return b"".join(out)


def pieces(docs: DataFrame, vocabulary: Vocabulary | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each document of (doc_id, text); text null: empty. Every document ends with
    one end id, so has a token. Only longer ones are cut, and only their first piece may be short."""
    vocabulary = vocabulary or Vocabulary()
    schema = extended(docs.select("doc_id").schema, "piece int, start long, length long, ids_crc32 long")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder()
        end = np.array([vocabulary.end], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column("text")):
                ids = encoder.ids(text.as_py() or "") + end
                n = len(ids) // 4
                at = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                rows += [(i, k, a, b - a, zlib.crc32(ids[4 * a:4 * b])) for k, (a, b) in enumerate(zip(at, at[1:], strict=False))]
            of, piece, start, length, crc = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(of)), pa.array(piece.astype(np.int32)), pa.array(start),
                                              pa.array(length), pa.array(crc)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The sequence of each length: the longest first, each into the fullest sequence that it fits."""
    bins = np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]       # sequences by room left
    mask, count = 0, 0                                              # bit r: a sequence has room r
    order = np.argsort(-lengths, kind="stable")
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = mask >> n
        if fits:
            room = n + ((fits & -fits).bit_length() - 1)
            b = free[room].pop()
            if not free[room]:
                mask ^= 1 << room
        else:
            room, b = capacity, count
            count += 1
        left = room - n
        if left:
            if not free[left]:
                mask |= 1 << left
            free[left].append(b)
        bins[i] = b
    return bins


def lower_bound(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """The best bound of two families of dual-feasible functions on the counts of lengths 0..capacity, in whole numbers.

    Threshold a: lengths over capacity - a count as a whole sequence, those under a as nothing, others as they are.
    Rounding k: (k+1)·x if that is a whole number of sequences as it is, else rounded down and divided by k.
    """
    x = np.arange(capacity + 1)
    n, total = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * x)])
    a = np.arange(capacity // 2 + 1)
    weight = capacity * (n[-1] - n[capacity - a + 1]) + np.maximum(0, total[capacity - a + 1] - total[a])
    best = int(-(-weight // capacity).max())
    for k in range(1, 33):
        scaled = (k + 1) * x
        exact = scaled % capacity == 0
        up = int((counts * x)[exact].sum()) * k + capacity * int((counts * (scaled // capacity))[~exact].sum())
        best = max(best, -(-up // (k * capacity)))
    return best


def pack(cut: DataFrame, scratch: Scratch, capacity: int = CAPACITY, target: int = TARGET, release: int = RELEASE, rounds: int = ROUNDS) -> DataFrame:
    """Each piece with sequence_id and offset. Needs a column length in 1..capacity; other columns are carried."""
    carried = cut.columns
    pool = scratch.keep(cut.withColumns({"_uid": F.monotonically_increasing_id(), "sequence_id": F.lit(-1).cast("long"), "offset": F.lit(-1).cast("long")}), "pieces")
    settled: list[DataFrame] = []
    for r in range(rounds + 1):
        tokens = pool.agg(F.sum("length")).first()[0] or 0
        groups = -(-tokens // target)
        together = "sequence_id" if r else "_uid"        # a sequence that was given up is dealt whole: it may have to stay
        dealt = pool.withColumn("_group", F.pmod(F.xxhash64(together, F.lit(r)), F.lit(max(groups, 1)))).select("_group", *pool.columns)
        schema = extended(dealt.drop("_group").schema, "_open boolean")
        packed = dealt.repartition("_group").sortWithinPartitions("_group", "_uid").mapInArrow(_packer(r, capacity, release, schema.names), schema)
        packed = scratch.keep(packed, f"round{r}")
        again = packed.where("_open").drop("_open")
        if r == rounds or groups <= 1:
            settled.append(packed)
            break
        settled.append(packed.where("not _open"))
        pool = again
    out = settled[0].select(*carried, "sequence_id", "offset")
    for more in settled[1:]:
        out = out.union(more.select(*carried, "sequence_id", "offset"))
    return out


def _packer(r: int, capacity: int, release: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["_group"]):
            lengths, group = numpy_of(part, "length"), int(part.column("_group")[0].as_py())
            old = numpy_of(part, "sequence_id")
            bins = best_fit_decreasing(lengths, capacity)
            bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
            before = np.unique(old)
            if r and len(before) <= bins.max() + 1:      # no gain: the sequences stay as they were
                bins, sequence, offset = np.searchsorted(before, old), old, numpy_of(part, "offset")
            else:
                sequence = (r << 58) | (group << 24) | bins
                order = np.argsort(bins, kind="stable")
                ends = np.cumsum(lengths[order])
                first = np.flatnonzero(np.diff(bins[order], prepend=-1))
                offset = np.empty(len(lengths), np.int64)
                offset[order] = ends - lengths[order] - np.repeat((ends - lengths[order])[first], np.diff(first, append=len(order)))
            count = int(bins.max()) + 1
            opened = np.zeros(count, bool)
            if count > bound:
                fill = np.bincount(bins, weights=lengths, minlength=count)
                opened[nsmallest(release, range(count), key=fill.__getitem__)] = True
            done = {"sequence_id": pa.array(sequence), "offset": pa.array(offset), "_open": pa.array(opened[bins])}
            yield from pa.table({n: done.get(n, None) if n in done else part.column(n) for n in names}).to_batches(max_chunksize=50_000)
    return run


def sequences_bound(placed: DataFrame, capacity: int = CAPACITY) -> int:
    """The lower bound on the sequences of all pieces together, from their counts by length (at most `capacity` rows)."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in placed.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    return lower_bound(counts, capacity)
