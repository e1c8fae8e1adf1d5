"""Language-model scores of documents by stupid backoff, from n-gram counts of the whole corpus.

Documents are dealt into chunks by a hash. A chunk's distinct n-grams of each order go, sorted and in arrays, to the partitions
of the count table, cut by the upper bits of the n-gram's hash; a partition adds up what all chunks bring and answers each
chunk with the counts of what it brought. Back in its chunk each n-gram of a document takes its count, and the scores are summed for each
document. So the join moves each n-gram of a chunk once, as six bytes, and its count back.

An n-gram is seen if it occurs LEAST times or more. Score of a word: its n-gram's count over that of the n-gram without it, if
seen, else BACKOFF times the score with one word less before it; a single word has its count over all words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, extended, numpy_of, runs
from .shingles import Hasher

ORDER = 3
LEAST = 2
BACKOFF = 0.4
CHUNK = 4_000_000       # bytes of text in a chunk, as a mean
SHARE = 4_000_000       # bytes of text in the corpus for each partition of the count table


def _grams(words: np.ndarray, row: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order, the hash of the n-gram that ends at each word, 0 where the text starts later."""
    out = [np.maximum(words, np.uint64(1))]
    for k in range(2, order + 1):
        g = np.zeros(len(words), np.uint64)
        if len(words) >= k:
            h = (out[-1][:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (words[1:] + np.uint64(k))
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            h = np.maximum(h ^ (h >> np.uint64(29)), np.uint64(1))
            g[k - 1:] = np.where(row[k - 1:] == row[:len(row) - k + 1], h[k - 2:], np.uint64(0))
        out.append(g)
    return out


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    hasher, parts = Hasher(1), []
    for i, _, h, row in hasher.texts(column):
        parts.append((h, row + i))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _packed(grams: np.ndarray) -> bytes:
    return grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, and how many that is."""
    width = next(w for w in (1, 2, 4, 8) if counts.max() < 1 << (8 * w) or w == 8)
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _ask(k: int, bits: int):
    """A chunk's distinct k-grams and how often it has each, by partition: the upper `bits` of the hash; the next 48 name it there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["chunk"]):
            chunk = int(table.column("chunk")[0].as_py())
            g = _grams(*_words(table.column("text").combine_chunks()), k)[-1]
            names, n = np.unique(g[g > 0] >> np.uint64(16 - bits), return_counts=True)
            part = (names >> np.uint64(48)).astype(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
            cuts = list(zip(starts.tolist(), [*starts[1:].tolist(), len(part)], strict=False))
            yield pa.RecordBatch.from_arrays([pa.array(part[starts].astype(np.int32)), pa.array([chunk] * len(starts), pa.int32()),
                                              pa.array([_packed(names[a:b]) for a, b in cuts], pa.binary()), pa.array([_narrow(n[a:b]) for a, b in cuts], pa.binary())],
                                             names=["p", "chunk", "names", "n"])
    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in runs(batches, ["p"]):
        names = [_unpacked(x.as_py()) for x in table.column("names")]
        counts = np.concatenate([_wide(x.as_py()) for x in table.column("n")])
        known, at = np.unique(np.concatenate(names), return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(known)).astype(np.int64)
        bounds = np.cumsum([0, *map(len, names)])
        told = [_narrow(total[at[a:b]]) for a, b in zip(bounds, bounds[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([table.column("chunk").combine_chunks(), table.column("p").combine_chunks(), pa.array(told, pa.binary()),
                                          pa.array([int(total.sum())] * len(told), pa.int64())], names=["chunk", "p", "counts", "all"])


def _score(order: int, bits: int, least: int, backoff: float, everything: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["chunk"]):
            told = numpy_of(table, "k")
            texts = table.filter(pa.array(told == 0))
            if not texts.num_rows:
                continue
            words, row = _words(texts.column("text").combine_chunks())
            counts = []
            for k, g in enumerate(_grams(words, row, order), 1):
                answers = table.filter(pa.array(told == k))
                by = np.argsort(numpy_of(answers, "p"), kind="stable")
                column = answers.column("counts")
                values = np.concatenate([np.zeros(0, np.int64), *(_wide(column[int(i)].as_py()) for i in by)])
                _, at = np.unique(g[g > 0] >> np.uint64(16 - bits), return_inverse=True)
                c = np.zeros(len(g), np.int64)
                c[g > 0] = values[at]
                counts.append(c)
            score = np.log(np.maximum(counts[0], 1) / max(everything, 1))
            for k in range(1, order):
                before = np.concatenate([[1], counts[k - 1][:-1]])
                with np.errstate(divide="ignore"):
                    score = np.where(counts[k] >= least, np.log(counts[k] / np.maximum(before, 1)), math.log(backoff) + score)
            n = np.bincount(row, minlength=texts.num_rows)
            total = np.bincount(row, weights=score, minlength=texts.num_rows)
            mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays([texts.column("doc_id").combine_chunks(), pa.array(n.astype(np.int64)), pa.array(total), mean], names=["doc_id", "n_words", "log_score", "mean_score"])
    return run


def score(docs: DataFrame, scratch: Scratch, order: int = ORDER, least: int = LEAST, backoff: float = BACKOFF, chunk: int = CHUNK, share: int = SHARE) -> DataFrame:
    """(doc_id, n_words, log_score, mean_score) of each row of (doc_id, text): the sum over its words of the natural log of their scores,
    and that divided by the words. Text null or without words: 0 words, sum 0, mean null. Equal rows count as often as they occur.
    """
    text = F.coalesce("text", F.lit(""))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, bits = -(-size // chunk) or 1, max(0, math.ceil(math.log2(max(size / share, 1))))
    if bits > 16:
        raise ValueError("raise `share`: the count table has at most 65,536 partitions")
    rows = docs.select(F.pmod(F.xxhash64("doc_id", text), F.lit(chunks)).cast("int").alias("chunk"), "doc_id", text.alias("text"))
    answers = None
    for k in range(1, order + 1):       # one order at a time: what it shuffled is gone before the next
        asked = rows.select("chunk", "text").repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_ask(k, bits), "p int, chunk int, names binary, n binary")
        told = asked.repartition("p").sortWithinPartitions("p").mapInArrow(_answer, "chunk int, p int, counts binary, all long")
        told = scratch.keep(told, f"answers{k}").withColumn("k", F.lit(k))
        del asked
        scratch.release()
        answers = told if answers is None else answers.union(told)
    everything = answers.where("k = 1").groupBy("p").agg(F.max("all").alias("all")).agg(F.sum("all")).first()[0] or 0
    none = lambda kind: F.lit(None).cast(kind)
    kind = dict(docs.select("doc_id").dtypes)["doc_id"]
    met = rows.select("chunk", F.lit(0).alias("k"), F.lit(0).alias("p"), none("binary").alias("counts"), "doc_id", "text").union(
        answers.select("chunk", "k", "p", "counts", none(kind).alias("doc_id"), none("string").alias("text")))
    schema = extended(docs.select("doc_id").schema, "n_words long, log_score double, mean_score double")
    return met.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_score(order, bits, least, backoff, everything), schema)
