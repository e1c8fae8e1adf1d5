"""Word shingles of texts, hashed in whole batches, and how frequent the common ones are in the corpus.

A word is a run of characters other than ASCII punctuation and white space, ASCII letters in lower case. A shingle is `size`
words in a row; a text with fewer words is one shingle; a text without words has none. Shingles are named by 48 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bytes_of

SIZE = 5
CHUNK = 1 << 19         # bytes hashed at a time, or one text in such parts
COUNTED = 2_000_000     # shingles a task counts at a time
COMMON = 64             # a shingle in more than one of so many documents has a frequency of its own
SEED = 13


class Hasher:
    def __init__(self, size: int = SIZE):
        rng = np.random.default_rng(SEED)
        self.size = size
        base = int(rng.integers(1 << 62)) * 2 + 1
        n = CHUNK + 1
        self.powers = np.cumprod(np.full(n, base, np.uint64))
        self.inverse = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))
        values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        gap = np.zeros(256, bool)
        gap[[*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]] = True
        values[65:91] = values[97:123]
        self.values, self.gap = values, gap
        self.mix = [np.uint64(int(x) | 1) for x in rng.integers(1 << 62, 1 << 63, size + 2)]

    def words(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and start of each word of at most CHUNK bytes."""
        edge = np.diff(self.gap[flat].astype(np.int8), prepend=1, append=1)
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(self.values[flat] * self.powers[:len(flat)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * self.inverse[starts]
        h ^= h >> np.uint64(31)
        return h * self.mix[0], starts

    def texts(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, word hashes, row of each from the first) of some texts at a time."""
        flat, at = bytes_of(column)
        spaced = at + np.arange(len(at))        # with one gap between texts
        i = 0
        while i < len(column):
            j = max(i + 1, min(i + 65_536, int(np.searchsorted(spaced, spaced[i] + CHUNK, "right")) - 1))
            if at[j] - at[i] <= CHUNK:
                h, starts = self.words_between(flat[at[i]:at[j]], at[i + 1:j] - at[i])
                yield i, j, h, np.searchsorted(at[i + 1:j + 1] - at[i], starts, "right")
            else:
                parts, a = [], int(at[i])
                while a < at[j]:
                    b = min(a + CHUNK, int(at[j]))
                    if b < at[j]:       # a cut stands after the last gap; a word of CHUNK bytes is cut like any run
                        gaps = np.flatnonzero(self.gap[flat[a:b]])
                        b = a + int(gaps[-1]) + 1 if len(gaps) else b
                    parts.append(self.words(flat[a:b])[0])
                    a = b
                h = np.concatenate(parts)
                yield i, j, h, np.zeros(len(h), np.int64)
            i = j

    def words_between(self, flat: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of several texts: a gap is put in at each cut, and taken out of the starts again."""
        if not len(cuts):
            return self.words(flat)
        h, starts = self.words(np.insert(flat, cuts, 32))
        return h, starts - np.searchsorted(cuts + np.arange(1, len(cuts) + 1), starts, "right")

    def shingles(self, words: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Row in the upper 16 bits, shingle in the lower 48, sorted; repeated as often as it occurs. At most 65,536 rows."""
        counts = np.bincount(row, minlength=rows)
        ends = np.cumsum(counts)
        found = []
        for k in range(1, self.size + 1):
            if len(words) < k:
                break
            if k == self.size:
                first = np.flatnonzero(row[:len(row) - k + 1] == row[k - 1:])
            else:
                first = (ends - counts)[counts == k]
            if not len(first):
                continue
            h = np.full(len(first), k, np.uint64)
            for d in range(k):
                h = (h ^ words[first + d]) * self.mix[d + 1]
                h ^= h >> np.uint64(29)
            found.append((row[first].astype(np.uint64) << np.uint64(48)) | (h * self.mix[-1] >> np.uint64(16)))
        out = np.concatenate(found) if found else np.zeros(0, np.uint64)
        out.sort()
        return out

    def batch(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, end row, row from the first, shingle, times it occurs), by row and shingle."""
        for i, j, words, row in self.texts(column):
            key = self.shingles(words, row, j - i)
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            times = np.diff(first, append=len(key))
            key = key[first]
            yield i, j, (key >> np.uint64(48)).astype(np.int64), (key & np.uint64((1 << 48) - 1)).astype(np.int64), times


def _summary(size: int, common: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, docs = Hasher(size), [], 0

        def told() -> pa.RecordBatch:
            s, n = np.unique(np.concatenate(held), return_counts=True)
            less = docs // (2 * common)
            return pa.RecordBatch.from_arrays([pa.array(s[n > less]), pa.array((n - less)[n > less])], names=["s", "n"])

        for batch in batches:
            for i, j, _, s, _ in hasher.batch(batch.column("text")):
                held.append(s)
                docs += j - i
                if sum(map(len, held)) > COUNTED:
                    yield told()
                    held, docs = [], 0
        if held:
            yield told()
    return run


def common_shingles(texts: DataFrame, n: int, size: int = SIZE, common: int = COMMON) -> dict[int, int]:
    """Exact document counts of the shingles in more than n/common of the n texts, of which there are at most `common` times the mean
    shingles of a text, whatever n is.

    Each task first reports by how much a shingle exceeds 1/(2·common) of the documents it counted. A common shingle exceeds by
    n/(2·common) in sum, and what does so is in as many documents, so the candidates are bounded too; these are then counted.
    """
    over = texts.mapInArrow(_summary(size, common), "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    candidates = np.sort(np.array([r["s"] for r in over.where(F.col("n") >= n / (2 * common)).select("s").collect()], np.int64))
    if not len(candidates):
        return {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(size), np.zeros(len(candidates), np.int64)
        for batch in batches:
            for _, _, _, s, _ in hasher.batch(batch.column("text")):
                at = np.minimum(np.searchsorted(candidates, s), len(candidates) - 1)
                total += np.bincount(at[candidates[at] == s], minlength=len(candidates))
        yield pa.RecordBatch.from_arrays([pa.array(candidates[total > 0]), pa.array(total[total > 0])], names=["s", "n"])

    exact = texts.mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") > n / common)
    return {r["s"]: r["n"] for r in exact.collect()}


class Weights:
    """Inverse document frequency, ln(1 + n / df), with df no less than n/common."""

    def __init__(self, counts: dict[int, int], n: int, common: int = COMMON):
        self.names = np.array(sorted(counts), np.int64)
        self.idf = np.log1p(n / np.array([max(counts[s], n / common) for s in self.names.tolist()], float))
        self.rare = float(np.log1p(common))

    def of(self, shingles: np.ndarray, times: np.ndarray) -> np.ndarray:
        w = np.full(len(shingles), self.rare)
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, shingles), len(self.names) - 1)
            hit = self.names[at] == shingles
            w[hit] = self.idf[at[hit]]
        return w * times
