"""Runs of words that repeat with a short period, by recompression.

A grammar is built over the words of many documents at once: in turn, blocks of equal symbols become one symbol with its
length, and neighbouring symbols of two classes become pairs, until little is left. Equal stretches are parsed alike but for
their ends, so a question how far two places agree climbs to the greatest common symbols and comes down again, in a number
of steps that follows the height of the grammar. No suffix array is built.

Candidates lie on a harmonic grid: a run of period q and at least 4q words holds four grid points 0, q, 2q, ... in a row with
equal words. Where the grid has such a place, the grammar tells how far the two stretches q apart agree before and behind it,
which is the whole run. Runs found for a multiple of their period are the same stretch, so the smallest period stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import extended

LEAST_LENGTH = 6        # words of a run, and
LEAST_TIMES = 4         # periods
PART = 400_000          # words (and about four grammar symbols each) worked on at a time; a longer text alone
GRID = 2_000_000        # grid points looked at at a time
WORD = r"[^\x20\x09-\x0D]+"


@dataclass
class Grammar:
    """All levels one after another. Symbols of a level: `sym`; the place of each symbol's first and last part on the level below
    (`first_down`, `last_down`, -1 on words); of its whole on the level above (`up`, -1 at the top), whether it is the first or last part
    of that, and how many parts of its block lie from it to the right and to the left, itself included."""
    sym: np.ndarray
    up: np.ndarray
    first: np.ndarray
    last: np.ndarray
    first_down: np.ndarray
    last_down: np.ndarray
    right: np.ndarray
    left: np.ndarray


def _halves(symbols: np.ndarray, level: int) -> np.ndarray:
    """One of two classes for each symbol, by a hash: alike wherever the symbol stands."""
    x = (symbols.astype(np.uint64) + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x >> np.uint64(63) == 1


def _named(a: np.ndarray, b: np.ndarray, start: int) -> tuple[np.ndarray, int]:
    """New symbols, from `start` on, one for each distinct (a, b)."""
    order = np.lexsort((b, a))
    sa, sb = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])
    out = np.empty(len(a), np.int64)
    out[order] = start + np.cumsum(new) - 1
    return out, start + int(new.sum())


def grammar(words: np.ndarray) -> Grammar:
    """The grammar of a row of symbols; its first and last symbol stand nowhere else."""
    parts: dict[str, list[np.ndarray]] = {k: [] for k in Grammar.__dataclass_fields__}
    sym, free, base, level, idle = words.astype(np.int64), int(words.max(initial=0)) + 1, 0, 0, 0
    down = (np.full(len(sym), -1), np.full(len(sym), -1))
    while True:
        n = len(sym)
        heads = np.ones(n, bool)        # first parts of wholes
        if level % 2 == 0:
            heads[1:] = sym[1:] != sym[:-1]
        else:
            side = _halves(sym, level)
            one, two = ~side[:-1] & side[1:], side[:-1] & ~side[1:]
            heads[1:] = ~(one if one.sum() >= two.sum() else two)
        at = np.flatnonzero(heads)
        size = np.diff(np.append(at, n))
        whole = np.repeat(np.arange(len(at)), size)
        within = np.arange(n) - at[whole]
        idle = idle + 1 if len(at) == n else 0
        top = n == 1 or idle == 12
        parts["sym"].append(sym)
        parts["first_down"].append(down[0])
        parts["last_down"].append(down[1])
        parts["up"].append(np.full(n, -1) if top else base + n + whole)
        parts["first"].append(within == 0)
        parts["last"].append(within == size[whole] - 1)
        block = level % 2 == 0
        parts["right"].append(size[whole] - within if block else np.ones(n, np.int64))
        parts["left"].append(within + 1 if block else np.ones(n, np.int64))
        if top:
            return Grammar(**{k: np.concatenate(v) for k, v in parts.items()})
        next_sym = sym[at].copy()
        many = np.flatnonzero(size > 1)
        if len(many):
            next_sym[many], free = _named(sym[at[many]], size[many] if block else sym[at[many] + 1], free)
        down = (base + at, base + at + size - 1)
        sym, base, level = next_sym, base + n, level + 1


def agreement(g: Grammar, one: np.ndarray, two: np.ndarray, forward: bool) -> np.ndarray:
    """How many words agree from the places `one` and `two` on, forward or backward, both themselves included; all at once."""
    end, down, rest, sign = (g.first, g.first_down, g.right, 1) if forward else (g.last, g.last_down, g.left, -1)
    out = np.empty(len(one), np.int64)
    k, e1, e2 = np.arange(len(one)), one.copy(), two.copy()
    while len(k):
        same = g.sym[e1] == g.sym[e2]
        u1, u2 = g.up[e1], g.up[e2]
        climb = same & (u1 >= 0) & end[e1] & end[e2] & (g.sym[u1] == g.sym[u2])
        step = same & ~climb
        t = np.where(step, np.minimum(rest[e1], rest[e2]) * sign, 0)
        fall = ~same
        done = fall & (down[e1] < 0)
        out[k[done]] = (e1[done] - one[k[done]]) * sign
        e1, e2 = np.where(climb, u1, np.where(fall, down[e1], e1 + t)), np.where(climb, u2, np.where(fall, down[e2], e2 + t))
        if done.any():
            k, e1, e2 = k[~done], e1[~done], e2[~done]
    return out


def grid(words: np.ndarray, start: np.ndarray, n: np.ndarray, times: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, q, place, end): grid stretches of all documents and periods whose words are equal at `times` grid points at least:
    the place of the first and of the last but one of them (an equal word stands q behind each of the places)."""
    most = n // times
    of = np.repeat(np.arange(len(n)), most)                             # one row a document and period
    q = np.arange(len(of)) - np.repeat(np.cumsum(most) - most, most) + 1
    points = (n[of] - 1) // q                                           # places 0, q, ... that have one behind them
    bounds = np.cumsum(points)
    a = 0
    while a < len(of):
        before = bounds[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(bounds, before + GRID, "right")))
        size = points[a:b]
        row = np.repeat(np.arange(a, b), size)
        k = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        here = start[of[row]] + k * q[row]
        equal = np.append(words[here] == words[here + q[row]], False)
        first = np.append(True, row[1:] != row[:-1])
        begins = equal[:-1] & (first | ~np.append(False, equal[:-2]))
        ends = equal[:-1] & np.append(first[1:] | ~equal[1:-1], True)
        i, j = np.flatnonzero(begins), np.flatnonzero(ends)
        long = j - i + 1 >= times - 1
        i, j = i[long], j[long]
        yield of[row[i]], q[row[i]], here[i], here[j]
        a = b


def runs_of(words: np.ndarray, start: np.ndarray, n: np.ndarray, length: int = LEAST_LENGTH, times: int = LEAST_TIMES) -> tuple[np.ndarray, ...]:
    """(document, start, length, period) of all maximal runs of documents that lie in `words` from `start` on, by document, start and period.

    `words` has a symbol of its own before, between and behind the documents, so no run leaves one.
    """
    found = [np.concatenate(x) for x in zip(*grid(words, start, n, times), strict=True)] or [np.zeros(0, np.int64)] * 4
    d, q, at, until = found
    if not len(d):
        return d, d, d, d
    # The grammar is that of the documents with candidates.
    some = np.unique(d)
    size = n[some] + 1
    new = np.cumsum(size) - size + 1                    # where each of them starts behind a separator
    keep = np.repeat(start[some] - 1 - (new - 1), size) + np.arange(size.sum())
    g = grammar(np.append(words[keep], words.max() + 1))
    shift = np.zeros(len(n), np.int64)
    shift[some] = new - start[some]
    at, until = at + shift[d], until + shift[d]
    out = []
    while len(d):
        ahead = agreement(g, at, at + q, True)
        behind = agreement(g, at - 1, at - 1 + q, False)
        a, b = at - behind, at + q + ahead
        whole = b - a >= np.maximum(length, times * q)
        out.append((d[whole], a[whole] - shift[d[whole]] - start[d[whole]], (b - a)[whole], q[whole]))
        # A stretch of the grid may go on in another run: its next place behind the one at which this run ends.
        at = at + np.maximum(-(-(b - q + 1 - at) // q), 1) * q
        more = until - at >= (times - 2) * q
        d, q, at, until = d[more], q[more], at[more], until[more]
    d, a, size, q = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((q, size, a, d))
    d, a, size, q = d[order], a[order], size[order], q[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (a[1:] != a[:-1]) | (size[1:] != size[:-1])
    d, a, size, q = d[new], a[new], size[new], q[new]
    order = np.lexsort((q, a, d))
    return d[order], a[order], size[order], q[order]


def find_runs(docs: DataFrame, keep: list[str], length: int = LEAST_LENGTH, times: int = LEAST_TIMES, text: str = "text") -> DataFrame:
    """The columns `keep` of each row, with `n_words`, `runs` (array of start, length and period, by start and period; start in words from 0) and
    `collapsed`: the words, joined by one space, that no run contains after its first period.

    A run is a stretch of words with smallest period q, of at least `length` words and `times` q, that no neighbouring word continues.
    Text null, empty or of white space only: no words, no runs, an empty text. Repeated rows are answered each. Texts are worked on
    whole; a task holds about PART words at a time, or one longer text. An empty table gives an empty one.
    """
    schema = extended(docs.select(*keep).schema, "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    row = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def answered(batch: pa.RecordBatch, at: int, texts: list[list[bytes]]) -> pa.RecordBatch:
        names: dict[bytes, int] = {}
        n = np.array([len(w) for w in texts], np.int64)
        start = np.cumsum(n + 1) - n
        flat = np.empty(int(n.sum()) + len(n) + 1, np.int64)
        for words, a, k in zip(texts, start, n, strict=True):
            flat[a:a + k] = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, k)
        flat[np.append(start - 1, len(flat) - 1)] = len(names) + np.arange(len(n) + 1)
        of, first, size, period = runs_of(flat, start, n, length, times)
        bounds = np.searchsorted(of, np.arange(len(n) + 1))
        runs, kept = [], []
        for k, words in enumerate(texts):
            found = [(int(first[r]), int(size[r]), int(period[r])) for r in range(bounds[k], bounds[k + 1])]
            runs.append([{"start": a, "length": s, "period": q} for a, s, q in found])
            if found:
                gone = np.zeros(len(words) + 1, np.int64)
                for a, s, q in found:
                    gone[a + q] += 1
                    gone[a + s] -= 1
                words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
            kept.append(b" ".join(words).decode())
        rest = [batch.column(i).slice(at, len(texts)) for i in range(batch.num_columns - 1)]
        return pa.RecordBatch.from_arrays([*rest, pa.array(n), pa.array(runs, row), pa.array(kept, pa.string())], names=schema.names)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, at, n = [], 0, 0
            for k, cell in enumerate(batch.column(batch.num_columns - 1)):
                held.append((cell.as_py() or "").encode().split())
                n += len(held[-1])
                if n >= PART:
                    yield answered(batch, at, held)
                    held, at, n = [], k + 1, 0
            if held or not batch.num_rows:
                yield answered(batch, at, held)

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(tag, schema)


def made_periodic(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which the text of one document in ten (by the crc32 of its id) repeats its words from some word on; other texts
    are as they are. A null id has no crc32, so its text stays."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    w, n = F.col("w"), F.size("w")
    a = F.col("g") % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))
    period = F.slice(w, (a + 1).cast("int"), p.cast("int"))
    again = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    made = F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), again), " ")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w"), F.floor(h / 10).alias("g"))
    return chosen.select("doc_id", F.when(n > 0, made).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame, keep: list[str]) -> DataFrame:
    """One row per document: how many runs, the one of greatest length (ties: smallest start, then period) and digests of the runs and of what is kept."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = found.select(*keep, "n_words", "collapsed", F.size("runs").cast("long").alias("n_runs"), longest.alias("m"), lines.alias("lines"))
    period = -F.col("m.p")
    return out.select(*keep, "n_runs", (-F.col("m.s")).alias("start"), F.col("m.length").alias("length"), period.alias("period"),
                      F.expr("1000 * m.length div -m.p").alias("exponent_milli"), F.sha2("lines", 256).alias("runs_sha256"),
                      F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
