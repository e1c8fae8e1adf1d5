"""Exact repeats of at least LENGTH bytes, by enhanced suffix arrays over content-chosen positions.

Suffixes are not sorted at every byte but at anchors: in each window of LENGTH bytes the GRAM-byte string with the least hash,
the first of equals. The choice depends on the window's bytes alone, so a string of LENGTH bytes that occurs twice has the same
anchor at both places. Suffixes whose anchor's string occurs once repeat nothing. The others meet by that string. What any
window with the anchor can reach is the anchor's clip; anchors with equal clips are one kind, repeated as far as they reach.
The suffix array of the kinds of a group, with common prefixes, is scanned with a stack into its tree of intervals; the
members of each interval are scanned in the same way by what precedes them, which tells the left extensions apart. What is
diverse on both sides is a maximal repeat within that reach, with all its occurrences; longer repeats run on from anchor to
anchor. Bytes are fetched only for one anchor of each kind, of groups in which a kind occurs once.

A group of more than CROWD kinds is not held by one task. Its strings are put in order over ranges, and one pass tells the depths at which
each parts from others. Who shares a window of LENGTH bytes that ends there stands in one stretch of that order, so a range settles its own
stretches; of those that run on over its ends, each distinct window is one row, counted by digest over the ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import ensure_checkpoint_dir
from .common import Scratch, bytes_of, extended, groups, numpy_of

LENGTH = 200
GRAM = 100
CROWD = 1000
CHUNK = 1 << 20         # bytes hashed at a time
POSITION = (1 << 28) - 1
SEED = 11


class Anchors:
    """Positions and hashes of the anchors in a run of documents."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        rng = np.random.default_rng(SEED)
        self.length, self.gram, self.window = length, gram, length - gram + 1
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        size = CHUNK + 4 * length
        base = int(rng.integers(1 << 62)) * 2 + 1
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.full(size, base, np.uint64))          # from the first power on, which serves as well
            self.inverse = np.cumprod(np.full(size, pow(base, -1, 1 << 64), np.uint64))

    def of(self, flat: np.ndarray, ends: np.ndarray, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions, hashes and clip hashes of the anchors that windows starting in first..last choose; ends: of the documents in flat."""
        n, k, w = len(flat), self.gram, self.window
        if n < self.length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[flat] * self.powers[:n], out=sums[1:])
        h = mixed((sums[k:] - sums[:-k]) * self.inverse[:n - k + 1])
        m = len(h)
        key = np.full(-(-m // w) * w, np.iinfo(np.uint64).max, np.uint64)
        key[:m] = (h & ~np.uint64(POSITION)) | np.arange(m, dtype=np.uint64)
        rows = key.reshape(-1, w)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - self.length + 1
        best = np.minimum(behind[:windows], ahead[w - 1:w - 1 + windows])
        starts = np.concatenate([[0], ends[:-1]])
        inside = np.zeros(windows + 1, np.int64)                  # windows that lie in one document
        fits = ends - starts >= self.length
        np.add.at(inside, starts[fits], 1)
        np.add.at(inside, ends[fits] - self.length + 1, -1)
        whole = np.cumsum(inside[:-1]) > 0
        whole[:first] = False
        if last is not None:
            whole[last:] = False
        at = (best[whole] & np.uint64(POSITION)).astype(np.int64)
        at = at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at
        doc = np.searchsorted(ends, at, "right")
        a, b = np.maximum(starts[doc], at - (w - 1)), np.minimum(ends[doc], at + self.length)
        clip = mixed((sums[b] - sums[a]) * self.inverse[a] + (at - a).astype(np.uint64) * self.values[1] + (b - a).astype(np.uint64) * self.values[2])
        return at, h[at], clip


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Anchors(length, gram)
        for batch in batches:
            flat, at = bytes_of(batch.column("text"))
            i = 0
            while i < batch.num_rows:
                j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK, "right")) - 1)
                begin, size = int(at[i]), int(at[j] - at[i])
                if size <= CHUNK:
                    p, h, c = find.of(flat[begin:begin + size], at[i + 1:j + 1] - begin)
                else:                                             # a long text, by windows in parts, each with what clips can reach
                    found = []
                    for a in range(0, size - length + 1, CHUNK):
                        low, high = max(0, a - length), min(size, a + CHUNK + 2 * length)
                        q, *rest = find.of(flat[begin + low:begin + high], np.array([high - low]), a - low, a - low + CHUNK)
                        found.append((q + low, *rest))
                    p, h, c = (np.concatenate(x) for x in zip(*found, strict=True))
                doc = np.searchsorted(at[i + 1:j + 1] - begin, p, "right")
                p = p - (at[i:j] - begin)[doc]
                new = np.concatenate([[True], (p[1:] != p[:-1]) | (doc[1:] != doc[:-1])]) if len(p) else np.zeros(0, bool)
                rows = pa.array(doc[new] + i)
                yield pa.RecordBatch.from_arrays([batch.column("x1").take(rows), batch.column("x2").take(rows), pa.array(p[new].astype(np.int32)),
                                                  pa.array(h[new].view(np.int64)), pa.array(c[new].view(np.int64))], names=["x1", "x2", "pos", "h", "c"])
                i = j
    return run


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "little") ^ int.from_bytes(b[:n], "little")
    return ((x & -x).bit_length() - 1) // 8 if x else n


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of each interval of a suffix array whose neighbours share lcp[1:], deeper ones first."""
    stack = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        now, first = (lcp[i] if i < len(lcp) else -1), i - 1
        while stack and stack[-1][0] > now:
            depth, first = stack.pop()
            yield depth, first, i - 1
        if now >= 0 and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def maximal(lefts: list[bytes], rights: list[bytes], length: int) -> Iterator[tuple[list[int], int, int]]:
    """(places, left, right) of each maximal repeat of at least `length` bytes across the anchor: lefts are read backwards."""
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = [0, *(shared(rights[a], rights[b]) for a, b in zip(order, order[1:], strict=False))]
    rank = {p: r for r, p in enumerate(order)}
    reach = max(map(len, lefts))
    for right, lo, hi in intervals(lcp):
        if lo == hi or right + reach < length:
            continue
        inner = sorted(order[lo:hi + 1], key=lefts.__getitem__)
        back = [0, *(shared(lefts[a], lefts[b]) for a, b in zip(inner, inner[1:], strict=False))]
        for left, a, b in intervals(back):
            if a == b or left + right < length:
                continue
            places = inner[a:b + 1]
            ranks = sorted(rank[p] for p in places)
            if min(lcp[ranks[0] + 1:ranks[-1] + 1]) == right:       # else a deeper interval has them all
                yield places, left, right


def _scan(length: int, listing: int = 0):
    """Of the kinds of each group that occur once: how far they are repeated to both sides.

    Listing (then the bytes of an anchor's string): every maximal repeat, by kinds. The same bytes may stand where another string is the
    anchor; where a window inside the repeat chooses the anchor they cannot, so those repeats are listed, and with all places.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chooser = Anchors(length, listing) if listing else None
        for table, bounds in groups(batches, "h"):
            clips, left, times = table.column("clip").to_pylist(), numpy_of(table, "left").tolist(), numpy_of(table, "n")
            n = len(clips)
            back, ahead = np.zeros(n, np.int64), np.zeros(n, np.int64)
            out: list[tuple[int, int, int, int]] = []
            for a, b in zip(bounds.tolist(), [*bounds[1:].tolist(), n], strict=True):
                found = [([i], left[i], len(clips[i]) - left[i]) for i in range(a, b) if times[i] > 1 and len(clips[i]) >= length] if listing else []
                if b - a > 1:
                    tree = maximal([clips[i][:left[i]][::-1] for i in range(a, b)], [clips[i][left[i]:] for i in range(a, b)], length)
                    found += (([a + i for i in places], e, d) for places, e, d in tree)
                for r, (rows, e, d) in enumerate(found):
                    if chooser:
                        i = rows[0]
                        raw = np.frombuffer(clips[i][left[i] - e:left[i] + d], np.uint8)
                        if e not in chooser.of(raw, np.array([len(raw)]))[0]:
                            continue
                        out += [(i, r, e, d) for i in rows]
                    else:
                        back[rows] = np.maximum(back[rows], e)
                        ahead[rows] = np.maximum(ahead[rows], d)
            if listing:
                at, name, e, d = (np.array(c, np.int64) for c in zip(*out, strict=True)) if out else [np.zeros(0, np.int64)] * 4
                yield pa.RecordBatch.from_arrays([*(pa.array(numpy_of(table, c)[at]) for c in ("h", "c")), pa.array(name), pa.array(e), pa.array(d)],
                                                 names=["h", "c", "repeat", "back", "ahead"])
            else:
                at = np.flatnonzero((ahead > 0) & (times == 1))
                pos = numpy_of(table, "pos")[at].astype(np.int64)
                yield pa.RecordBatch.from_arrays([*(pa.array(numpy_of(table, c)[at]) for c in ("x1", "x2")), pa.array(pos - back[at]), pa.array(pos + ahead[at])],
                                                 names=["x1", "x2", "a", "b"])
    return run


def keyed(docs: DataFrame) -> DataFrame:
    """(x1, x2, doc_id, text): rows that are equal in both share a key, which is right, as each repeats the other."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64("doc_id", text).alias("x1"), F.hash(text, "doc_id").alias("x2"), "doc_id", text.alias("text"))


def anchors(docs: DataFrame, scratch: Scratch, length: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """The anchors (x1, x2, pos, h, c) whose string occurs more than once, and their kinds (h, c, n, one anchor of each)."""
    found = scratch.keep(keyed(docs).select("x1", "x2", "text").mapInArrow(_anchors(length, gram), "x1 long, x2 int, pos int, h long, c long"), "anchors")
    # Written first, so that the join has shuffles of its own and a string that is everywhere can be split.
    often = scratch.keep(found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "strings")
    mine = scratch.keep(found.join(often, "h").select("x1", "x2", "pos", "h", "c"), "often")
    scratch.drop("anchors")
    return mine, scratch.keep(mine.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("x1", "x2", "pos")).alias("one")).select("h", "c", "n", "one.*"), "kinds")


def clipped(docs: DataFrame, kinds: DataFrame, length: int, gram: int) -> DataFrame:
    """The rows of kinds with left, the bytes before the anchor, and clip, the bytes in its reach."""
    asked = kinds.groupBy("x1", "x2").agg(F.collect_list(F.struct(*[c for c in kinds.columns if c not in ("x1", "x2")])).alias("at"))     # bounded by the text
    joined = keyed(docs).drop("doc_id").join(asked.hint("merge"), ["x1", "x2"]).dropDuplicates(["x1", "x2"]).select("x1", "x2", "text", "at")
    fields = [c for c in kinds.columns if c not in ("x1", "x2")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, at = bytes_of(batch.column("text"))
            lists = batch.column("at")
            counts = np.diff(lists.offsets.to_numpy())
            rows = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), counts)
            pos = rows.field("pos").to_numpy(zero_copy_only=False).astype(np.int64)
            left = np.minimum(pos, length - gram)
            low, high = at[row] + pos - left, np.minimum(at[row + 1], at[row] + pos + length)
            clips = [flat[a:b].tobytes() for a, b in zip(low.tolist(), high.tolist(), strict=True)]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("x1").take(take), batch.column("x2").take(take), *(rows.field(f) for f in fields),
                                              pa.array(left.astype(np.int32)), pa.array(clips, pa.binary())], names=schema.names)

    schema = extended(kinds.select("x1", "x2", *fields).schema, "left int, clip binary")
    return joined.mapInArrow(run, schema)


def neighbours(strings: pa.Array) -> np.ndarray:
    """Length of the prefix that each string shares with the one before it; the first shares nothing."""
    flat, at = bytes_of(strings)
    size, out = np.diff(at), np.zeros(len(strings), np.int64)
    for i in range(1, len(out), 8192):
        rows = np.arange(i, min(i + 8192, len(out)))
        most = np.minimum(size[rows], size[rows - 1])
        steps = np.arange(most.max())
        byte = lambda r: flat[np.minimum(at[r][:, None] + steps, max(len(flat) - 1, 0))]  # noqa: B023, E731
        differ = np.column_stack([byte(rows) != byte(rows - 1), np.ones(len(rows), bool)])
        out[rows] = np.minimum(differ.argmax(axis=1), most)
    return out


def parted(bits: int, depth: int) -> int:
    """The depths at which a string parts from those before it, as bits, after a step to a string that shares `depth` bytes."""
    return bits & ((1 << depth) - 1) | 1 << depth


def _partings(table: pa.Table, before: int, after: int) -> tuple[list[int], np.ndarray]:
    """The depths at which each string of a partition in order parts from others of its group, and the prefixes shared by neighbours (-1
    where a group begins). `before` and `after` are those of the first and last string with what other partitions hold."""
    n, near = table.num_rows, neighbours(table.column("s").combine_chunks())
    begins = np.ones(n, bool)
    begins[1:] = (numpy_of(table, "h")[1:] != numpy_of(table, "h")[:-1]) | (numpy_of(table, "side")[1:] != numpy_of(table, "side")[:-1])
    steps, new = near.tolist(), begins.tolist()
    ahead, behind = [before] * n, [after] * n
    for i in range(1, n):
        ahead[i] = 0 if new[i] else parted(ahead[i - 1], steps[i])
    for i in range(n - 2, -1, -1):
        behind[i] = 0 if new[i + 1] else parted(behind[i + 1], steps[i + 1])
    return [ahead, behind], np.where(begins, -1, near)[1:]


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a partition: its first and last string, the least prefix neighbours share, and the depths its own strings give both."""
    held = [b for b in batches if b.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        (ahead, behind), near = _partings(table, 0, 0)
        end = [{c: table.column(c)[i].as_py() for c in ("side", "h", "s")} for i in (0, table.num_rows - 1)]
        yield pa.RecordBatch.from_pylist([{"part": table.column("_part")[0].as_py(), "first": end[0], "last": end[1], "low": max(0, int(near.min(initial=1 << 20))),
                                           "ahead": str(ahead[-1]), "behind": str(behind[0])}], schema=EDGES)


EDGE = pa.struct([("side", pa.int32()), ("h", pa.int64()), ("s", pa.binary())])
EDGES = pa.schema([("part", pa.int32()), ("first", EDGE), ("last", EDGE), ("low", pa.int32()), ("ahead", pa.string()), ("behind", pa.string())])


def _carried(edges: list, near: str, far: str, own: str) -> dict[int, int]:
    """The depths that the partitions passed so far give the nearest string of each."""
    found, bits, last = {}, 0, None
    for r in edges:
        met = last is not None and (last["side"], last["h"]) == (r[near]["side"], r[near]["h"])
        found[r["part"]] = parted(bits, shared(bytes(last["s"]), bytes(r[near]["s"]))) if met else 0
        bits, last = int(r[own]) | found[r["part"]] & ((1 << r["low"]) - 1), r[far]
    return found


def _settled(length: int, before: dict[int, int], after: dict[int, int]):
    """Of each kind and side of a range in order: its farthest window that another of the range has too; and each distinct window of the
    stretches that run on in other ranges, with how often it occurs (2: more than once) and, if one kind alone has it here and none farther, that kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        part = table.column("_part")[0].as_py()
        (ahead, behind), near = _partings(table, before[part], after[part])
        front, rear = before[part].bit_length() - 1, after[part].bit_length() - 1        # what the ends share with the next strings outside
        clips = table.column("clip").combine_chunks()
        flat, at = bytes_of(clips)
        view, begin, size = memoryview(flat), at.tolist(), np.diff(at).tolist()
        side, left, times = (numpy_of(table, c).tolist() for c in ("side", "left", "n"))
        parting: dict[int, list[int]] = {}
        start = lambda i, d: left[i] - (d if side[i] else length - d)
        for i, bits in enumerate(map(int.__or__, ahead, behind)):
            while bits:
                d = bits.bit_length() - 1
                bits ^= 1 << d
                if 0 <= start(i, d) <= size[i] - length:
                    parting.setdefault(d, []).append(i)
        far, found = [-1] * len(side), []          # found: row, depth, occurrences, whether the row's kind asks
        for d in sorted(parting, reverse=True):
            stretch = np.concatenate([[0], np.cumsum(near < d)])
            open_ends = ({0} if front >= d else set()) | ({int(stretch[-1])} if rear >= d else set())
            for k, rows in groupby(zip(stretch[parting[d]].tolist(), parting[d], strict=True), key=itemgetter(0)):
                met: dict[bytes, list[int]] = {}
                for _, i in rows:
                    o = begin[i] + start(i, d)
                    met.setdefault(bytes(view[o:o + length]), []).append(i)
                for who in met.values():
                    often = len(who) > 1 or times[who[0]] > 1
                    if k in open_ends:
                        found.append((who[0], d, 2 if often else 1, not often and far[who[0]] < 0))
                    if often:
                        for i in who:
                            far[i] = max(far[i], d)
        found += [(i, d, 0, True) for i, d in enumerate(far) if d >= 0 and times[i] == 1]
        for a in range(0, len(found), 4096):
            rows, depths, n, asks = (list(c) for c in zip(*found[a:a + 4096], strict=True))
            o = [start(i, d) for i, d in zip(rows, depths, strict=True)]
            window = [bytes(view[begin[i] + p:begin[i] + p + length]) if m else None for i, p, m in zip(rows, o, n, strict=True)]
            c = pa.array(numpy_of(table, "c")[rows], mask=~np.array(asks))
            yield pa.RecordBatch.from_arrays([*(pa.array(numpy_of(table, f)[rows]) for f in ("side", "h")), c, pa.array(n, pa.int64()), pa.array(o, pa.int32()),
                                              pa.array(np.array(o, np.int32) - numpy_of(table, "left")[rows]), pa.array(window, pa.binary())], names=WINDOWS)
    return run


WINDOWS = ["side", "h", "c", "n", "o", "place", "window"]


def crowded_windows(rows: DataFrame, length: int) -> DataFrame:
    """(side, h, c, n, o, place, w1, w2): the windows, by their start in a kind's clip, that are the first or the last that it shares with
    another kind (n = 0), and those, by digest, of which only other ranges of the order can tell (n of them; c null: for these alone).

    The first window that kinds i and j share ends where what follows their anchors parts, the last one starts where what precedes it parts (read
    backwards). So a kind needs windows at the depths only at which its strings part from others of its group, and who shares a window
    parts at the same depth, in the stretch of strings in order that share as much. One row a range is collected.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    after = F.substring("clip", F.col("left") + 1, F.lit(length))
    back = F.encode(F.reverse(F.decode(F.substring("clip", F.lit(1), F.col("left")), "ISO-8859-1")), "ISO-8859-1")
    sides = rows.where(F.length("clip") >= length).select("h", "c", "n", "left", "clip", F.inline(F.array(
        F.struct(F.lit(0).alias("side"), after.alias("s")), F.struct(F.lit(1).alias("side"), back.alias("s")))))
    order = ["side", "h", "s", "c"]         # the clip's hash parts equal strings over ranges
    ranged = sides.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).checkpoint()
    edge = "struct<side: int, h: long, s: binary>"
    edges = ranged.select("_part", "side", "h", "s").mapInArrow(_edges, f"part int, first {edge}, last {edge}, low int, ahead string, behind string").collect()
    edges.sort(key=lambda r: r["part"])
    before, after = _carried(edges, "first", "last", "ahead"), _carried(edges[::-1], "last", "first", "behind")
    kept = ranged.mapInArrow(_settled(length, before, after), "side int, h long, c long, n long, o int, place int, window binary")
    return kept.select(*WINDOWS[:-1], F.xxhash64("window").alias("w1"), F.hash("window").alias("w2"))


def crowded_reach(rows: DataFrame, scratch: Scratch, length: int) -> DataFrame:
    """(x1, x2, a, b) of kinds that occur once in crowded groups: windows settled in a range, others counted whole by their digest."""
    # A window is compared at one place relative to the anchor only, as clips of neighbouring anchors share windows.
    windows = scratch.keep(crowded_windows(rows, length), "windows")
    same = ["side", "h", "place", "w1", "w2"]
    over = windows.where("n > 0")
    often = over.groupBy(*same).agg(F.sum("n").alias("all")).where("all > 1").select(*same)
    met = over.where("c is not null").join(often, same).select("h", "c", "o").union(windows.where("n = 0").select("h", "c", "o"))
    reach = met.groupBy("h", "c").agg(F.min("o").alias("o1"), F.max("o").alias("o2"))
    start = (F.col("pos") - F.col("left")).cast("long")
    return rows.join(reach, ["h", "c"]).select("x1", "x2", (start + F.col("o1")).alias("a"), (start + F.col("o2") + length).alias("b"))


def repeat_groups(docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(h, repeat, x1, x2, start, length): every maximal repeat within the reach of an anchor, named (h, repeat), with all its occurrences
    in the documents named by keyed(). A task holds a group's kinds whole."""
    mine, kinds = anchors(docs, scratch, length, gram)
    rows = clipped(docs, kinds, length, gram).repartition("h").sortWithinPartitions("h")
    found = rows.mapInArrow(_scan(length, gram), "h long, c long, repeat long, back long, ahead long")
    return mine.join(found, ["h", "c"]).select("h", "repeat", "x1", "x2", (F.col("pos") - F.col("back")).alias("start"), (F.col("back") + F.col("ahead")).alias("length"))


def repeated_spans(docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(x1, x2, spans): for each document with repeats, spans (a, b) in bytes whose union is what the repeats of `length` bytes or more cover."""
    mine, kinds = anchors(docs, scratch, length, gram)
    # A clip reaches from length - gram bytes before its anchor, or the text's start, to length bytes after its start, or the text's end.
    twins = mine.join(kinds.where("n > 1").select("h", "c"), ["h", "c"]).select(
        "x1", "x2", F.greatest(F.col("pos") - (length - gram), F.lit(0)).cast("long").alias("a"), (F.col("pos") + length).cast("long").alias("b"))
    mixed_groups = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1")
    asked = kinds.join(scratch.keep(mixed_groups.select("h", (F.col("kinds") > crowd).alias("crowded")), "mixed"), "h")
    rows = scratch.keep(clipped(docs, asked, length, gram), "clips")
    few = rows.where("not crowded").select("h", "n", "x1", "x2", "pos", "left", "clip").repartition("h").sortWithinPartitions("h")
    spans = twins.union(few.mapInArrow(_scan(length), "x1 long, x2 int, a long, b long"))
    many = rows.where("crowded")
    if not many.isEmpty():
        spans = spans.union(crowded_reach(many, scratch, length))
    joined = scratch.keep(spans.groupBy("x1", "x2").agg(F.collect_set(F.struct("a", "b")).alias("spans")), "spans")     # bounded by the text
    scratch.drop("clips")
    scratch.drop("windows")
    scratch.drop("often")
    scratch.drop("kinds")
    return joined


def _remove(names: list[str], texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, at = bytes_of(batch.column("text"))
            lists = batch.column("spans")
            bounds, pairs = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten()
            low, high = (pairs.field(f).to_numpy(zero_copy_only=False) for f in ("a", "b"))
            valid = lists.is_valid().to_numpy(zero_copy_only=False)
            out = []
            for i, (a, b) in enumerate(zip(at.tolist(), at[1:].tolist(), strict=False)):
                text, edges = flat[a:b].tobytes(), []
                if valid[i] and bounds[i] < bounds[i + 1]:
                    x, y = low[bounds[i]:bounds[i + 1]], np.minimum(high[bounds[i]:bounds[i + 1]], b - a)
                    order = np.argsort(x, kind="stable")
                    x, y = x[order], np.maximum.accumulate(y[order])
                    new = np.flatnonzero(np.concatenate([[True], x[1:] > y[:-1]]))
                    edges = np.stack([x[new], y[np.append(new[1:], len(x)) - 1]], axis=1).ravel().tolist()
                ends = [0, *edges, len(text)]
                kept = b"".join(text[p:q] for p, q in zip(ends[::2], ends[1::2], strict=True)) if edges else text
                row = (len(text), len(text) - len(kept), len(edges) // 2, hashlib.sha256(kept).hexdigest())
                out.append((*row, kept.decode("utf-8", "ignore"), edges) if texts else row)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64())][:6 if texts else 4]
            cols = [list(c) for c in zip(*out, strict=True)] or [[] for _ in kinds]
            rest = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*rest, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                                             names=[*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "span_edges"][:len(rest) + len(kinds)])
    return run


def remove_repeats(docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, carry: list[str] | None = None,
                   texts: bool = True) -> DataFrame:
    """Each row of (doc_id, text) without the bytes that a string of `length` bytes covers which also starts anywhere else.

    Returns doc_id, the columns `carry`, n_bytes, n_removed, n_spans, kept_sha256 and, if `texts`, kept_text (what is left, less
    the bytes of characters cut in two) and span_edges (start and end of each removed run, in bytes). Text null: empty. Texts
    shorter than `length` stay. Equal rows are documents like others: from `length` bytes on, each repeats the other and both go.
    """
    carry = carry or []
    spans = repeated_spans(docs.select("doc_id", "text"), scratch, length, gram, crowd)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.xxhash64("doc_id", text).alias("x1"), F.hash(text, "doc_id").alias("x2"), "doc_id", *carry, text.alias("text"))
    joined = rows.join(spans.hint("merge"), ["x1", "x2"], "left").select("doc_id", *carry, "text", "spans")
    fields = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string, span_edges array<long>" if texts else "")
    return joined.mapInArrow(_remove(["doc_id", *carry], texts), extended(joined.select("doc_id", *carry).schema, fields))
