"""Spelling variants: words one edit apart, found by walking a trie that is a table of edges.

The trie is relational. A word's path goes through nodes; only nodes at which words part are kept, so an edge carries the
letters up to the next such node, or up to the end of a single word (a leaf). A state (word, position, node, edits) stands
for a word read up to a position with the trie at a node. States without an edit lie on the word's own path and are known
at once; one join with the edges makes the edit at every node of every path, and each further level joins the states that
are left with the edges of their nodes, letter for letter. A state that reaches a leaf with its word read to the end is a
neighbour.

Two tries, of the words and of the words reversed, keep the frontier small: an edit in the second half of a word is made in
the first of them and one in the first half in the other, so a walk starts below half of the word, where few words are
left. Of a pair, the longer word loses a letter, or the smaller of two letters is replaced: each pair is walked once or twice.
Nodes are known by a 61-bit hash of their letters; every neighbour is compared letter by letter at the end, so that a
collision can add work and never a result. Levels follow the branching of the trie, not the length of words.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch

LEAST_LETTERS = 5
LEAST_COUNT = 3
TIMES = 2               # a form occurs at least so many times as often as the word
HELD = 300_000          # distinct words that a task counts at a time
PRIME = (1 << 61) - 1
BASE = 1_000_003_000_037
END = "$"               # stands after the last letter of each word; smaller than every letter

# A byte for each letter of Latin-1 in lower case (A to Z only are changed), a space for all else.
LETTERS = bytes(c + 32 if 65 <= c < 91 else c if 97 <= c < 123 or c >= 0xC0 else 32 for c in range(256))


def runs_of(text: str) -> list[bytes]:
    """Maximal runs of letters, one byte a code point; what Latin-1 does not have is no letter."""
    return text.encode("latin-1", "replace").translate(LETTERS).split()


def damaged(run: bytes, start: int, one_in: int) -> bytes:
    """The run without one of its letters, if `one_in` divides the crc32 of what it started with and the run in UTF-8."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, one_in: int | None = None, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all runs of letters of the whole texts of (doc_id, text), of at least `letters` and `least` occurrences.

    Text null or without letters has no words. With `one_in`, some runs lose a letter (see `damaged`), by the crc32 of
    `<doc_id>:<run>`; a null doc_id has none, so nothing is lost. Repeated rows count again. Tasks count before the shuffle.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = defaultdict(int)

        def given() -> Iterator[pa.RecordBatch]:
            names = list(held)
            for at in range(0, len(names), 50_000):
                part = names[at:at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in part], pa.string()),
                                                  pa.array([held[w] for w in part], pa.int64())], names=["word", "k"])
            held.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                i, found = doc_id.as_py(), Counter(runs_of(text.as_py() or ""))
                start = None if i is None or one_in is None else zlib.crc32(f"{i}:".encode())
                for run, k in found.items():
                    word = run if start is None else damaged(run, start, one_in)
                    if len(word) >= letters:
                        held[word] += k
                if len(held) >= HELD:
                    yield from given()
        yield from given()

    counts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(count, "word string, k long")
    return counts.groupBy("word").agg(F.sum("k").alias("n")).where(F.col("n") >= least)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, way, depth, node, c): the nodes of each word's path from half of it on, with the letter that follows; both ways."""
    for batch in batches:
        ids, ways, depths, nodes, letters = [], [], [], [], []

        def given() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(np.array(x, kind)) for x, kind in (  # noqa: B023
                (ids, np.int64), (ways, np.int32), (depths, np.int32), (nodes, np.int64), (letters, np.int32))],  # noqa: B023
                names=["id", "way", "depth", "node", "c"])
            for x in (ids, ways, depths, nodes, letters):  # noqa: B023
                x.clear()
            return out

        for i, word in zip(batch.column("id").to_pylist(), batch.column("word"), strict=True):
            raw = word.as_py().encode("latin-1")
            for way in (0, 1):
                h, half = way + 1, len(raw) // 2
                for d, c in enumerate(raw if way == 0 else reversed(raw)):
                    if d >= half:
                        ids.append(i), ways.append(way), depths.append(d), nodes.append(h), letters.append(c)
                    h = (h * BASE + c) % PRIME
                ids.append(i), ways.append(way), depths.append(len(raw)), nodes.append(h), letters.append(0)
            if len(ids) > 200_000:
                yield given()
        yield given()


def _letters_at(column: str | Column, at: Column, n: Column) -> Column:
    return F.substring(column, at + 1, n)


def neighbours(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, an, b, bn): every pair of words of (word, n) that differ by one inserted, deleted or replaced letter, listed from both sides.

    Words are distinct, not null and of letters of Latin-1 only. A word has at most about 90 replacements a place, so no
    word has a great number of neighbours, whatever the table.
    """
    words = scratch.keep(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()), "words")
    steps = words.select("id", "word").mapInArrow(_steps, "id long, way int, depth int, node long, c int")
    parting = scratch.keep(steps.groupBy("node").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("node"), "parting")
    passed = steps.select("id", "way", "depth", "node").join(parting.hint("merge"), "node")
    paths = passed.groupBy("id", "way").agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("nodes"))
    paths = words.join(paths.hint("merge"), "id").withColumn("s", F.concat(F.when(F.col("way") == 0, F.col("word")).otherwise(F.reverse("word")), F.lit(END)))
    at = paths.select("word", "n", "way", "s", "nodes", F.posexplode("nodes").alias("k", "here"))
    after = F.get("nodes", F.col("k") + 1)
    until = F.coalesce(after["depth"], F.length("s")) - F.col("here.depth")
    at = at.select("word", "n", "way", "s", F.col("here.depth").alias("depth"), F.col("here.node").alias("node"), after["node"].alias("child"),
                   _letters_at("s", F.col("here.depth"), until).alias("label"))
    at = scratch.keep(at, "paths")
    leaf = F.when(F.col("child").isNull(), F.struct(F.col("word").alias("w"), F.col("n").alias("n")))
    edges = at.select(F.col("node").alias("e_node"), F.substring("label", 1, 1).alias("e_c"), F.col("label").alias("e_label"),
                      F.col("child").alias("e_child"), leaf.alias("e_leaf"))
    # One row an edge; leaves are told apart by their words, other edges are the same for all words that pass.
    edges = scratch.keep(edges.distinct(), "edges")

    own = F.substring("label", 1, 1)
    following = _letters_at("s", F.col("depth") + 1, F.lit(1))
    size = F.length("e_label")
    replaced = (F.col("e_c") > own) & (_letters_at("s", F.col("depth") + 1, size - 1) == F.substring("e_label", 2, F.lit(1 << 30)))
    lost = (following != own) & (F.col("e_c") == following) & (_letters_at("s", F.col("depth") + 1, size) == F.col("e_label"))
    far = (F.col("way") == 0) | (F.col("depth") * 2 >= F.length("s") - 1)      # the other way, the middle belongs to the first trie
    tried = at.where((own != END) & far).join(edges.hint("merge"), (F.col("node") == F.col("e_node")) & (replaced | lost))
    one = F.col("depth") + size
    given = lambda df, position: df.select("word", "n", "s", position.cast("int").alias("position"), F.col("e_child").alias("node"), F.col("e_leaf").alias("leaf"))
    # An edge may take both edits: the letter after the one lost is also a replacement of it.
    tried = tried.select("word", "n", "s", "e_child", "e_leaf", F.explode(F.array_compact(F.array(F.when(replaced, one), F.when(lost, one + 1)))).alias("position"))
    states = scratch.keep(given(tried, F.col("position")), "level0")
    found, level = states.where("leaf is not null"), 0
    while not (alive := states.where("leaf is null")).isEmpty():
        here = F.col("position")
        matched = (F.col("node") == F.col("e_node")) & (_letters_at("s", here, F.lit(1)) == F.col("e_c")) & (_letters_at("s", here, size) == F.col("e_label"))
        level += 1
        states = scratch.keep(given(alive.drop("leaf").join(edges.hint("merge"), matched), here + size), f"level{level}")
        found = found.union(states.where("leaf is not null"))
    near = found.where((F.col("position") == F.length("s")) & (F.levenshtein("word", "leaf.w", 1) == 1))
    near = near.select(F.col("word").alias("a"), F.col("n").alias("an"), F.col("leaf.w").alias("b"), F.col("leaf.n").alias("bn"))
    return near.union(near.select("b", "bn", "a", "an")).distinct()


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of (word, form): the end of each chain of forms, by doubling. A form occurs at least twice as often as its
    word, so chains are no longer than the logarithm of the largest count, and the rounds than the logarithm of that."""
    held, k = scratch.keep(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("on")), "root0"), 0
    while not held.where("on").isEmpty():
        k += 1
        further = held.select(F.col("word").alias("root"), F.col("root").alias("end"))
        held = scratch.keep(held.join(further.hint("merge"), "root", "left").select(
            "word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("on")), f"root{k}")
    return held.select("word", "root")


def variants(words: DataFrame, scratch: Scratch, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of (word, n): its neighbours' number, the most frequent of them (ties: the
    smallest in order of code points) as form if it occurs at least `times` as often, and the end of the chain of forms.

    Words without a neighbour: n_near 0, no form, root the word itself. An empty table gives an empty one.
    """
    words = scratch.keep(words.select("word", "n"), "counted")
    near = neighbours(words, scratch)
    every = words.select(F.col("word").alias("a"), F.col("n").alias("an"), F.lit(None).cast("string").alias("b"), F.lit(None).cast("long").alias("bn")).union(near)
    best = F.min(F.when(F.col("b").isNotNull(), F.struct((-F.col("bn")).alias("less"), F.col("b").alias("b"))))
    table = every.groupBy(F.col("a").alias("word")).agg(F.max("an").alias("n"), F.count("b").alias("n_near"), best.alias("best"))
    most = -F.col("best.less")
    enough = most >= F.col("n") * times
    table = scratch.keep(table.select("word", "n", "n_near", F.when(enough, F.col("best.b")).alias("form"), F.when(enough, most).alias("form_n")), "table")
    ends = roots(table.where("form is not null"), scratch)
    return table.join(ends.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# The same rows by another way, for the tables of documents: crc32 bit by bit, and words that share a form with one letter left out.
SQL = r"""
with recursive bits as (
  select list_transform(range(256), lambda b: list_reduce(list_prepend(b::bigint, range(8)),
    lambda c, k: case when c % 2 = 1 then xor(3988292384, c // 2) else c // 2 end)) as t
), runs as (
  select doc_id::varchar as i, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents
), counted as (
  select i, run, count(*) as k, hex(encode(i || ':' || run)) as x from runs group by i, run
), summed as (
  select i, run, k, xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
    list_transform(range(length(x) // 2), lambda p: ('0x' || substr(x, 2 * p::int + 1, 2))::bigint)),
    lambda c, b: xor(t[(xor(c, b) % 256) + 1], c // 256))) as h from counted, bits
), words as (
  select case when h % 97 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, sum(k)::bigint as n
  from summed group by 1 having length(word) >= 5 and sum(k) >= 3
), holes as (
  select word, n, unnest(range(1, length(word) + 1)) as p from words
), cut as (
  select word, n, p, substr(word, 1, p::int - 1) || substr(word, p::int + 1) as rest from holes
), pairs as (
  select a.word, b.word as other, b.n as m from cut a join cut b on a.rest = b.rest and a.p = b.p and length(a.word) = length(b.word) where a.word <> b.word
  union select c.word, w.word, w.n from cut c join words w on c.rest = w.word
  union select w.word, c.word, c.n from cut c join words w on c.rest = w.word
), best as (
  select word, count(*) as n_near, max(m) as m, arg_min(other, (-m, other)) as other from pairs group by word
), formed as (
  select w.word, case when b.m >= 2 * w.n then b.other end as form, w.n, coalesce(b.n_near, 0) as n_near, case when b.m >= 2 * w.n then b.m end as form_n
  from words w left join best b using (word)
), chain as (
  select word, word as root from formed
  union all select c.word, f.form from chain c join formed f on f.word = c.root where f.form is not null
)
select f.word, f.form, c.root, f.n, f.n_near, f.form_n from formed f join
  (select c.word, c.root from chain c join formed g on g.word = c.root where g.form is null) c on c.word = f.word
"""
