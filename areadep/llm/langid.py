"""Language identification by words first, then by shorter and shorter character n-grams.

A word that the model knows is scored by its log frequency in each language. A word that it does not know is scored by its
known character n-grams (with word boundaries), of the greatest length of which it has any. The scores of all words of the
whole text are added; the posterior over the learned languages is their softmax.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import extended

WORD = re.compile(r"[^\W\d_]+")
LONGEST = 5                 # characters of the longest n-gram
SAMPLE = 20_000             # labelled documents a model is learned from, as a mean; chosen by a hash of their id
ENTRIES = 100_000           # words, and n-grams of each length, that a model keeps: the most frequent, ties in order of text
MEMO = 300_000              # unseen words a task remembers at a time
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    grams: list[dict[str, int]]        # words, then n-grams of 1 to LONGEST characters: the row of each
    scores: list[np.ndarray]           # log frequency of each row in each language

    def score(self, word: str) -> np.ndarray:
        at = self.grams[0].get(word)
        if at is not None:
            return self.scores[0][at]
        marked = f" {word} "
        for n in range(min(LONGEST, len(marked)), 0, -1):
            known = [r for i in range(len(marked) - n + 1) if (r := self.grams[n].get(marked[i:i + n])) is not None]
            if known:
                return self.scores[n][known].mean(axis=0)
        return np.zeros(len(self.languages), np.float32)


class Memo(dict):
    """The row of each word in a table of scores: the model's words, then up to MEMO unseen words of a task."""

    def __init__(self, model: Model):
        self.model = model
        self.table = np.concatenate([model.scores[0], np.zeros((MEMO, len(model.languages)), np.float32)])
        self.start()

    def start(self) -> None:
        self.clear()
        self.update(self.model.grams[0])
        self.free = len(self.model.grams[0])

    def __missing__(self, word: str) -> int:
        self.table[self.free] = self.model.score(word)
        self[word] = self.free
        self.free += 1
        return self.free - 1

    def rows(self, words: list[str]) -> np.ndarray:
        if self.free + len(words) > len(self.table):
            self.start()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[str, Counter] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            words.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
    for lang, found in words.items():
        tables = [found, *(Counter() for _ in range(LONGEST))]
        for word, k in found.items():
            marked = f" {word} "
            for n in range(1, LONGEST + 1):
                for i in range(len(marked) - n + 1):
                    tables[n][marked[i:i + n]] += k
        for n, table in enumerate(tables):
            for at in range(0, len(keys := list(table)), 50_000):
                part = keys[at:at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([n] * len(part), pa.int32()), pa.array([lang] * len(part), pa.string()),
                                                  pa.array(part, pa.string()), pa.array([table[g] for g in part], pa.int64())],
                                                 names=["kind", "lang", "gram", "n"])


def learn(docs: DataFrame, sample: int = SAMPLE, entries: int = ENTRIES) -> Model:
    """A model from the rows of (doc_id, text, lang) with text and language. Its size is bounded by `entries`, the rows read by `sample`."""
    docs = docs.where("text is not null and lang is not null")
    n = docs.count()
    # A sample by hash: the same rows at any partitioning. Its bound holds as a mean.
    share = min(1.0, sample / max(n, 1))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("text", "lang")
    counts = chosen.mapInArrow(_counts, "kind int, lang string, gram string, n long").groupBy("kind", "gram", "lang").agg(F.sum("n").alias("n"))
    grams = counts.groupBy("kind", "gram").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "n")))).alias("by"), F.sum("n").alias("n"))
    grams = grams.persist()       # bounded by the sample; lost blocks are computed anew
    parts = [grams.where(F.col("kind") == k).orderBy(F.desc("n"), "gram").limit(entries).select("gram", "by").toArrow() for k in range(LONGEST + 1)]
    grams.unpersist()
    tables = [(t.column("gram").to_pylist(), [dict(x) for x in t.column("by").to_pylist()]) for t in parts]
    languages = sorted({lang for _, by in tables for x in by for lang in x})
    model = Model(languages, [], [])
    for names, by in tables:
        c = np.array([[x.get(lang, 0) for lang in languages] for x in by], float).reshape(len(by), len(languages))
        model.grams.append({g: i for i, g in enumerate(names)})
        model.scores.append(np.log((c + 0.5) / (c.sum(axis=0) + 0.5 * (len(by) + 1))).astype(np.float32))
    return model


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns `keep` of each document, its language and the posterior of it.

    Text null or without a letter, or nothing learned: language `und`, score 0. Ties go to the language first in order of
    its name. The text is read whole; nothing of a document but its text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.grams, model.scores))      # bounded by ENTRIES
    schema = extended(docs.select(*keep).schema, "lang_pred string, score double")

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        width = len(model.languages)
        memo = Memo(model)
        for batch in batches:
            names, scores = [], []
            for text in batch.column("_text"):
                words = WORD.findall((text.as_py() or "").lower())
                if not words or not width:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = np.zeros(width)
                for at in range(0, len(words), MEMO // 3):
                    total += memo.table[memo.rows(words[at:at + MEMO // 3])].sum(axis=0, dtype=float)
                best = int(np.argmax(total))
                names.append(model.languages[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(tag, schema)

