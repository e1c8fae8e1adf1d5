"""Small tables with every odd case, and brute-force versions of the operators."""

import hashlib
import math
from collections import Counter

import numpy as np

GAP = bytes(32 if (i < 48 or 58 <= i < 65 or 91 <= i < 97 or 123 <= i < 128) else (i + 32 if 65 <= i < 91 else i) for i in range(256))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, x string, kept string"
rng = np.random.default_rng(5)
VOCABULARY = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(800)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCABULARY, n))


def odd_documents(spark):
    """Nulls in each column, empty and very long texts, ties, repeated rows, shared passages, near copies; names that operators use."""
    passage = prose(80, 1)
    base = prose(120, 2)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    rows = [
        (1, passage, "en"), (2, prose(40, 3) + " " + passage + " " + prose(30, 4), "en"), (3, None, "en"), (4, "", None), (5, " \n\t", "de"),
        (6, base, None), (7, near, "de"), (8, base, "de"), (8, base, "de"), (9, "%%% 123 !!!", "de"), (10, "one two three", "en"), (11, "one two three", "en"),
        (None, prose(50, 6), "en"), (12, prose(60_000, 7), "de"), (13, "é" * 150 + " " + prose(20, 8), "de"), (14, "é" * 150 + " " + prose(20, 9), "de"),
        (15, "a" * 700, "en"), (16, prose(10, 10) + " <|endoftext|> " + prose(5, 11), "en"), (17, "  two  spaces \n and more blanks ", "en"),
    ]
    return spark.createDataFrame([(i, t, lang, None if k % 3 else "src0", None if t is None else len(t), None, "x", None) for k, (i, t, lang) in enumerate(rows)], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().translate(GAP).split()


def shingle_counts(text, size=5):
    w = words(text)
    return Counter(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else Counter()


def classes(n, pairs):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(a) for a in range(n)]


def near_pairs(texts, similar=0.8, common=64):
    sets = [shingle_counts(t) for t in texts]
    df = Counter(s for c in sets for s in c)
    idf = {s: math.log1p(len(texts) / max(v, len(texts) / common)) for s, v in df.items()}
    total = [sum(k * idf[s] for s, k in c.items()) for c in sets]
    where = {}
    for i, c in enumerate(sets):
        for s in c:
            where.setdefault(s, []).append(i)
    for i, c in enumerate(sets):
        both = Counter()
        for s, k in c.items():
            for j in where[s]:
                if j > i:
                    both[j] += min(k, sets[j][s]) * idf[s]
        yield from ((i, j) for j, b in both.items() if b >= similar * (total[i] + total[j] - b) - 1e-9)


def without_repeats(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[p:p + length] for b in raw for p in range(len(b) - length + 1))
    for b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        yield len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()


def language_scores(texts, order=3, least=2, backoff=0.4):
    docs = [words(t) for t in texts]
    counts = [Counter(tuple(w[i:i + k]) for w in docs for i in range(len(w) - k + 1)) for k in range(1, order + 1)]
    everything = sum(counts[0].values())
    for w in docs:
        total = 0.0
        for j in range(len(w)):
            s = math.log(counts[0][tuple(w[j:j + 1])] / everything)
            for k in range(2, order + 1):
                g = tuple(w[j - k + 1:j + 1]) if j >= k - 1 else None
                s = math.log(counts[k - 1][g] / counts[k - 2][g[:-1]]) if g and counts[k - 1][g] >= least else math.log(backoff) + s
            total += s
        yield len(w), total
