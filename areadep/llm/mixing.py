"""Mixing by soft membership: posteriors of a classifier, and rates that give each domain its share of the tokens.

A labelled table teaches a naive Bayes classifier over the distinct features of a text. Its posteriors say how much of each
document's tokens belongs to each domain. Newton steps then fit a rate r >= 0 for each document so that the expected tokens of
each domain, sum of r·tokens·posterior, are nearest to its target in least squares. Rates are a function of the posteriors and of one
weight a domain, so a step needs a few sums over all documents and no state of a document is kept. All of it is DataFrame functions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch

DOMAINS = ["good", "poor", "toxic"]
TARGETS = {"good": 0.97, "poor": 0.025, "toxic": 0.005}     # shares of the tokens
SAMPLE = 20_000         # labelled rows the classifier learns from, as a mean; chosen by a hash of their id
FEATURES = 5_000        # features kept, those that tell most by chi-square
TELLING = 10.83         # least chi-square: one in a thousand by chance
CLOSE = 1e-3            # largest miss of a target, relative to it, that ends the fit
LOOSE = [10.0 ** -k for k in range(2, 13, 2)]       # how much staying near 1 weighs against the targets, in turn
STEPS, EXACT = 60, 1e-9     # Newton steps for each, at most; what is left of the equations that ends them
SEED = 23


def domain_of() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), "\n\t\r", "   "), " "), lambda w: w != "")


def features(words: Column) -> Column:
    """The distinct words of a text, a word that repeats the one before it named as such."""
    before = F.concat(F.array(F.lit("")), F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))))
    return F.array_distinct(F.zip_with(words, before, lambda a, b: F.when(a == b, "#again").otherwise(a)))


def shape(word: Column) -> Column:
    """Words that end in a doubled sign, and words in capitals, by that alone; others in lower case."""
    last = F.right(word, F.lit(1))
    doubled = (F.right(word, F.lit(2)) == F.concat(last, last)) & (F.upper(last) == F.lower(last)) & (F.length(word) > 1)
    capitals = (F.length(word) > 1) & (word == F.upper(word)) & (word != F.lower(word)) & (word != "#again")
    return F.when(doubled, F.concat(F.lit("#"), last)).when(capitals, "#capitals").otherwise(F.lower(word))


def learn(docs: DataFrame, labels: DataFrame, scratch: Scratch, sample: int = SAMPLE, keep: int = FEATURES) -> tuple[DataFrame, dict[str, float]]:
    """(feature, one log likelihood a domain) for at most `keep` features, and the log priors, from labelled rows of (doc_id, quality, toxic)."""
    named = labels.select("doc_id", domain_of().alias("domain")).where("domain is not null and doc_id is not null")
    share = min(1.0, sample / max(named.count(), 1))
    chosen = F.broadcast(named.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1))    # bounded by the sample
    rows = scratch.keep(docs.select("doc_id", "text").join(chosen, "doc_id").select("domain", features(tokens(F.col("text"))).alias("words")), "labelled")
    have = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}
    n = sum(have.values())
    told = rows.select("domain", F.explode(F.array_distinct(F.transform("words", shape))).alias("feature"))
    by = told.groupBy("feature").agg(*[F.count(F.when(F.col("domain") == d, 1)).alias(d) for d in DOMAINS])
    df = sum((F.col(d) for d in DOMAINS), F.lit(0))
    telling = F.lit(0.0)
    for d in DOMAINS:
        a, c = F.col(d), float(have.get(d, 0))
        bottom = df * (n - df) * F.lit(c * (n - c))
        telling = F.greatest(telling, F.when(bottom > 0, F.pow(a * n - df * c, F.lit(2)) * n / bottom).otherwise(0.0))
    best = by.withColumn("telling", telling).where(F.col("telling") >= TELLING).orderBy(F.desc("telling"), "feature").limit(keep)
    model = scratch.keep(best.select("feature", *[F.log((F.col(d) + 0.5) / F.lit(have.get(d, 0) + 1.0)).alias(d) for d in DOMAINS]), "model")
    priors = {d: (have.get(d, 0) + 0.5) / (n + 0.5 * len(DOMAINS)) for d in DOMAINS}
    return model, priors


def posteriors(docs: DataFrame, model: DataFrame, priors: dict[str, float], scratch: Scratch) -> DataFrame:
    """(doc_id, x, tokens, rows, one posterior a domain) of each distinct row of (doc_id, text); rows: how many equal rows there are."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64("doc_id", text).alias("x"), tokens(F.col("text")).alias("words"))
    told = rows.select("doc_id", "x", F.size("words").alias("tokens"), F.posexplode_outer(features(F.col("words"))).alias("at", "word"))
    matched = told.withColumn("feature", shape(F.col("word"))).join(F.broadcast(model), "feature", "left")      # at most FEATURES rows
    rows_of = F.count(F.when(F.coalesce("at", F.lit(0)) == 0, 1))        # each row has one first word or none; equal rows add equal sums
    log = matched.groupBy("doc_id", "x").agg(F.max("tokens").cast("long").alias("tokens"), rows_of.alias("rows"), *[F.coalesce(F.sum(d) / rows_of, F.lit(0.0)).alias(d) for d in DOMAINS])
    log = log.select("doc_id", "x", "tokens", "rows", *[(F.col(d) + F.log(F.lit(priors[d]))).alias(d) for d in DOMAINS])
    top = F.greatest(*DOMAINS)
    whole = sum((F.exp(F.col(d) - top) for d in DOMAINS), F.lit(0.0))
    return scratch.keep(log.select("doc_id", "x", "tokens", "rows", *[(F.exp(F.col(d) - top) / whole).alias(d) for d in DOMAINS]), "posteriors")


def rates(on: dict[str, float]) -> Column:
    """A document's rate: 1 and its posteriors weighted by `on`, not below 0."""
    return F.greatest(F.lit(0.0), sum((F.lit(float(on[d])) * F.col(d) for d in DOMAINS), F.lit(1.0)))


def fit(members: DataFrame, targets: dict[str, float] = TARGETS, close: float = CLOSE) -> tuple[dict[str, float], dict[str, float]]:
    """The weights of the rates that bring the expected tokens of each domain nearest to its target share of all tokens, and the reached shares.

    Of all rates r >= 0 that do so those nearest to 1 are sought: half the sum of tokens·(r - 1)² times `loose`, and half the squared misses
    over the domain's own share, are least at r = max(0, 1 + on·posteriors), and `on` solves three equations. Newton steps, halved until the
    dual falls, solve them; then `loose` is lowered. It ends when every target is met within `close` of itself, or when the optimality
    conditions of nonnegative least squares hold within `close` of the largest relative miss: no rate would gain by rising, none above 0
    by falling. A domain without tokens is left out.
    """
    def at(on: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
        """Shares, their derivatives, the mean of r²/2 and the largest r."""
        r = members.select((F.col("tokens") / F.lit(whole)).alias("n"), *DOMAINS, rates(dict(zip(DOMAINS, on, strict=True))).alias("r")).where("n > 0")
        up = F.when(F.col("r") > 0, F.col("n")).otherwise(0.0)
        twos = [F.sum(up * F.col(d) * F.col(e)) for d in DOMAINS for e in DOMAINS]
        row = r.agg(*[F.sum(F.col("n") * F.col("r") * F.col(d)) for d in DOMAINS], *twos, F.sum(F.col("n") * F.col("r") ** 2) / 2, F.max("r")).first()
        return np.array(row[:3], float), np.array(row[3:12], float).reshape(3, 3), row[12], row[13]

    whole = float(members.agg(F.sum("tokens")).first()[0] or 0)
    on = np.zeros(len(DOMAINS))
    if not whole:
        return dict.fromkeys(DOMAINS, 0.0), dict.fromkeys(DOMAINS, 0.0)
    want = np.array([targets[d] for d in DOMAINS])
    here = at(on)
    base = here[0]
    used = base > 0
    scale = np.where(used, np.sqrt(np.where(used, base, 1.0)), 1.0)
    met = lambda shares: bool((abs(shares - want) <= close * want)[used].all())
    for loose in LOOSE:
        dual = lambda on, half: half - want[used] @ on[used] + loose / 2 * (base @ on ** 2)  # noqa: B023, E731
        for _ in range(STEPS):
            slope = np.where(used, here[0] - want + loose * base * on, 0.0) / scale
            if met(here[0]) or np.abs(slope).max() <= EXACT:
                break
            bend = here[1] / np.outer(scale, scale) * np.outer(used, used) + np.diag(np.where(used, loose, 1.0))
            step, length = -np.linalg.solve(bend, slope) / scale, 1.0
            while True:
                there = at(on + length * step)
                if dual(on + length * step, there[2]) <= dual(on, here[2]) + 1e-4 * length * (slope * scale) @ step + 1e-12 * (1 + abs(dual(on, here[2]))) or length < 1e-6:
                    break
                length /= 2
            on, here = on + length * step, there
        miss = np.where(used, (here[0] - want) / np.where(used, base, 1.0), 0.0)
        largest = np.abs(miss).max()
        if met(here[0]) or (loose * (here[3] - 1) <= close * largest and abs(miss @ here[0]) <= close * largest):
            break
    else:
        raise RuntimeError(f"the fit has not ended: shares {here[0].tolist()}, targets {want.tolist()}")
    return tuple(dict(zip(DOMAINS, map(float, v), strict=True)) for v in (on, here[0]))


def mix(docs: DataFrame, labels: DataFrame, scratch: Scratch, targets: dict[str, float] = TARGETS, seed: int = SEED) -> DataFrame:
    """(doc_id, x, tokens, rows, posteriors, rate, copies, reached shares) of the distinct rows of (doc_id, text); x is a hash of both.

    copies is the rate rounded up or down by a hash of x, so that its mean is the rate. Text null or empty: no tokens, posteriors
    as the priors. Without labels the posteriors are equal for all documents. Equal rows share one answer, which holds
    for each of them; rows is how many they are, and all of them count in the sums. reached_ and a domain, the same
    in every row: its expected tokens at these rates as a share of all tokens, to be held against its target.
    """
    model, priors = learn(docs, labels, scratch)
    members = posteriors(docs, model, priors, scratch)
    on, reached = fit(members.withColumn("tokens", F.col("tokens") * F.col("rows")), targets)
    u = F.pmod(F.xxhash64("x", F.lit(seed)), F.lit(1_000_000)) / F.lit(1e6)
    rated = members.withColumn("rate", rates(on)).withColumn("copies", F.floor(F.col("rate") + u).cast("int"))
    return rated.select("*", *[F.lit(reached[d]).alias(f"reached_{d}") for d in DOMAINS])
