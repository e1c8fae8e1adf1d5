"""Operators on documents against brute force, on the smallest table and on one of odd cases."""

import hashlib

import numpy as np
import pytest

from areadep.llm import chunks, langid, lmscore, minhash, mixing, repeats
from areadep.llm.common import Scratch, components
from areadep.llm.shingles import common_shingles

from . import helpers as h


@pytest.fixture(scope="module")
def tables(spark, sf):
    found = {"sf": spark.read.parquet(f"{sf}/documents.parquet"), "odd": h.odd_documents(spark), "none": h.no_documents(spark)}
    return {k: (df, [(r["doc_id"], r["text"]) for r in df.collect()]) for k, df in found.items()}


CASES = ["sf", "odd", "none"]


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("crowd", [1, 1000])
def test_repeats(spark, tables, case, crowd):
    df, texts = tables[case]
    got = rows(repeats.remove_repeats(df, Scratch(spark, "t"), crowd=crowd), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = [(i, *r) for (i, _), r in zip(texts, h.without_repeats([t for _, t in texts]), strict=True)]
    assert got == sorted(want, key=lambda r: tuple((v is None, v) for v in r))


def test_long_texts_are_cut_without_a_seam(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 700)
    texts = [h.prose(900, 21), h.prose(200, 22) + " " + h.prose(900, 21)[1500:3000] + " " + h.prose(100, 23), h.prose(300, 24)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = rows(repeats.remove_repeats(df, Scratch(spark, "t")), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == [(i, *r) for i, r in enumerate(h.without_repeats(texts))] and got[0][2] > 1400


def test_crowded_groups_are_read_where_they_part(spark):
    """Passages of which copies share different stretches, in groups that lie over many ranges: right, and with few windows a kind."""
    rng = np.random.default_rng(41)
    passage = h.prose(90, 42)
    texts = []
    for k in range(240):
        a, b = (0, len(passage)) if k % 3 == 0 else sorted(rng.integers(0, len(passage), 2).tolist())
        texts.append(h.prose(6, 1000 + k) + " " + passage[a:max(b, a + 150)] + h.prose(6, 2000 + k % 60))
    texts += [texts[3], texts[4][:-7], "\u00e9\u00ff" + texts[6], texts[9] + "x" * 300]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    held = {c: spark.conf.get(c) for c in (coalesce, "spark.sql.shuffle.partitions")}
    spark.conf.set(coalesce, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = rows(repeats.remove_repeats(df, Scratch(spark, "t"), crowd=1), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert got == [(i, *r) for i, r in enumerate(h.without_repeats(texts))]
        scratch = Scratch(spark, "t")
        _, kinds = repeats.anchors(df, scratch, repeats.LENGTH, repeats.GRAM)
        crowded = scratch.keep(repeats.clipped(df, kinds, repeats.LENGTH, repeats.GRAM), "crowded")
        every = crowded.selectExpr(f"sum(greatest(length(clip) - {repeats.LENGTH} + 1, 0))").first()[0]
        assert repeats.crowded_windows(crowded, repeats.LENGTH).count() * 3 < every
    finally:
        for c, v in held.items():
            spark.conf.set(c, v)


@pytest.mark.parametrize("copies", [40, 400])
def test_crowded_groups_are_settled_in_their_ranges(spark, copies):
    """A passage among other words each time: two rows a kind at any size, and few that other ranges must be asked about."""
    passage = h.prose(90, 51)
    texts = [h.prose(8, 3000 + k) + " " + passage + " " + h.prose(8, 5000 + k) for k in range(copies)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    scratch = Scratch(spark, "t")
    _, kinds = repeats.anchors(df, scratch, repeats.LENGTH, repeats.GRAM)
    crowded = scratch.keep(repeats.clipped(df, kinds, repeats.LENGTH, repeats.GRAM), "crowded")
    windows = scratch.keep(repeats.crowded_windows(crowded, repeats.LENGTH), "windows")
    assert windows.count() <= 2 * crowded.count() + 4 * repeats.LENGTH
    assert windows.where("n > 0").count() <= 4 * repeats.LENGTH
    got = rows(repeats.remove_repeats(df, scratch, crowd=1), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == [(i, *r) for i, r in enumerate(h.without_repeats(texts))]


def test_crowded_groups_over_the_ends_of_ranges(spark):
    """Few letters, short windows and more ranges than a group has strings apart: stretches that run on, alone and met elsewhere."""
    rng = np.random.default_rng(61)
    base = "".join(rng.choice(list("abc"), 300))
    texts = []
    for _ in range(500):
        a, n = int(rng.integers(0, 280)), int(rng.integers(8, 60))
        own = ["".join(rng.choice(list("ab"), int(rng.integers(0, 14)))) for _ in range(2)]
        texts.append(own[0] + base[a:a + n] + own[1])
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    held = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for ranges in (1, 37):
            spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
            got = rows(repeats.remove_repeats(df, Scratch(spark, "t"), 20, 10, crowd=1), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
            assert got == [(i, *r) for i, r in enumerate(h.without_repeats(texts, 20))]
    finally:
        for c, v in held.items():
            spark.conf.set(c, v)


def test_maximal_repeats_have_all_their_places(spark):
    a, b = h.prose(60, 31), h.prose(60, 32)
    texts = [h.prose(20, k) + " " + a + " " + (b if k % 2 else h.prose(20, 100 + k)) for k in range(6)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    groups = {}
    for r in repeats.repeat_groups(df, Scratch(spark, "t")).join(repeats.keyed(df), ["x1", "x2"]).collect():
        raw = r["text"].encode()[r["start"]:r["start"] + r["length"]]
        groups.setdefault((r["h"], r["repeat"]), set()).add((r["doc_id"], raw))
    assert groups and all(len({raw for _, raw in g}) == 1 and len(next(iter(g))[1]) >= 200 for g in groups.values())
    assert {3, 6} <= {len(g) for g in groups.values()}      # those with both passages, and all that have the first
    for g in groups.values():
        raw = next(iter(g))[1]
        assert {i for i, _ in g} == {i for i, t in enumerate(texts) if raw in t.encode()}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("block", [2, 400])
def test_near_duplicates(spark, tables, case, block):
    df, texts = tables[case]
    got = minhash.near_duplicates(df, Scratch(spark, "t"), block=block).collect()
    assert len(got) == len(texts)
    order = sorted(range(len(texts)), key=lambda k: (texts[k][0] is not None, texts[k][0] or 0))
    texts = [texts[k] for k in order]
    root = h.classes(len(texts), h.near_pairs([t for _, t in texts]))
    want = sorted(((i, texts[c][0]) for (i, _), c in zip(texts, root, strict=True)), key=str)
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=str) == want
    assert len({(r["doc_id"], r["x"]) for r in got if r["kept"]}) == len({(texts[c][0], texts[c][1] or "") for c in root})


def test_near_copies_of_one_text_are_one_class(spark):
    w = h.prose(300, 41).split()
    texts = [" ".join(w[:k] + [f"w{k}"] + w[k + 1:]) for k in range(0, 300, 2)] + [h.prose(200, k) for k in range(50, 60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(df, Scratch(spark, "t"), block=20).collect()}
    assert got == {i: 0 if i < 150 else i for i in range(160)}


def test_common_shingles_are_counted_exactly(spark):
    line = "this line stands in many of the texts"
    df = spark.createDataFrame([(h.prose(50, k) + (" " + line if k % 3 == 0 else ""),) for k in range(300)], "text string")
    counts = common_shingles(df, 300)
    assert sorted(counts.values()) == [100] * 4


@pytest.mark.parametrize("case", CASES)
def test_chunks(spark, tables, case):
    df, texts = tables[case]
    got = chunks.dedup(df, Scratch(spark, "t")).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["n_bytes"] - r["n_removed"] >= 0 and r["n_removed"] <= r["n_repeated"]
    if case == "odd":
        by = {r["doc_id"]: r for r in got}
        assert by[1]["n_removed"] == 0 and by[2]["n_removed"] > 200 and by[12]["n_removed"] == 0     # the first copy of the passage stays
        assert by[8]["n_removed"] > 300 and by[6]["n_removed"] == 0 and by[10]["n_removed"] == by[11]["n_removed"] == 0


@pytest.mark.parametrize("case", CASES)
def test_the_chunk_query_against_plain_digests(spark, tables, case, tmp_path):
    """Each chunk of each document, the first by doc_id and place staying, as the registered query has it."""
    from areadep.llm.queries import QUERIES
    df, texts = tables[case]
    line = "a line of less than 128 bytes that stands in every text"
    more = spark.createDataFrame([(7000 + k, line) for k in range(3)], "doc_id long, text string")
    df.select("doc_id", "text").union(more).write.parquet(f"{tmp_path}/documents.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    docs = sorted({(r["doc_id"] is not None, r["doc_id"] or 0, r["x1"], r["x2"], r["text"] or "") for r in repeats.keyed(df).collect()})
    gear, seen, parts = chunks.Gear(), {}, {}
    for some, i, *_, text in docs:
        raw = text.encode()
        ends = gear.bounds(np.frombuffer(raw, np.uint8), np.array([len(raw)]), chunks.LEAST, chunks.MOST)
        parts[i if some else None, text] = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        for c in parts[i if some else None, text]:
            seen[c] = seen.get(c, 0) + 1
    want, first = {}, set()
    for key, cs in parts.items():
        kept = []
        for c in cs:
            if c not in first:
                kept.append(c)
            first.add(c)
        raw = b"".join(kept)
        want[key] = (sum(len(c) for c in cs if seen[c] > 1), sum(map(len, cs)), sum(map(len, cs)) - len(raw), hashlib.sha256(raw).hexdigest())
    got = rows(QUERIES["op4_substring_dedup"](spark, str(tmp_path)), "doc_id", "n_repeated", "n_bytes", "n_removed", "kept_sha256")
    expected = [(r["doc_id"], *want[r["doc_id"], r["text"] or ""]) for r in df.collect()]
    assert got == sorted(expected, key=lambda r: tuple((v is None, v) for v in r))
    assert [r[3] for r in got if r[0] is not None and r[0] >= 7000] == [0, len(line), len(line)]


def test_chunks_follow_an_insertion(spark):
    text = h.prose(2000, 51)
    df = spark.createDataFrame([(1, text), (2, "some words put before it " + text[:3000] + " and here " + text[3000:])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in chunks.dedup(df, Scratch(spark, "t")).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["n_bytes"] - got[2]["n_removed"] < 700


@pytest.mark.parametrize("case", CASES)
def test_scores(spark, tables, case):
    df, texts = tables[case]
    for chunk in (20_000, 4_000_000):
        got = rows(lmscore.score(df, Scratch(spark, "t"), chunk=chunk, share=50_000), "doc_id", "n_words", "log_score")
        want = sorted(((i, *r) for (i, _), r in zip(texts, h.language_scores([t for _, t in texts]), strict=True)), key=lambda r: tuple((v is None, v) for v in r))
        assert len(got) == len(want)
        for g, w in zip(got, want, strict=True):
            assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], rel=1e-6, abs=1e-6)


def test_language_of_held_out_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").withColumn("held_out", langid.held_out())
    got = langid.predict(df, langid.learn(df.where("not held_out")), ["doc_id", "lang", "held_out"]).where("held_out").collect()
    assert got and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)


def test_language_of_odd_documents(spark):
    df = h.odd_documents(spark)
    got = langid.predict(df, langid.learn(df), ["doc_id"]).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == df.count() and all(0 <= r["score"] <= 1 for r in got)
    assert {i for i, r in by.items() if r["lang_pred"] == "und"} == {3, 4, 5, 9}
    nothing = h.no_documents(spark)
    assert langid.predict(nothing, langid.learn(nothing), ["doc_id"]).count() == 0
    assert {r["lang_pred"] for r in langid.predict(df, langid.learn(nothing), ["doc_id"]).collect()} == {"und"}


def test_unseen_words_fall_back_to_shorter_grams():
    model = langid.Model(["a", "b"], [{"known": 0}, *({} for _ in range(5))], [langid.np.array([[-1.0, -9.0]], "f4"), *(langid.np.zeros((0, 2), "f4") for _ in range(5))])
    model.grams[2], model.scores[2] = {"zz": 0}, langid.np.array([[-7.0, -2.0]], "f4")
    model.grams[1], model.scores[1] = {"q": 0}, langid.np.array([[-3.0, -4.0]], "f4")
    assert model.score("known").argmax() == 0 and model.score("xzzx").argmax() == 1 and model.score("q").argmax() == 0
    assert (model.score("kkk") == 0).all()


def test_mixing_meets_its_targets(spark, sf):
    df, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    targets = {"good": 0.9, "poor": 0.07, "toxic": 0.03}
    got = mixing.mix(df, labels, Scratch(spark, "t"), targets).toPandas()
    p, n = got[mixing.DOMAINS].to_numpy(), got.tokens.to_numpy(float)
    base, want = n @ p, n.sum() * np.array([targets[d] for d in mixing.DOMAINS])
    miss = lambda r: (((r * n) @ p - want) ** 2 / base).sum()
    best = np.ones(len(n))
    for _ in range(20_000):     # the plain method, to the end
        best = np.maximum(0, best - p @ (((best * n) @ p - want) / base))
    assert miss(got.rate.to_numpy()) <= miss(best) + 0.05 * (miss(np.ones(len(n))) - miss(best))      # it stops when little is left to gain
    assert (got.rate >= 0).all() and (abs(got.copies - got.rate) < 1).all() and len(got) == df.select("doc_id", "text").distinct().count()
    assert got[["good", "poor", "toxic"]].sum(axis=1).to_numpy() == pytest.approx(1)


def told(members, on):
    got = members.withColumn("rate", mixing.rates(on)).toPandas()
    return got.rate.to_numpy(), got.tokens.to_numpy(float), got[mixing.DOMAINS].to_numpy()


def test_mixing_meets_feasible_targets_within_one_percent(spark):
    p = np.random.default_rng(61).dirichlet([0.6, 0.5, 0.4], 400)
    members = spark.createDataFrame([(int(n), *map(float, q)) for n, q in zip(range(50, 450), p, strict=True)], ["tokens", *mixing.DOMAINS])
    for targets in ({"good": 0.97, "poor": 0.025, "toxic": 0.005}, {"good": 0.9, "poor": 0.07, "toxic": 0.03}, {"good": 0.05, "poor": 0.05, "toxic": 0.9}):
        on, reached = mixing.fit(members, targets)
        r, n, q = told(members, on)
        shares = (r * n) @ q / n.sum()
        assert (r >= 0).all() and shares == pytest.approx([reached[d] for d in mixing.DOMAINS])
        assert shares == pytest.approx([targets[d] for d in mixing.DOMAINS], rel=0.01)


def test_mixing_of_targets_out_of_reach_is_least_squares(spark, sf):
    """The rates of the production targets on the smallest table, whose posteriors overlap, against the optimality conditions."""
    df, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = mixing.mix(df, labels, Scratch(spark, "t")).toPandas()
    r, n, q = got.rate.to_numpy(), got.tokens.to_numpy(float), got[mixing.DOMAINS].to_numpy()
    n /= n.sum()
    shares, want = (r * n) @ q, np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    assert shares == pytest.approx([got[f"reached_{d}"][0] for d in mixing.DOMAINS])
    miss = (shares - want) / (n @ q)
    gain = q @ miss / np.abs(miss).max()
    assert np.abs(shares / want - 1).max() <= 0.01 or (gain[n > 0].min() >= -2e-3 and abs((n * r) @ gain) <= 2e-3)


def test_mixing_counts_equal_rows(spark):
    words = {d: [f"{d}{k}" for k in range(5)] for d in mixing.DOMAINS}
    r = np.random.default_rng(62)
    texts = [" ".join([*r.choice(words[d], 8), *r.choice([w for v in words.values() for w in v], 12)]) for d in mixing.DOMAINS for _ in range(40)]
    once = spark.createDataFrame([*enumerate(texts), (500, None), (None, "good1 poor2")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 40), int(i >= 80)) for i in range(120)], "doc_id long, quality int, toxic int")
    model, priors = mixing.learn(once, labels, Scratch(spark, "t"))
    often = once.union(once.where("doc_id % 3 = 0 or doc_id is null")).union(once.where("doc_id = 6 or doc_id = 500"))
    one, more = ({r["x"]: r for r in mixing.posteriors(df, model, priors, Scratch(spark, "t")).collect()} for df in (once, often))
    assert one.keys() == more.keys() and all(r["rows"] == 1 for r in one.values())
    for x, row in more.items():
        i = row["doc_id"]
        assert row["rows"] == (1 + (i is None or i % 3 == 0) + (i in (6, 500))) and row["tokens"] == one[x]["tokens"]
        assert [row[d] for d in mixing.DOMAINS] == pytest.approx([one[x][d] for d in mixing.DOMAINS], abs=1e-9)
    got = mixing.mix(often, labels, Scratch(spark, "t"), {"good": 0.5, "poor": 0.3, "toxic": 0.2}).toPandas()
    n = (got.tokens * got.rows).to_numpy(float)
    assert n.sum() == sum(len((t or "").split()) for _, t in often.collect())
    assert (got.rate.to_numpy() * n) @ got[mixing.DOMAINS].to_numpy() / n.sum() == pytest.approx([0.5, 0.3, 0.2], rel=0.01)


def test_mixing_of_odd_documents(spark):
    df = h.odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 1), (9, None, None), (8, 1, 0), (8, 1, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    got = mixing.mix(df, labels, Scratch(spark, "t")).collect()
    assert len(got) == df.select("doc_id", "text").distinct().count() and all(r["rate"] >= 0 for r in got)
    assert mixing.mix(df, labels.limit(0), Scratch(spark, "t")).count() == len(got)
    assert mixing.mix(h.no_documents(spark), labels, Scratch(spark, "t")).count() == 0


def test_components(spark):
    pairs = [(k, k + 1) for k in range(100, 140)] + [(7, 9), (9, 7), (9, 900), (5, 5), (1000, 1001)] + [(2000, 2000 + k) for k in range(1, 60)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {**{k: 100 for k in range(100, 141)}, 7: 7, 9: 7, 900: 7, 1000: 1000, 1001: 1000, **{2000 + k: 2000 for k in range(60)}}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0
