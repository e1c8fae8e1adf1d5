"""Vectors, packing, pages and the pipeline."""

import zlib

import numpy as np
import pytest

from areadep.llm import neardup_vectors, packing, pagetext, permutation_index
from areadep.llm.common import Scratch

from . import helpers as h


def vectors(spark):
    r = np.random.default_rng(3)
    base = r.standard_normal((40, 16))
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(base)]
    rows += [(100 + i, [float(x) for x in base[i] + 0.05 * r.standard_normal(16)], i % 3) for i in range(20)]
    rows += [(200 + i, [float(x) for x in base[0]], 0) for i in range(30)]
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] + [1.0] * 15, 1), (303, [float("inf")] + [1.0] * 15, 1), (304, [], 1),
             (305, [None, *[1.0] * 15], 1), (306, [float(x) for x in base[3]], None), (307, [1.0, 2.0], 1), (308, [2.0, 4.0], 1), (None, [1.0] * 16, 1),
             (309, [float(x) * 1e30 for x in base[4]], 1), (310, [float(x) for x in base[5]], 2), (310, [float(x) for x in base[5]], 2), (350, [float(x) for x in base[5]], 2)]
    return spark.createDataFrame([(i, v, lab, "extra", 1.0) for i, v, lab in rows], "vec_id long, embedding array<float>, label int, space string, score double")


def cosine_matrix(rows):
    fine = [i is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v, _ in rows]
    out = np.full((len(rows), len(rows)), -2.0)
    for a, (_, v, _) in enumerate(rows):
        for b, (_, w, _) in enumerate(rows):
            if a != b and fine[a] and fine[b] and len(v) == len(w):
                x, y = np.array(v, float) / np.abs(v).max(), np.array(w, float) / np.abs(w).max()
                out[a, b] = x @ y / np.sqrt((x @ x) * (y @ y))
    return out, fine


@pytest.mark.parametrize("block", [8, 1024])
def test_near_duplicate_vectors(spark, block):
    df = vectors(spark)
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    cos, _ = cosine_matrix(rows)
    label = [x for *_, x in rows]
    near = (cos >= 0.93) & np.array([[a is not None and a == b for b in label] for a in label])
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    root = h.classes(len(rows), [(a, b) for a in range(len(rows)) for b in range(len(rows)) if near[order[a], order[b]]])
    want = sorted(((rows[k][0], int(near[k].sum()), rows[order[c]][0]) for k, c in zip(order, root, strict=True)), key=str)
    got = neardup_vectors.near_duplicates(df, Scratch(spark, "t"), block=block).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)
    assert neardup_vectors.near_duplicates(df.limit(0), Scratch(spark, "t")).count() == 0


def test_tables_keep_the_chance_to_miss():
    for n in (10, 10_000, 10_000_000):
        bits, tables = neardup_vectors.plan(n, 0.93)
        assert (1 - (1 - np.arccos(0.93) / np.pi) ** bits) ** tables <= neardup_vectors.MISS


def test_nearest_of_few_vectors_are_exact(spark):
    df = vectors(spark)
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    cos, fine = cosine_matrix(rows)
    got = {}
    for r in permutation_index.nearest(df, df.where("vec_id % 50 = 0"), Scratch(spark, "t")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    asked = {k for k, (i, *_) in enumerate(rows) if i is not None and i % 50 == 0 and fine[k]}
    assert set(got) == {rows[k][0] for k in asked}
    for k in asked:
        best = sorted((-cos[k, b], rows[b][0]) for b in range(len(rows)) if cos[k, b] > -2 and rows[b][0] != rows[k][0])[:5]
        mine = sorted(got[rows[k][0]])
        assert [n for n, *_ in mine] == list(range(1, len(best) + 1))
        assert [s for *_, s in mine] == pytest.approx([-c for c, _ in best], abs=1e-9)
    assert [v for _, v, _ in sorted(got[0])] == [200, 201, 202, 203, 204]       # ties by id
    assert permutation_index.nearest(df.limit(0), df, Scratch(spark, "t")).count() == 0
    assert permutation_index.nearest(df, df.limit(0), Scratch(spark, "t")).count() == 0


def test_recall_of_the_index(spark):
    x = np.random.default_rng(1).standard_normal((6000, 64))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<float>")
    got = permutation_index.nearest(df, df.where("vec_id % 50 = 0"), Scratch(spark, "t")).collect()
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hits = sum(r["vec_id"] in np.argsort(-(u @ u[r["query_id"]]))[1:6] for r in got)
    assert len(got) == 600 and hits >= 540


def test_recall_where_one_vector_is_a_third_of_the_rows(spark):
    r = np.random.default_rng(2)
    x = r.standard_normal((6000, 64))
    x[r.permutation(6000)[:2000]] = x[0]
    asked = np.arange(0, 6000, 30)
    near = x[0] + 1.5 * r.standard_normal((50, 64))         # their own neighbours stand near the copies
    x[asked[:50]] = near
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for row in permutation_index.nearest(df, df.where("vec_id % 30 = 0"), Scratch(spark, "t")).collect():
        got.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"]))
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hits = 0
    for q in asked.tolist():
        score = np.round(u @ u[q], 9)
        best = [b for b in np.lexsort((np.arange(6000), -score)).tolist() if b != q][:5]
        hits += len(set(best) & {i for _, i in got[q]})
        assert sorted(n for n, _ in got[q]) == [1, 2, 3, 4, 5]
    assert hits >= 0.97 * 5 * len(asked)


def test_vocabularies_agree():
    encoder = packing.Vocabulary().encoder()
    for text in ["", " ", "a", " a", "a b", "a  b", "a \n b", "\n\n a", "it's 12.5% of &&& it", "x y  z", "naïve ünï 漢字 \U0001f600 ok", "a <|endoftext|> b",
                 "tab\tand \x1c sign", "end ", "end  ", h.prose(200, 1), "word " * 50 + "\n" * 5 + " tail"]:
        assert encoder.ids(text) == np.array(encoder.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_a_long_text_is_encoded_in_slices(monkeypatch):
    encoder = packing.Vocabulary().encoder()
    text = h.prose(500, 2) + "  \n odd  blanks " + h.prose(500, 3)
    whole = encoder.ids(text)
    monkeypatch.setattr(packing, "SLICE", 100)
    assert encoder.ids(text) == whole


@pytest.mark.parametrize("target", [4_000, 8_000_000])
def test_packing(spark, sf, target):
    for df in (spark.read.parquet(f"{sf}/documents.parquet"), h.odd_documents(spark)):
        got = packing.pack(packing.pieces(df), Scratch(spark, "t"), target=target).collect()
        encoder = packing.Vocabulary().encoder()
        ids = sorted(((r["doc_id"], encoder.ids(r["text"] or "") + b"\0\0\0\0") for r in df.select("doc_id", "text").collect()), key=str)
        pieces = {}
        for r in sorted(got, key=lambda r: (str(r["doc_id"]), r["piece"])):
            pieces.setdefault(r["doc_id"], []).append(r)
        for i, raw in ids:
            mine = [r for r in pieces[i] if r["ids_crc32"] == zlib.crc32(raw[4 * r["start"]:4 * (r["start"] + r["length"])])]
            assert sum(r["length"] for r in {r["piece"]: r for r in mine}.values()) == len(raw) // 4
            assert all(r["length"] == 2048 for r in mine if r["piece"] > 0) and (len(raw) // 4 > 2048 or len({r["piece"] for r in mine}) == 1)
        by = {}
        for r in got:
            by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for parts in by.values():
            parts.sort()
            assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 2048
        bound = packing.sequences_bound(packing.pieces(df))
        assert bound <= len(by) <= (1.1 if target > 10_000 else 1.4) * bound + 2      # partitions of two sequences cannot be tight
    assert packing.pack(packing.pieces(h.no_documents(spark)), Scratch(spark, "t")).count() == 0


def test_bounds_hold_and_are_reached():
    r = np.random.default_rng(4)
    for _ in range(30):
        n = r.integers(1, 11, 30)
        bins = packing.best_fit_decreasing(n, 10)
        fill = np.bincount(bins, weights=n)
        assert fill.max() <= 10 and packing.lower_bound(np.bincount(n, minlength=11), 10) <= bins.max() + 1
    assert packing.lower_bound(np.bincount([6] * 7, minlength=11), 10) == 7
    assert packing.lower_bound(np.bincount([4] * 7, minlength=11), 10) == 4
    assert packing.best_fit_decreasing(np.array([6, 4, 5, 5, 10]), 10).max() == 2


PAGE = """<!DOCTYPE html><html><head><title>Title &amp; more</title><style>p{color:red}</style><script>var a = "</p><p>no";</script></head><body class="has-sidebar">
<header><h1>The site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/b" title="a > b">News</a></ul></nav><div id="cookie-notice">We use cookies and other things here.</div>
<article><header><h1>A  head&shy;line</h1></header><p>First &lt;paragraph&gt; of   the
text with <b>bold and <a href=x>a link</a> in it.<p>Short.<br>Line<div class="ad">Buy this now, it is cheap</div><ul><li>a point<li>another point</ul>
<aside>Aside text</aside><form><p>Your mail</p></form><p hidden>not shown</p><p>Last&nbsp;words.</article>
<section id="comments"><article><p>A reader says that this is a long and fine article indeed, with many words.</article></section><footer>&copy; the site</footer>"""


def test_pages(spark, sf):
    tree = pagetext.trained()
    assert pagetext.main_text(PAGE, tree) == "A head­line\nFirst <paragraph> of the text with bold and a link in it.\nShort. Line\na point\nanother point\nLast words."
    body = " ".join(["word"] * 30)
    assert pagetext.main_text(f"<div><a>Home</a></div><div><p>{body}</p><p>{body} end</p></div><div><a>x</a></div>", tree) == f"{body}\n{body} end"
    for broken in ("", "<", "<p", "a<b", "<!-- open", "<script>x", "</p></p>", "<p>" * 3000, "<a href='x" + "y" * 5000, "&#0; &bogus; &#xZZ;"):
        assert isinstance(pagetext.main_text(broken, tree), str)
    assert all(pagetext.decide(tree, row[:-1]) == row[-1] for row in pagetext.LABELLED)
    df = spark.createDataFrame([(1, "u", PAGE, "extra"), (2, None, None, None), (None, "v", "", None), (1, "u", PAGE, None), (3, "w", f"<p>{body * 5000}</p>", None)],
                               "page_id long, url string, html string, text string")
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in pagetext.extract(df).collect()), key=str)
    assert [n for *_, n in got] == [len(t) for _, t, _ in got] and len(got) == 5 and (2, "", 0) in got and (None, "", 0) in got
    assert pagetext.extract(df.limit(0)).count() == 0
    for r in pagetext.extract(spark.read.parquet(f"{sf}/pages.parquet")).collect():
        assert r["n_chars"] > 0


def test_pipeline(spark, sf, tmp_path):
    import corpus_pipeline as p
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scratch = Scratch(spark, "t")
    sizes = [docs.count()]
    for k, (name, stage) in enumerate(p.STAGES):
        before = docs
        docs = scratch.keep(stage(spark, docs, sf), name)
        sizes.append(docs.count())
        if k < 4:
            assert docs.columns == p.COLUMNS
        if k < 3:
            assert docs.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
    assert sizes[1] >= 0.95 * sizes[0] and 0 < sizes[2] < sizes[1] and 0 < sizes[3] <= sizes[2]
    assert {"doc_id", "sequence_id", "offset"} <= set(docs.columns)


def test_pipeline_of_odd_documents(spark, sf):
    import corpus_pipeline as p
    for docs in (h.odd_documents(spark), h.no_documents(spark)):
        for _, stage in p.STAGES:
            docs = stage(spark, docs, sf)
        docs.count()


def test_queries_are_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
