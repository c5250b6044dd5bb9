"""Decontamination, classifiers, page text and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from helpers import marked, odd_docs, words
from pyspark.sql import functions as F

import corpus_pipeline
from facetlake.llm import decontaminate, html, quality, toxicity


def brute_overlaps(docs, items, size):
    patterns = {}
    for i, t in items:
        w = marked(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n and i is not None else 0):
            patterns.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for i, t in docs:
        w = marked(t)
        hit, ids = set(), set()
        for n in {len(p) for p in patterns}:
            for k in range(len(w) - n + 1):
                if (found := patterns.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    ids |= found
        out.append((i, len(w), len(hit), sorted(ids)))
    return out


@pytest.mark.parametrize("turn_bytes,lane", [(1 << 20, 512), (600, 3)])
def test_overlaps(spark, monkeypatch, turn_bytes, lane):
    monkeypatch.setattr(decontaminate, "PATTERN_BYTES", turn_bytes)
    monkeypatch.setattr(decontaminate, "LANE", lane)
    rng = random.Random(lane)
    items = [(i, " ".join(words(rng, rng.choice([1, 2, 5, 13, 30]), 40))) for i in range(25)] + [(3, "x"), (99, None), (None, "q q"), (98, "..")]
    texts = []
    for _ in range(60):
        w = words(rng, rng.randint(0, 60), 40)
        for _ in range(rng.randint(0, 2)):
            part = (rng.choice(items[:25])[1]).upper().split()
            a = rng.randrange(len(part))
            w[len(w) // 2 : len(w) // 2] = part[a : a + 20]
        texts.append(rng.choice([" ", ", ", "\n-"]).join(w))
    docs = list(enumerate([*texts, None, "", "x x"]))
    found = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted((r.doc_id, r.n_words, sum(x["last"] - x["first"] for x in r.runs), sorted(r["items"])) for r in found.collect())
    assert got == brute_overlaps(docs, items, 13)


def test_contamination_rule(spark):
    item = " ".join(words(random.Random(1), 13))
    docs = [(1, item), (2, item + " z" * 247), (3, item + " z" * 248), (4, "z" * 10), (5, None)]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.contamination(df, bench).filter("contaminated").orderBy("doc_id").collect()] == [1, 2]
    assert sorted(r.doc_id for r in decontaminate.decontaminated(df, bench).collect()) == [3, 4, 5]
    assert decontaminate.contamination(df, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contamination(df.limit(0), bench).count() == 0
    odd = odd_docs(spark)
    assert decontaminate.contamination(odd, bench).count() == odd.count() == decontaminate.decontaminated(odd, bench).count()


def labelled(seed, n=700):
    """Prose of which a fifth is junk, and another fifth insults."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = words(rng, rng.randint(5, 120), 9)
        toxic, junk = rng.random() < 0.2, rng.random() < 0.2
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["Fool!", "fools", "twit,", "twits", "oaf", "oafs"])
        text = " ".join(w) + "."
        if junk:
            text = rng.choice([text.upper().replace(" ", "!! "), " | ".join(w), " ".join(x + " " + x for x in w), "$$$ ".join(w)])
        docs.append((i, text))
        labels.append((i, int(not junk), int(toxic)))
    return docs, labels


@pytest.mark.parametrize("fit,label,folds,held", [(quality.quality_scores, "quality", 5, 0), (toxicity.toxicity_scores, "toxic", 4, 2)])
def test_held_out_accuracy(spark, fit, label, folds, held):
    docs, labels = labelled(3)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = fit(df, marks.filter(quality.fold("doc_id", folds) != held))
    truth = {i: (q, t)[label == "toxic"] for i, q, t in labels}
    rows = [(r.predicted, truth[r.doc_id]) for r in out.collect() if zlib.crc32(str(r.doc_id).encode()) % folds == held]
    assert len(rows) > 80 and np.mean([p == t for p, t in rows]) > 0.93
    assert out.filter("score < 0 or score > 1 or (score >= 0.3) <> (predicted = 1)").count() == 0
    again = {r.doc_id: r.score for r in fit(df.repartition(5), marks.filter(quality.fold("doc_id", folds) != held)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-4 for r in out.collect())


@pytest.mark.parametrize("fit", [quality.quality_scores, toxicity.toxicity_scores])
def test_classifiers_odd(spark, fit):
    df = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in fit(df, none).collect()} == {0.5}
    one = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 1), (5, None, None), (777, 1, 1)], "doc_id long, quality int, toxic int")
    assert fit(df, one).count() == df.count() and fit(df.limit(0), one).count() == 0


def test_accepted_keeps_columns(spark):
    docs, labels = labelled(4, 300)
    df = spark.createDataFrame([(i, t, "s", 1.0) for i, t in docs], "doc_id long, text string, source string, score double")
    marks = spark.createDataFrame([(i, q) for i, q, _ in labels], "doc_id long, quality int")
    kept = quality.accepted(df, marks)
    want = {r.doc_id for r in quality.quality_scores(df, marks).filter("predicted = 1").collect()}
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == want and 0 < len(want) < 300


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body class="page ad-free">
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href="/x?a='b'">Some other page, with prose.</a></ul></nav>
<div class="cookie-notice">We use cookies, as everybody does.</div><!-- <p>gone</p> -->
<{main}><h1>The <b>t</b>itle</h1><p>First &lt;paragraph&gt;,
 of   some&nbsp;length.<br>More<p>Second one &#x41;&eacute;.<div class=ad>Buy, now.</div><blockquote>Quoted.</blockquote>
<form><label>Name</label><input name=n><button>Send it.</button></form><section id="comments"><p>Nice text, thanks.</p></section></{main}>
<aside>Related, but no.</aside><footer>&copy; 2024, all rights.</footer></body></html>"""


@pytest.mark.parametrize("main", ["article", "main", 'div class="post-content"'])
def test_main_text(main):
    page = PAGE.format(main=main).replace('</div class="post-content">', "</div>")
    assert html.main_text(page) == "The title First <paragraph>, of some length. More Second one Aé. Quoted."


def test_broken_pages(spark):
    for page in ("", None, "<", "<p", "text only, without markup at all.", "<article><p>cut off &am", "<script>never closed <p>x", "<a '", "<p>" * 3000, '<div class="' + "x" * 50_000):
        html.main_text(page)
    assert html.main_text("<article><p>cut off, in the middle of &am") == "cut off, in the middle of &am"
    df = spark.createDataFrame([(1, None, None, "x"), (1, "u", "<article><p>A b.</p></article>", "x"), (None, "u", "", "x")], "page_id long, url string, html string, text string")
    assert sorted(r.text for r in html.extract(df).collect()) == ["", "", "A b."]
    assert html.extract(df.limit(0)).count() == 0


def test_min_cut_against_brute_force():
    rng = random.Random(2)
    for _ in range(80):
        n = rng.randint(1, 9)
        unary = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.uniform(0, 1.5)) for _ in range(rng.randint(0, 14))]

        def cost(side, unary=unary, edges=edges):
            cut = sum(w for i, j, w in edges if side[i] != side[j])
            return cut + sum(abs(u) for u, s in zip(unary, side, strict=True) if (u > 0) != s)

        best = min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(1 << n))
        assert abs(cost(html.min_cut(unary, edges)) - best) < 1e-9


def test_pipeline(spark, tmp_path):
    rng = random.Random(11)
    docs, labels = labelled(7, 400)
    passage = " ".join(words(rng, 60))
    item = " ".join(words(rng, 20))
    docs = [(i, t) for i, t in docs]
    docs += [(1000, "a b c d e f g h i j. " + passage + " ends here."), (1001, "quite another start, " + passage + " and end."), (1002, docs[1][1]), (1003, item + " is in the benchmark.")]
    rows = [(i, t, "en", ("a", "b")[i % 2], len(t)) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out, had = spark.read.parquet(str(tmp_path / "documents.parquet")), None
    columns, left = out.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, out, str(tmp_path)).write.parquet(path)
        had, out = out, spark.read.parquet(path)
        left[name] = out
        assert name == "source_mixing" or out.columns == columns
    truth = {i: q for i, q, _ in labels}
    kept = {r.doc_id for r in left["quality_classifier"].collect()}
    assert {1000, 1001, 1003} <= kept and np.mean([(i in kept) == bool(q) for i, q in truth.items()]) > 0.93
    ids = {r.doc_id for r in left["minhash_dedup"].collect()}
    assert (1002 in ids) <= (1 not in kept)
    texts = {r.doc_id: r for r in left["suffix_dedup"].collect()}
    assert passage in texts[1000].text and passage not in texts[1001].text and texts[1001].text.startswith("quite another")
    assert all(r.n_chars == len(r.text) for r in texts.values()) and texts.keys() == ids
    clean = {r.doc_id for r in left["benchmark_decontamination"].collect()}
    assert ids - clean == {1003}
    assert {r.doc_id for r in out.collect()} == clean and out.filter("copies > 3").count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).agg(F.sum("taken")).first()[0] == out.agg(F.sum("taken")).first()[0]


@pytest.mark.parametrize("odd", ['<svg width="1"/>', "<video src=x>", "<audio>", "<object data=x>", "<canvas>", "<select><option>o", "<div><video></div>", "<svg><svg><text>no</text></svg><text>no</text></svg>", "<video>no</video>", "<math/>"])
def test_unclosed_elements_drop_no_article(odd):
    article = "<article><p>The first sentence, of some length, stands here.</p>{}<p>The second one, of some length, stands here.</p></article>"
    text = "The first sentence, of some length, stands here. The second one, of some length, stands here."
    assert html.main_text(odd + article.format("")).split() == text.split()
    assert html.main_text(article.format("") + odd + "<footer>no</footer>").split() == text.split()
    assert html.main_text(odd + article.format("") + "<video>no</video>").split() == text.split()


def test_formulas_are_text():
    page = "<article><p>It holds, as said, that <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> here.</p></article>"
    assert html.main_text(page) == "It holds, as said, that x=1 here."
