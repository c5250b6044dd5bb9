"""Learned operators against plain versions of their methods, and rows without ids of their own."""

import math
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import odd_docs, words
from test_texts import labelled

import corpus_pipeline
from facetlake.llm import decontaminate, minhash, quality, shared, toxicity
from facetlake.llm.textkit import MARKS, Words


def counts_of(texts):
    raw, offsets = shared.string_buffer(pa.array(texts))
    return quality.term_counts(raw, offsets)


def test_quality_is_the_vote_of_the_nearest(spark):
    docs, labels = labelled(31, 260)
    known = {i: q for i, q, _ in labels if i < 200}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in quality.quality_scores(df, spark.createDataFrame(list(known.items()), "doc_id long, quality int")).collect()}
    texts = dict(docs)
    ids = sorted(known)
    space = quality.Space(counts_of([texts[i] for i in ids]), np.array([known[i] for i in ids], np.float64))
    latent = space.latent(counts_of([texts[i] for i, _ in docs])).astype(np.float64)
    for (i, _), x in zip(docs, latent, strict=True):
        near = sorted(((float(x @ v), k) for k, v in enumerate(space.vectors.astype(np.float64))), reverse=True)[: quality.NEIGHBOURS]
        weight = [max(s, 0) ** quality.POWER for s, _ in near]
        want = sum(w * space.labels[k] for w, (_, k) in zip(weight, near, strict=True)) / sum(weight)
        assert abs(got[i] - want) < 2e-3


def test_ties_for_the_last_place_share_it():
    texts = ["one two three."] * 40 + ["A B! C D?"] * 3
    space = quality.Space(counts_of(texts), np.array([1, 0] * 20 + [0] * 3, np.float64))
    raw, offsets = shared.string_buffer(pa.array(["one two three."]))
    assert abs(space.scores(raw, offsets)[0] - 0.5) < 1e-6


def plain_ftrl(examples, labels, seed=73):
    """Per-coordinate FTRL-proximal, one feature at a time."""
    z, n, rate = {}, {}, min(max(sum(labels) / len(labels), 1e-3), 1 - 1e-3)
    bias, bias_n = math.log(rate / (1 - rate)), 1.0
    rng = np.random.default_rng(seed)

    def weight(f):
        if abs(z.get(f, 0.0)) <= toxicity.L1:
            return 0.0
        return (math.copysign(toxicity.L1, z[f]) - z[f]) / ((toxicity.BETA + math.sqrt(n[f])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for i in rng.permutation(len(examples)):
            w = {f: weight(f) for f in examples[i]}
            g = 1 / (1 + math.exp(-(sum(w.values()) + bias))) - labels[i]
            for f in examples[i]:
                before = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / toxicity.ALPHA * w[f]
                n[f] = before + g * g
            bias -= 0.1 * toxicity.ALPHA * g / (toxicity.BETA + math.sqrt(bias_n))
            bias_n += g * g
    return {f: w for f in z if (w := weight(f))}, bias


def features_of(text):
    raw, offsets = shared.string_buffer(pa.array([text]))
    return sorted(set(toxicity.features(Words(raw, offsets, MARKS))[0].tolist()))


def test_toxicity_is_plain_ftrl(spark):
    docs, labels = labelled(32, 220)
    known = {i: t for i, _, t in labels if i < 160}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(df, spark.createDataFrame(list(known.items()), "doc_id long, toxic int")).collect()}
    texts = dict(docs)
    weights, bias = plain_ftrl([features_of(texts[i]) for i in sorted(known)], [known[i] for i in sorted(known)])
    assert len(weights) > 3
    for i, t in docs:
        assert abs(got[i] - 1 / (1 + math.exp(-(bias + sum(weights.get(f, 0) for f in features_of(t)))))) < 1e-6


def test_toxicity_sample_is_bounded_in_bytes(spark, monkeypatch):
    docs, labels = labelled(33, 200)
    df, marks = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, t) for i, _, t in labels], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 4000)
    assert toxicity.toxicity_scores(df, marks).filter("score >= 0 and score <= 1").count() == 200
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 0)
    assert {r.score for r in toxicity.toxicity_scores(df, marks).collect()} == {0.5}


def test_labelled_rows_that_repeat_count_once(spark):
    df = spark.createDataFrame([(1, "b")] * 50 + [(1, "a"), (2, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert sorted(map(tuple, quality.labelled_sample(df, labels, "quality", 10, 5).collect())) == [(1, "a", 1), (2, "c", 0)]


@pytest.mark.parametrize("turn_bytes", [1 << 20, 300])
def test_decontamination_goes_row_by_row(spark, monkeypatch, turn_bytes):
    monkeypatch.setattr(decontaminate, "PATTERN_BYTES", turn_bytes)
    monkeypatch.setattr(decontaminate, "ITEM_WORDS", 20)
    rng = random.Random(34)
    items = [" ".join(words(rng, n)) for n in (13, 90, 4)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    clean = " ".join(words(rng, 50))
    late = " ".join(items[1].split()[60:74])
    rows = [(None, items[0], 1), (None, clean, 2), (5, clean, 3), (5, items[1], 4), (6, late + " x", 5), (7, None, 6), (8, items[2], 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(2)
    kept = decontaminate.decontaminated(df, bench)
    assert kept.columns == df.columns and sorted(r.runs for r in kept.collect()) == [2, 3, 6]
    hits = {r.doc_id: [tuple(x) for x in r.runs] for r in decontaminate.overlaps(df.filter("doc_id > 5"), bench).collect()}
    assert hits == {6: [(0, 14)], 7: [], 8: [(0, 4)]}


def test_duplicates_without_ids_of_their_own(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(None, a, 1), (3, a, 2), (3, a, 3), (None, b, 4), (None, b, 5), (4, "", 6), (4, None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int")
    kept = minhash.deduplicated(df)
    ids = sorted(r.id for r in kept.collect())
    assert kept.columns == df.columns and len(ids) == 4 and ids[0] in (2, 3) and ids[1] in (4, 5) and ids[2:] == [6, 7]


def test_tables_on_the_way_are_deleted(spark, tmp_path):
    folder = shared.scratch(spark).removeprefix("file://")
    had = set(os.listdir(folder)) if os.path.exists(folder) else set()
    df = odd_docs(spark).select("doc_id", "text")
    out = shared.kept(spark, lambda: minhash.near_duplicates(df), "outer")
    assert out.count() == df.count() and {x.split("-")[0] for x in set(os.listdir(folder)) - had} == {"outer"}
    with pytest.raises(ZeroDivisionError):
        shared.kept(spark, lambda: shared.written(df, "inner") and 1 / 0, "never")
    assert len(set(os.listdir(folder)) - had) == 1
    shared.dropped(out)
    assert set(os.listdir(folder)) == had


def test_pipeline_of_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some text, of words.", "en", "a", 20)], "doc_id long, text string, lang string, source string, n_chars long")
    labels, bench = spark.createDataFrame([], "doc_id long, quality int, toxic int"), spark.createDataFrame([], "item_id long, text string")
    for name, some in (("none", docs.limit(0)), ("some", docs)):
        folder = tmp_path / name
        for t, df in (("documents", some), ("labels", labels), ("benchmark", bench)):
            df.write.parquet(str(folder / f"{t}.parquet"))
        assert corpus_pipeline.run(spark, str(folder)).count() == some.count()


def test_pipeline_with_clashing_columns(spark, tmp_path):
    rows = [(i, f"some text number {i}, of words, and more of them.", "en", "a", 20, 1, "x", 2, None) for i in range(12)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _gone int, _text string, component_id int, _was string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "not there")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, str(tmp_path))
        assert out.columns == docs.columns
        out = shared.written(out, name)
    assert sorted(r.doc_id for r in out.collect()) == list(range(12))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 12


def test_clusters_need_a_shared_folder(spark, monkeypatch):
    class Bare:
        class conf:  # noqa: N801
            get = staticmethod(lambda name, other=None: other)

        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError):
        shared.scratch(Bare)
