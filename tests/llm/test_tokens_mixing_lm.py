"""Token counts, mixing and language-model scores."""

import random

import numpy as np
import public_tokenizers
import pytest
from helpers import ODD, odd_docs, spaced, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from facetlake.llm import lm, mixing, tokens


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_are_the_librarys(spark, name):
    rng = random.Random(1)
    texts = [*ODD, "a\x1cb \x1d c", "<|endoftext|>hi <|startoftext|>x", "it's we'll 1234 !!??", " ".join(words(rng, 3000)), "ΑΣ ΣΣ́ é"]
    path = public_tokenizers.path(name)
    if name.endswith("json"):
        t = Tokenizer.from_file(path)
        want = [len(t.encode(x or "", add_special_tokens=False)) for x in texts]
    else:
        from sentencepiece import SentencePieceProcessor

        t = SentencePieceProcessor(model_file=path)
        want = [len(t.encode(x or "")) for x in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in tokens.token_counts(df, name).collect()}
    assert [got[i].n_tokens for i in range(len(texts))] == want
    assert [got[i].n_bytes for i in range(len(texts))] == [len((x or "").encode()) for x in texts]
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got.values())


def test_long_text_is_cut_safely():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) + rng.choice(["", "", ",", "7"]) for _ in range(4000))
    parts = tokens.cut(text, 500)
    assert "".join(parts) == text and len(parts) > 10
    assert sum(len(t.encode(p, add_special_tokens=False)) for p in parts) == len(t.encode(text, add_special_tokens=False))


def test_tokens_odd_and_empty(spark):
    df = odd_docs(spark)
    assert tokens.token_counts(df).count() == df.count()
    assert tokens.token_counts(df.limit(0)).count() == 0


def test_targets():
    t = mixing.targets([("b", 10), (None, 100), ("a", 100)], (5, 2, 1))
    assert set(t) == {"a", "b", None}
    assert t["b"] == 30 and abs(sum(t.values()) - 210) < 1e-9 and abs(t["a"] / t[None] - 5) < 1e-9
    assert mixing.targets([], (1,)) == {} and mixing.targets([("a", 0)], (1,)) == {"a": 0}
    assert mixing.targets([("a", 5), ("b", 0)], (1, 1)) == {"b": 0, "a": 5}


def test_subset_sum_against_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        lengths = np.array(sorted(rng.sample(range(1, 30), rng.randint(1, 6))))
        counts = np.array([rng.randint(1, 3) for _ in lengths])
        reach = {0}
        for s, c in zip(lengths.tolist(), counts.tolist(), strict=True):
            reach = {r + k * s for r in reach for k in range(c + 1)}
        budget = rng.randint(0, int((lengths * counts).sum()) + 5)
        got = mixing.subset(lengths, counts, budget)
        assert (got >= 0).all() and (got <= counts).all()
        total = int((got * lengths).sum())
        assert total <= budget and total in reach
        base = np.minimum(counts, counts * min(budget, int((lengths * counts).sum())) // int((lengths * counts).sum()))
        best = max(r for r in _reach(lengths, counts - base, int((base * lengths).sum())) if r <= budget)
        assert total == best


def _reach(lengths, counts, start):
    reach = {start}
    for s, c in zip(lengths.tolist(), counts.tolist(), strict=True):
        reach = {r + k * s for r in reach for k in range(c + 1)}
    return reach


def test_mixture(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(words(rng, rng.choice([0, 3, 50, 50, 50, 211, 997]))), rng.choice(["a", "b", "b", "b", "b", None])) for i in range(900)]
    rows += [(1000 + i, "same text here", "hot") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = mixing.mixture(df).collect()
    assert len(got) == len(rows) and sorted(map(tuple, got)) == sorted(map(tuple, mixing.mixture(df.repartition(3)).collect()))
    size = {i: len(spaced(t)) for i, t, _ in rows}
    by: dict = {}
    for r in got:
        assert r.size == size[r.doc_id] and r.taken == r.copies * r.size and 0 <= r.copies <= 3
        by.setdefault(r.source, []).append(r)
    goal = mixing.targets([(s, sum(r.size for r in x)) for s, x in by.items()], (5, 2, 1))
    for s, x in by.items():
        assert all(abs(r.target - goal[s]) < 1e-6 and r.source_size == sum(q.size for q in x) for r in x)
        assert abs(sum(r.taken for r in x) - goal[s]) <= 3  # equal sizes of 3 words are the finest step of "hot"


def test_mixture_odd_and_empty(spark):
    df = odd_docs(spark)
    assert mixing.mixture(df).count() == df.count() and mixing.mixture(df.limit(0)).count() == 0
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    assert [tuple(r) for r in mixing.mixture(one).select("size", "copies", "taken").collect()] == [(0, 0, 0)]


def test_lm_against_brute_force(spark):
    rng = random.Random(6)
    a, b = words(rng, 40), words(rng, 40)
    texts = [" ".join(rng.choice(a if i % 2 else b) for _ in range(rng.randint(0, 60))) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(i,) for i in range(1, 60, 4)] * 2 + [(None,)], "doc_id long")
    got = {r.doc_id: r for r in lm.cross_entropy_difference(df, target).collect()}

    def model(chosen):
        uni, bi, hist = {}, {}, {}
        for i in chosen:
            w = spaced(texts[i])
            for x in w:
                uni[x] = uni.get(x, 0) + 1
            for x in zip([None, *w], w):
                bi[x] = bi.get(x, 0) + 1
        for (before, _), c in bi.items():
            hist[before] = hist.get(before, 0) + c
        return uni, bi, hist

    models = model(range(1, 60, 4)), model(range(60))
    for i, t in enumerate(texts):
        w = spaced(t)
        assert got[i].n_tokens == len(w)
        if not w:
            assert got[i].score is None
            continue
        loss = []
        for uni, bi, hist in models:
            total, before = 0.0, None
            for x in w:
                p, c = (uni.get(x, 0) + 1) / (sum(uni.values()) + lm.WORDS), bi.get((before, x), 0)
                total -= np.log((c + lm.BACKOFF * p) / (hist.get(before, 0) + lm.BACKOFF))
                before = x
            loss.append(total / len(w))
        assert abs(got[i].target_loss - loss[0]) < 1e-6 and abs(got[i].background_loss - loss[1]) < 1e-6
    odd = [got[i].score for i in range(60) if i % 2 and got[i].score is not None]
    even = [got[i].score for i in range(60) if not i % 2 and got[i].score is not None]
    assert np.mean(odd) < np.mean(even)


def test_lm_estimates_after_a_history_sum_to_one(spark):
    rng = random.Random(16)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(40)]
    df = spark.createDataFrame([(t, i % 2 == 0) for i, t in enumerate(texts)], "text string, target boolean").repartition(3)
    answered = lm.answers(lm.requests(lm.blocked(df)))
    flat = [w for t in texts for w in t.split()]
    assert lm.sizes(answered) == (4, sum(len(t.split()) for t in texts[::2]), len(flat)) and lm.starts(answered) == (20, 40)
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    _, word, pair, last = lm.grams(raw, np.cumsum([0, *(len(t) for t in texts)]))
    before = [b for t in texts for b in [None, *t.split()][:-1]]
    uni, joint = ({x: flat.count(x) for x in "abcd"}, {x: [*zip(before, flat)].count(x) for x in zip(before, flat)})
    assert len(set(word.tolist())) == 4 and len(set(pair.tolist())) == len(joint) and last.sum() == 40
    for b in {*before}:
        seen = 40 if b is None else sum(x == b for x in before)
        assert b is None or seen == uni[b] - sum(t.split()[-1] == b for t in texts)
        p = [np.exp(-lm.losses(np.array([uni[w]]), np.array([seen]), np.array([joint.get((b, w), 0)]), len(flat), 4)[0]) for w in uni]
        assert abs(sum(p) - 1) < 1e-9


def test_lm_odd_and_empty(spark):
    df = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long")
    assert lm.cross_entropy_difference(df, none).count() == df.count()
    assert lm.cross_entropy_difference(df.limit(0), none).count() == 0
    assert lm.cross_entropy_difference(df, df.select("doc_id")).filter("n_tokens > 0 and score is null").count() == 0


def test_lm_counts_add_up_over_many_tasks(spark):
    df = spark.range(0, 80, 1, 40).select(F.lit("one two three").alias("text"), (F.col("id") % 2 == 0).alias("target"))
    total = lm.counts(df)
    assert total[:, : lm.WORDS].sum(axis=1).tolist() == [120, 240]


def test_lm_counts_exactly_beyond_the_least_vocabulary(spark):
    texts = [" ".join(f"w{i * 6000 + k}" for k in range(6000)) + " common words" * (i % 3) for i in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    target = spark.createDataFrame([(0,), (1,)], "doc_id long")
    got = {r.doc_id: r for r in lm.cross_entropy_difference(df, target).collect()}
    uni, bi, hist = {}, {}, {}
    for t in texts:
        for b, w in zip([None, *t.split()], t.split()):
            uni[w], bi[b, w], hist[b] = uni.get(w, 0) + 1, bi.get((b, w), 0) + 1, hist.get(b, 0) + 1
    assert len(uni) > lm.WORDS and hist[None] == 50
    for i, t in enumerate(texts):
        p = [((uni[w] + 1) / (sum(uni.values()) + len(uni)), bi[b, w], hist[b]) for b, w in zip([None, *t.split()], t.split())] if i < 3 else []
        if p:
            assert abs(got[i].background_loss + np.mean([np.log((c + lm.BACKOFF * q) / (n + lm.BACKOFF)) for q, c, n in p])) < 1e-9


def test_lm_scores_blocks_that_a_scan_splits(spark, monkeypatch):
    rng = random.Random(8)
    df = spark.createDataFrame([(i, " ".join(words(rng, 30, 50))) for i in range(300)], "doc_id long, text string").repartition(3)
    target = df.filter("doc_id % 3 = 0").select("doc_id")
    whole = {r.doc_id: tuple(r) for r in lm.cross_entropy_difference(df, target).collect()}
    monkeypatch.setattr(lm, "blocked", lambda docs, f=lm.blocked: f(docs).repartition(7).sortWithinPartitions("block", "row"))
    got = {r.doc_id: tuple(r) for r in lm.cross_entropy_difference(df, target).collect()}
    assert len(got) == 300 and all(np.allclose(got[i], whole[i]) for i in whole)


def test_subset_sum_of_few_long_documents():
    assert mixing.subset(np.array([99_000, 101_000, 150_000]), np.array([1, 1, 1]), 200_000).tolist() == [1, 1, 0]
    rng = random.Random(9)
    for _ in range(30):
        lengths = np.array(sorted(rng.sample(range(40_000, 200_000), rng.randint(2, 7))))
        counts = np.array([rng.randint(1, 2) for _ in lengths])
        whole = int((lengths * counts).sum())
        budget = rng.randint(whole // 3, whole)
        base = counts * budget // whole
        got = mixing.subset(lengths, counts, budget)
        assert (got >= base).all() and (got <= counts).all()
        assert int((got * lengths).sum()) == max(r for r in _reach(lengths, counts - base, int((base * lengths).sum())) if r <= budget)
