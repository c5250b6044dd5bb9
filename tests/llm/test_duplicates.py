"""Near-duplicates, components, embeddings and suffixes against brute force."""

import hashlib
import importlib
import random

import numpy as np
import pytest
from helpers import ODD, odd_docs, spaced, union_find, words

from facetlake.llm import embeddings, minhash, suffix
from facetlake.llm.components import components


def shingles(text, size):
    w = spaced(text)
    return set() if not w else {tuple(w)} if len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def jaccard_links(sets, up, down):
    ids = sorted(i for i in sets if sets[i])
    for a in ids:
        for b in ids:
            if a < b:
                both = len(sets[a] & sets[b])
                if down * both >= up * (len(sets[a]) + len(sets[b]) - both):
                    yield a, b


def family_docs(seed):
    rng = random.Random(seed)
    vocabulary = words(rng, 4000)
    docs = []
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([40, 120, 240]))]
        for _ in range(25):
            x = list(base)
            for _ in range(int(len(x) * rng.choice([0, 0.01, 0.03, 0.05, 0.08]))):
                x[rng.randrange(len(x))] = rng.choice(vocabulary)
            docs.append(" ".join(x))
    rng.shuffle(docs)
    return [*docs, docs[3].upper(), docs[5], "one", "one two", "one two", "", None]


@pytest.mark.parametrize("block,size,threshold", [(4096, 3, (85, 100)), (6, 5, (4, 5))])
def test_near_duplicates(spark, monkeypatch, block, size, threshold):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "FAMILY", block)
    docs = family_docs(block)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    sets = {i: shingles(t, size) for i, t in enumerate(docs)}
    comp = union_find(sets, jaccard_links(sets, *threshold))
    got = {r.doc_id: tuple(r)[1:] for r in minhash.near_duplicates(df, size, threshold).collect()}
    assert got == {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


def test_big_groups_are_spread(spark, monkeypatch):
    """One text very often, one hub of near texts, and components of it, all beyond the bound of a big key."""
    monkeypatch.setattr(importlib.import_module("facetlake.llm.shared"), "BIG", 5)
    monkeypatch.setattr(importlib.import_module("facetlake.llm.components"), "SMALL", 0)
    rng = random.Random(21)
    base = words(rng, 120)
    docs = ["copy of one text, very often"] * 40
    for _ in range(60):
        x = list(base)
        x[rng.randrange(len(x))] = "changed" + str(rng.randrange(10**6))
        docs.append(" ".join(x))
    docs += [" ".join(words(rng, 30)) for _ in range(20)]
    rows = list(enumerate(docs))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = {i: shingles(t, 5) for i, t in rows}
    comp = union_find(sets, jaccard_links(sets, 4, 5))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    assert got == comp and len(set(comp.values())) == 22


def test_meetings_bring_the_few_to_all(spark):
    rng = random.Random(22)
    rows = [(g, 100 * g + i, 0 if rng.random() < 0.8 else rng.randint(1, 3)) for g in range(6) for i in range(rng.randint(1, 40))]
    df = spark.createDataFrame(rows, "g long, id long, comp long")
    met, total = minhash.meetings(df, "g", 7, "test")
    got = met.toPandas()
    assert len(got) == total
    pairs = {}
    for _, block in got.groupby(["g", "x", "y"]):
        assert len(block) < 60
        block = block.sort_values(["role", "id"])
        sig = np.zeros((len(block), 4), np.uint16)
        cols = [block[c].to_numpy() for c in ("g", "x", "y", "role", "few", "id", "comp")]
        for i, j in minhash.close_pairs(*cols, sig, 2):
            for a, b in zip(cols[5][i].tolist(), cols[5][j].tolist()):
                pairs[min(a, b), max(a, b)] = pairs.get((min(a, b), max(a, b)), 0) + 1
    want = {(i, j): 1 for g, i, c in rows for h, j, d in rows if g == h and i < j and c != d}
    assert pairs == want


def test_near_duplicates_odd(spark):
    df = odd_docs(spark)
    out = minhash.near_duplicates(df).collect()
    assert len(out) == df.count()
    by = {r.doc_id: r for r in out}
    assert by[0].kept and by[1].kept and by[3].component_id == by[4].component_id == 3 and by[None].kept
    assert minhash.deduplicated(df).columns == df.columns
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    clash = spark.createDataFrame([(1, "a b c d e f"), (1, "z y x w v u"), (2, "a b c d e f")], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(clash).collect()) == [(1, 1), (1, 1), (2, 1)]


def test_signature_distance_bounds_the_miss():
    for t in (0.8, 0.85, 0.95):
        m = minhash.chunks(t)
        rng = np.random.default_rng(1)
        far = (rng.random((20000, m * minhash.CHUNK)) > t).sum(axis=1) > 2 * m - 1
        assert far.mean() < 0.002


@pytest.mark.parametrize("small", [0, 50_000])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr(importlib.import_module("facetlake.llm.components"), "SMALL", small)
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(150)] + [(400, 400)]
    want = union_find({i for e in links for i in e}, links)
    df = spark.createDataFrame([*links, (None, 5)], "u long, v long")
    assert {r.id: r.component_id for r in components(df).collect()} == {i: c for i, c in want.items() if i != c}
    assert components(df.limit(0)).count() == 0


def vector_rows():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((30, 16))
    x = np.concatenate([centres[rng.integers(0, 30, 500)] + 0.2 * rng.standard_normal((500, 16)), np.repeat(centres[:1], 120, axis=0) + 0.01 * rng.standard_normal((120, 16))]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    return [*rows, (900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0] * 15 + [float("inf")]), (904, [1.0] * 15 + [None]), (905, []), (906, [1.0, 2.0]), (907, [2.0, 4.0])]


@pytest.mark.parametrize("block,piece", [(4096, 256), (50, 16)])
def test_near_vectors(spark, monkeypatch, block, piece):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "PIECE", piece)
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    good = {i: np.array(v, np.float64) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    cos = lambda a, b: a @ b / np.sqrt((a @ a) * (b @ b))
    links = [(i, j) for i, a in good.items() for j, b in good.items() if i < j and len(a) == len(b) and cos(a, b) >= 0.95]
    comp = union_find([i for i, _ in rows], links)
    n = {i: 0 for i, _ in rows}
    for i, j in links:
        n[i] += 1
        n[j] += 1
    got = {r.vec_id: tuple(r)[1:] for r in embeddings.near_vectors(df).collect()}
    assert len(links) > 5000 and got == {i: (n[i], comp[i], comp[i] == i) for i, _ in rows}


def test_near_vectors_odd(spark):
    schema = "vec_id long, embedding array<double>, u string, id long"
    df = spark.createDataFrame([(1, [1.0, 0.0], "x", 1), (1, [1.0, 0.0], "x", 2), (2, [2.0, 0.1], None, 3), (None, [1.0, 0.0], "", 4)], schema)
    assert sorted(((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df).collect()), key=str) == [(-1, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False)]
    assert embeddings.near_vectors(df.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, [0.0]), (2, None)], "vec_id long, embedding array<float>")
    assert [r.n_links for r in embeddings.near_vectors(nothing).collect()] == [0, 0]


def test_copies_are_joined_as_one(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BIG", 40)
    rng = np.random.default_rng(8)
    a, b, c = rng.standard_normal((3, 12))
    rows = [(i, (a if i % 2 else b if i % 3 else c + 1e-3 * i).tolist()) for i in range(200)] + [(500, (a * 2).tolist()), (501, (-a).tolist())]
    got = {r.vec_id: tuple(r)[1:] for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    ids = [i for i, _ in rows]
    comp = union_find(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(link), strict=True)])
    assert got == {ids[k]: (int(link[k].sum()), comp[ids[k]], comp[ids[k]] == ids[k]) for k in range(len(ids))}


def test_partners_are_all_near_segments(spark):
    rng = np.random.default_rng(9)
    lo = rng.uniform(-1, 1, (40, 3))
    hi = lo + rng.uniform(0, 0.4, (40, 3))
    boxes = spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(lo, hi, strict=True))], "seg long, lo array<double>, hi array<double>")
    got = {(r.i, r.j) for r in embeddings.partners(boxes, 0.3).collect()}
    gap = np.maximum(0, np.maximum(lo[:, None] - hi[None], lo[None] - hi[:, None]))
    want = {(i, j) for i in range(40) for j in range(i, 40) if (gap[i, j] ** 2).sum() <= 0.09}
    assert got == want and len(want) < 820


def test_bounds_hold_and_blocks_are_skipped():
    rng = np.random.default_rng(10)
    centres = rng.standard_normal((60, 32))
    x = centres[rng.integers(0, 60, 3000)] + 0.02 * rng.standard_normal((3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    axes = np.linalg.svd(x[:500] - x[:500].mean(axis=0), full_matrices=False)[2][:8].T
    p = embeddings.placed(x, axes)
    assert (p[:300] @ p[300:600].T >= x[:300] @ x[300:600].T - 1e-12).all()
    x = x[np.lexsort(np.floor(x @ axes / np.sqrt(0.1)).T[::-1])]
    j = embeddings.Joiner(axes, 0.95)
    n, _, _ = j.join(x, None)
    assert n.tolist() == ((x @ x.T >= 0.95).sum(axis=1) - 1).tolist() and j.skipped > 0


def test_joiner_skips_nothing():
    rng = np.random.default_rng(7)
    x = rng.standard_normal((400, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :4]
    x = x[np.lexsort(np.floor(x @ axes / 0.3).T[::-1])]
    j = embeddings.Joiner(axes, 0.9)
    na, nb, _ = j.join(x[:150], x[150:])
    assert na.tolist() == (x[:150] @ x[150:].T >= 0.9).sum(axis=1).tolist() and nb.sum() == na.sum()


def brute_removal(rows, length):
    seen, out = set(), {}
    for i, t in sorted((i, (t or "").encode()) for i, t in rows):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            s = t[k : k + length]
            if s in seen:
                gone[k : k + length] = True
            seen.add(s)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out[i] = (len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def passage_docs(seed):
    rng = random.Random(seed)
    passages = [" ".join(words(rng, n)) for n in (12, 20, 60, 200)]
    docs = []
    for _ in range(60):
        parts = [" ".join(words(rng, rng.randint(0, 80)))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), "é" * rng.randint(0, 3), " ".join(words(rng, rng.randint(0, 15)))]
        docs.append(" ".join(parts))
    return [*docs, docs[0], docs[1], "ab" * 300, "x" * 1000, None, "", "x" * 99, "x" * 100]


@pytest.mark.parametrize("length,hot", [(100, 20_000), (30, 20_000), (30, 1)])
def test_suffix_removal(spark, monkeypatch, length, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    monkeypatch.setattr(suffix, "ROUND", 3000)
    monkeypatch.setattr(suffix, "STEP", 1000)
    monkeypatch.setattr(suffix, "SHARD", 900)
    rows = list(enumerate(passage_docs(length)))
    rng = random.Random(8)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.doc_id: tuple(r)[1:] for r in suffix.digest(df, length).collect()} == brute_removal(rows, length)


@pytest.mark.parametrize("hot", [1, 20_000])
def test_suffix_removal_over_many_blocks(spark, monkeypatch, hot):
    for name, value in {"HOT": hot, "BLOCK": 2000, "GROUP": 5000, "BUNDLE": 700, "SHARD": 400, "FAN": 2, "BLOCKS": 1}.items():
        monkeypatch.setattr(suffix, name, value)
    rows = list(enumerate(passage_docs(7)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: tuple(r)[1:] for r in suffix.digest(df, 40).collect()} == brute_removal(rows, 40)


def test_long_texts_are_read_in_pieces(monkeypatch):
    rng = random.Random(12)
    texts = [bytes(rng.choice(b"abc") for _ in range(n)) for n in (5, 4000, 0, 90, 2500, 40)]
    raw, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    whole = np.concatenate(list(suffix.rounds(raw, offsets, 20)))
    monkeypatch.setattr(suffix, "STEP", 300)
    monkeypatch.setattr(suffix, "ROUND", 1000)
    parts = list(suffix.rounds(raw, offsets, 20))
    assert len(parts) > 3

    def strings(found):
        return sorted((int(r["row"]), int(r["lo"]) + k, int(r["fp"]), int(r["lo"]) + int(r["at"])) for r in found for k in range(int(r["more"]) + 1))

    assert strings(np.concatenate(parts)) == strings(whole)
    assert [x[:2] for x in strings(whole)] == [(i, k) for i, t in enumerate(texts) for k in range(len(t) - 19)]


def test_leaders_are_told_by_their_bytes():
    raw = np.frombuffer(b"abcabcabdabc", np.uint8)
    start, size = np.array([0, 3, 6, 9]), np.full(4, 3)
    got = suffix.leaders(raw, start, size, np.zeros(4, np.uint64), np.array([7, 3, 9, 3]), np.array([0, 5, 0, 2]))
    assert got.tolist() == [False, False, True, True]
    assert suffix.same_bytes(raw, start[:0], start[:0], size[:0]).tolist() == []


def test_length_is_checked(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for length in (1, 65_001):
        with pytest.raises(ValueError):
            suffix.digest(df, length)


def test_merged_transforms_against_brute_force():
    rng = random.Random(9)
    for _ in range(25):
        length = rng.choice([5, 6, 8, 10, 16])
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(length, 40))) for _ in range(rng.randint(1, 12))]
        texts += texts[:2]
        t, p, g = suffix.repeated(texts, length, shard=rng.choice([30, 100, 10000]))
        got, want = {}, {}
        for a, b, c in zip(t.tolist(), p.tolist(), g.tolist(), strict=True):
            got.setdefault(c, set()).add((a, b))
        for a, x in enumerate(texts):
            for b in range(len(x) - length + 1):
                want.setdefault(x[b : b + length], set()).add((a, b))
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
        order, first = None, None
        assert sorted(g.tolist()) == g.tolist()  # classes stand in the order of the suffixes


def test_suffix_odd(spark):
    df = odd_docs(spark)
    out = suffix.digest(df).collect()
    assert len(out) == df.count()
    by = {r.doc_id: r for r in out}
    long_ = ODD.index("x" * 70_000)
    assert by[long_].n_removed == 70_000 - 1 and by[0].n_bytes == 0
    assert suffix.digest(df.limit(0)).count() == 0
    cut = suffix.cut_texts(df.withColumnRenamed("size", "n_chars"))
    assert cut.columns == df.withColumnRenamed("size", "n_chars").columns and cut.count() == df.count()
    assert {len(r.text) for r in cut.filter(f"doc_id = {long_}").collect()} == {1}


def test_cut_keeps_characters_whole(spark):
    shared = "".join(chr(0xC0 + i) for i in range(64))
    df = spark.createDataFrame([(1, "a" + shared, 0), (2, "日" + shared + "ü", 0), (3, "日" + shared[1:], 0)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in suffix.cut_texts(df).collect()}
    assert got[1].text == "a" + shared and got[2].text == "日ü" and got[2].n_chars == 2
    # The string of 100 bytes that begins with the last byte of the first character leaves it whole.
    assert got[3].text == "日"
