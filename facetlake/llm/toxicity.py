"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words count in full and by their first bytes, so that forms of one stem share a feature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.llm.quality import labelled_sample
from facetlake.llm.shared import dropped, row_blocks, string_buffer, text_columns, written
from facetlake.llm.textkit import MARKS, Words, mix, randoms

#: Labelled rows, at most, from which is learnt; the choice follows a seeded hash of doc_id.
SAMPLE = 8000
#: Bytes of their features, at most, 4 for each that a document has; beyond, the first documents by that hash stay.
SAMPLE_BYTES = 96 << 20
#: Hashed features; rate, its offset, and the two penalties; passes over the sample.
BITS, ALPHA, BETA, L1, L2, EPOCHS = 20, 3.0, 1.0, 6.0, 0.0, 4
#: Bytes of a word that stand for its stem.
STEM = 5
STEP = 1 << 19
_KIND = randoms(71, 4)


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Feature and row of every word, stem, pair of neighbours and pair with one word between."""
    h, rows = words.hashes(), words.rows()
    stems = words.hashes(most=STEM)
    out, at = [mix(h + _KIND[0]), mix(stems + _KIND[3])], [rows, rows]
    for gap in (1, 2):
        if len(h) > gap:
            same = rows[gap:] == rows[:-gap]
            out.append(mix(h[:-gap] * (_KIND[2] | np.uint64(1)) + h[gap:] + _KIND[gap + 1])[same])
            at.append(rows[gap:][same])
    return (np.concatenate(out) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(at)


class Model:
    """Weights that FTRL-proximal left different from 0, ascending by feature, and a bias."""

    def __init__(self, examples: list[np.ndarray], labels: np.ndarray, seed: int = 73):
        z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        rate = min(max(float(labels.mean()) if len(labels) else 0.5, 1e-3), 1 - 1e-3)
        bias, bias_n = float(np.log(rate / (1 - rate))), 1.0
        rng = np.random.default_rng(seed)
        for _ in range(EPOCHS if 0 < labels.sum() < len(labels) else 0):
            for i in rng.permutation(len(examples)):
                x = examples[i]
                zx, nx = z[x], n[x]
                root = np.sqrt(nx)
                w = np.where(np.abs(zx) <= L1, 0, (np.sign(zx) * L1 - zx) / ((BETA + root) / ALPHA + L2))
                g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - labels[i]
                z[x] += g - (np.sqrt(nx + g * g) - root) / ALPHA * w
                n[x] += g * g
                bias -= 0.1 * ALPHA * g / (BETA + np.sqrt(bias_n))
                bias_n += g * g
        w = np.where(np.abs(z) <= L1, 0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))
        self.at = np.flatnonzero(w)
        self.weights, self.bias = w[self.at], bias

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        used = np.zeros(1 << BITS, bool)
        used[self.at] = True
        f, at = features(Words(raw, offsets, MARKS))
        hit = used[f]
        each = np.unique(at[hit] * (1 << BITS) + f[hit])
        at, f = each >> BITS, each & ((1 << BITS) - 1)
        total = np.bincount(at, self.weights[np.searchsorted(self.at, f)], rows) if len(f) else np.zeros(rows)
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -35, 35)))


def fitted(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE, seed: int = 9) -> Model:
    """The model of a bounded sample of labelled documents."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_buffer(batch.column(1))
            for a, b in row_blocks(offsets, STEP):
                f, at = features(Words(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], MARKS))
                each = np.unique(at * (1 << BITS) + f)
                ends = np.searchsorted(each, np.arange(b - a + 1) << BITS)
                f = (each & ((1 << BITS) - 1)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array([f[s:e].tobytes() for s, e in zip(ends, ends[1:], strict=False)], pa.binary())], ["doc_id", "label", "x"])

    found = written(labelled_sample(docs, labels, label, sample, seed).mapInArrow(extract, "doc_id long, label int, x binary").withColumn("h", F.xxhash64(F.lit(seed), "doc_id")), "features")
    sizes = sorted(map(tuple, found.select("h", F.octet_length("x")).collect()))
    fits = np.searchsorted(np.cumsum([n for _, n in sizes]), SAMPLE_BYTES, "right")
    rows = found.filter(F.col("h") <= sizes[fits - 1][0]).collect() if fits else []
    dropped(found)
    rows = sorted((r[0], r[1], bytes(r[2])) for r in rows)
    return Model([np.frombuffer(x, np.uint32).astype(np.int64) for _, _, x in rows], np.array([y for _, y, _ in rows], np.float64))


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, threshold: float = 0.3) -> DataFrame:
    """A row for each row of docs (doc_id, text): doc_id, score, predicted.

    labels (doc_id, and `label`, 0 or 1) are learnt from as given; keep the rows to be judged out of them.
    score: the probability of label 1; a text without known features has that of the bias alone. A feature
    counts once in a text, however often it stands there.
    Nulls: a null text counts as empty, null labels and ids are not learnt from, a null doc_id stays null.
    Of contradicting labels of a document the least holds, and of repeated rows of a labelled one the least text; with
    labels of one kind only, or none, every score is their share, or 0.5. A text, however long, counts whole; nothing is
    chosen by rank, so there are no ties. Repeated rows each give a row; other columns are ignored; an empty table
    gives an empty one.
    """
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, label, sample))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_buffer(batch.column(1))
            for a, b in row_blocks(offsets, STEP):
                s = model.value.scores(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return text_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double, predicted int")
