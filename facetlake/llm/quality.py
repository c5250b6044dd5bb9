"""Quality scores by votes of the nearest labelled documents in a latent-semantic space.

Terms of a text are trigrams of byte classes (small and capital letters, digits, white
space, each mark) and repetitions of words, so that they speak of a text's form in any
language. Labelled documents give a weighted term matrix whose truncated singular value
decomposition spans the latent space. Their vectors are broadcast, every document is
compared with all of them in blocks of exact cosine products, and the nearest vote with
their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.llm.shared import bounded, row_blocks, string_buffer, text_columns
from facetlake.llm.textkit import SPACES, Words, mix, randoms

#: Labelled rows, at most, from which the space and the voters come; the choice follows a seeded hash of doc_id.
SAMPLE = 6000
#: Hashed trigrams; latent dimensions; voters of a document; power of a similarity as a weight.
TRIGRAMS, DIMENSIONS, NEIGHBOURS, POWER = 2048, 48, 25, 8
#: Terms for repeated words: equal to the one before, to the one two before, and to both.
TERMS = TRIGRAMS + 3
REPEAT_WEIGHT = 3.0
STEP = 1 << 19


def _classes() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    out[97:123], out[65:91], out[48:58], out[128:] = 1, 2, 3, 4
    return out


_CLASS = _classes()


def _slots() -> np.ndarray:
    """Term of each trigram of classes; made in small parts, as every Python worker holds what that takes."""
    out = np.empty((128, 128 * 128), np.int16)
    trigrams = np.arange(128 * 128, dtype=np.uint64) + randoms(51, 1)[0]
    for c in range(128):
        out[c] = mix(trigrams + np.uint64(c << 14)) % np.uint64(TRIGRAMS)
    return out.ravel()


_SLOT = _slots()


def term_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Relative counts of the terms of each row."""
    n = len(offsets) - 1
    out = np.zeros((n, TERMS), np.float32)
    if len(raw) >= 3:
        c = _CLASS[raw]
        rows = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
        at = rows[:-2] * TRIGRAMS + _SLOT[(c[:-2] << 14) | (c[1:-1] << 7) | c[2:]]
        out[:, :TRIGRAMS] = np.bincount(at[rows[:-2] == rows[2:]], minlength=n * TRIGRAMS).reshape(n, TRIGRAMS)
        out[:, :TRIGRAMS] /= np.maximum(out[:, :TRIGRAMS].sum(axis=1, keepdims=True), 1)
    words = Words(raw, offsets, SPACES)
    if len(words) > 2:
        h, rows = words.hashes(), words.rows()
        one = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
        two = (h[2:] == h[:-2]) & (rows[2:] == rows[:-2])
        for k, at in enumerate((rows[1:][one], rows[2:][two], rows[2:][two & one[1:]])):
            out[:, TRIGRAMS + k] = REPEAT_WEIGHT * np.bincount(at, minlength=n) / np.maximum(words.counts, 1)
    return out


class Space:
    """Latent vectors of labelled documents and the way there for others."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, seed: int = 61):
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        if not len(labels):
            return
        self.idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
        terms = self.weighted(counts)
        k = min(DIMENSIONS, *terms.shape)
        basis = np.random.default_rng(seed).standard_normal((terms.shape[1], k + 8)).astype(np.float32)
        for _ in range(4):
            basis = np.linalg.qr(terms.T @ (terms @ basis))[0]
        _, _, right = np.linalg.svd(terms @ basis, full_matrices=False)
        self.axes = (basis @ right[:k].T).astype(np.float32)
        self.vectors = self.latent(counts)

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        out = np.sqrt(counts) * self.idf
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def latent(self, counts: np.ndarray) -> np.ndarray:
        out = self.weighted(counts) @ self.axes
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if not len(self.labels):
            return np.full(n, self.prior)
        near = self.latent(term_counts(raw, offsets)) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        similarity = np.take_along_axis(near, best, axis=1)
        weight = np.maximum(similarity, 0).astype(np.float64) ** POWER
        total, votes = weight.sum(axis=1), (weight * self.labels[best]).sum(axis=1)
        # Where documents tie for the last places, all of them share those.
        least = similarity.min(axis=1, keepdims=True)
        for r in np.flatnonzero((near == least).sum(axis=1) > (similarity == least).sum(axis=1)):
            tied = near[r] == least[r]
            places, one = (similarity[r] == least[r]).sum(), max(float(least[r, 0]), 0.0) ** POWER
            sure = similarity[r] > least[r]
            votes[r] = (weight[r] * self.labels[best[r]])[sure].sum() + one * places * self.labels[tied].mean()
        return np.where(total > 1e-9, votes / np.maximum(total, 1e-9), self.prior)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int, seed: int) -> DataFrame:
    """doc_id, text and label of at most `sample` labelled documents, the first by a seeded hash of doc_id; of repeated ids the least text."""
    own = labels.select(labels["doc_id"].cast("long").alias("_id"), labels[label].cast("int").alias("label")).dropna()
    own = own.groupBy("_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64(F.lit(seed), "_id"), "_id").limit(sample)
    texts = text_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(own), F.col("doc_id") == F.col("_id")).groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")


def fitted(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE, seed: int = 5) -> Space:
    """The space of a bounded sample of labelled documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_buffer(batch.column(1))
            for a, b in row_blocks(offsets, STEP):
                x = term_counts(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                at = [np.flatnonzero(r) for r in x]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array([i.astype(np.uint16).tobytes() for i in at], pa.binary()), pa.array([r[i].tobytes() for r, i in zip(x, at, strict=True)], pa.binary())], ["doc_id", "label", "at", "x"])

    rows = labelled_sample(docs, labels, label, sample, seed).mapInArrow(count, "doc_id long, label int, at binary, x binary").collect()
    rows = sorted({(r[0], r[1], bytes(r[2]), bytes(r[3])) for r in rows})[:sample]
    counts = np.zeros((len(rows), TERMS), np.float32)
    for i, (_, _, at, x) in enumerate(rows):
        counts[i, np.frombuffer(at, np.uint16)] = np.frombuffer(x, np.float32)
    return Space(counts, np.array([r[1] for r in rows], np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, threshold: float = 0.3) -> DataFrame:
    """A row for each row of docs (doc_id, text): doc_id, score, predicted.

    labels (doc_id, and `label`, 0 or 1) are learnt from as given; keep the rows to be judged out of them.
    score: the similarity-weighted share of label 1 among the nearest labelled documents; a text without
    terms, or near to none, has the share of label 1 in the sample, and 0.5 without any label.
    Nulls: a null text counts as empty, null labels and ids are not learnt from, a null doc_id stays null.
    Of contradicting labels of a document the least holds, and of repeated rows of a labelled one the least text. Labelled
    documents that tie for the last place of the nearest share it. A text, however long, counts whole. Repeated rows each
    give a row; other columns are ignored; an empty table gives an empty one.
    """
    known = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, label, sample))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_buffer(batch.column(1))
            for a, b in row_blocks(offsets, STEP):
                s = known.value.scores(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                s = np.clip(s, 0, 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return text_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, threshold: float = 0.3) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores at least threshold; quality_scores() row by row."""
    bounded(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, label, sample))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_buffer(batch.column(at))
            for a, b in row_blocks(offsets, STEP):
                s = known.value.scores(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield batch.slice(a, b - a).filter(pa.array(s >= threshold))

    return docs.mapInArrow(keep, docs.schema)


def fold(column: str, folds: int):
    """Remainder of the CRC-32 of an id as text."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds
