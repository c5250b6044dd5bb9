"""Cross-entropy difference of two matched n-gram models.

The target model is counted over chosen documents, the background model over all. Both are
bigram models that back off to unigrams, with a count for every distinct word and pair of the
corpus, and of every word as a history, where another follows it, so that the estimates after each history sum to one over the shared vocabulary; grams
are told apart by 63-bit hashes, of which two among 10**9 meet with a chance of one in twenty.

Documents are dealt into blocks of text. A block asks for its distinct grams, with its own
counts of them, in shards by hash; a shard adds up the counts of all blocks and answers each in
the order of its request, so that neither a block nor a shard grows with the corpus: there are
more of both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from facetlake.llm.shared import few, row_blocks, string_buffer, text_columns, written
from facetlake.llm.textkit import SPACES, Words, mix, randoms

#: Least vocabulary that the smoothing spreads over; a corpus of more distinct words counts its own. Weight of the unigrams in a bigram's estimate.
WORDS, BACKOFF = 1 << 18, 50.0
#: Bytes of a block, each row as ROW more; blocks to a shard.
BLOCK, ROW, BLOCKS = 8 << 20, 64, 2
STEP = 1 << 21
_PAIR = randoms(81, 2) | np.uint64(1)
_ONE = np.uint64(1)


def grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words: rows, word keys (even), pair keys (odd), and whether a word ends its row; the first of a row pairs with its start."""
    words = Words(raw, offsets, SPACES)
    h, rows = words.hashes(), words.rows()
    before = np.zeros_like(h)
    before[1:] = h[:-1]
    first = words.first[:-1][words.counts > 0]
    before[first] = 1
    last = np.zeros(len(h), bool)
    last[words.first[1:][words.counts > 0] - 1] = True
    return rows, h & ~_ONE, mix(before * _PAIR[0] + h * _PAIR[1]) | _ONE, last


def all_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """grams() of a column of any size, in steps."""
    raw, offsets = string_buffer(texts)
    parts = []
    for a, b in row_blocks(offsets, STEP):
        rows, *keys = grams(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        parts.append((rows + a, *keys))
    none = (np.zeros(0, np.int64), *[np.zeros(0, np.uint64)] * 2, np.zeros(0, bool))
    return tuple(np.concatenate(x) for x in zip(none, *parts, strict=True))


def packed(x: np.ndarray) -> bytes:
    """Counts, compressed, behind their number."""
    x = x.astype(np.int64)
    return len(x).to_bytes(8, "little") + pa.compress(x.tobytes(), codec="zstd", asbytes=True)


def unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(x[8:], int.from_bytes(x[:8], "little") * 8, codec="zstd", asbytes=True), np.int64)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each stands."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
    return keys[at], np.diff(np.append(at, len(keys)))


def blocked(docs: DataFrame) -> DataFrame:
    """docs, written, with a block for about every BLOCK bytes of text and the row's number in its task."""
    at = docs.columns.index("text")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, count, task = 0, 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            _, offsets = string_buffer(batch.column(at))
            n = np.arange(batch.num_rows)
            block = task + (size + offsets[:-1] + n * ROW) // BLOCK
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block), pa.array(count + n)], [*batch.schema.names, "block", "row"])
            size, count = size + int(offsets[-1]) + batch.num_rows * ROW, count + batch.num_rows

    schema = StructType([*docs.schema.fields, StructField("block", LongType()), StructField("row", LongType())])
    return written(docs.mapInArrow(deal, schema), "blocks")


def requests(blocks: DataFrame) -> DataFrame:
    """For each run of rows of a block that one task reads, and each shard: the run's distinct keys, and their counts in all and in target rows, of all (n, t) and at a row's end (e, f).

    A scan may split a block, so a request names its rows: from `first` on, `rows` of them.
    """
    dealt = blocks.select("block").distinct().count()
    bits = max(1, (dealt // BLOCKS).bit_length())
    starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)

    def request(run: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(run)
        rows, word, pair, last = all_grams(t["text"])
        own = t["target"].to_numpy().astype(bool)[rows]
        keys, n = distinct(np.concatenate([word, pair]))
        counts = [n]
        for part in (np.concatenate([word[own], pair[own]]), word[last], word[last & own]):
            some, k = distinct(part)
            counts.append(np.zeros(len(keys), np.int64))
            counts[-1][np.searchsorted(keys, some)] = k
        cut = np.append(np.searchsorted(keys, starts), len(keys))
        parts = list(zip(cut[:-1], cut[1:], strict=True))
        same = [pa.array([x] * len(parts), pa.int64()) for x in (t["block"][0].as_py(), t["row"][0].as_py(), t.num_rows)]
        blobs = [[f(x[a:b]) for a, b in parts] for x, f in ((keys, np.ndarray.tobytes), *((x, packed) for x in counts))]
        return pa.RecordBatch.from_arrays([*same, pa.array(range(len(parts)), pa.int64()), *[pa.array(x, pa.binary()) for x in blobs]], ["block", "first", "rows", "shard", "keys", "n", "t", "e", "f"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            block, row = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cut = np.flatnonzero((np.diff(block) != 0) | (np.diff(row) != 1)) + 1
            for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
                if run and last != (block[a], row[a] - 1):
                    yield request(run)
                    run = []
                run.append(batch.slice(a, b - a))
                last = block[b - 1], row[b - 1]
        if run:
            yield request(run)

    return blocks.select("block", "row", "text", "target").mapInArrow(ask, "block long, first long, rows long, shard long, keys binary, n binary, t binary, e binary, f binary")


def answers(asked: DataFrame) -> DataFrame:
    """Each request, written, with the whole corpus' counts of its keys in all (n) and in target rows (t), and of words that another follows (h, g).

    A shard's first row has its distinct words, its words in all and in target rows, and the rows that end in them.
    """

    def add(shard: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, np.uint64) for x in shard["keys"].to_pylist()]
        cut = np.cumsum([0, *map(len, keys)])
        known, at = np.unique(np.concatenate(keys), return_inverse=True)
        word = known & _ONE == 0
        n, t, e, f = (np.bincount(at, np.concatenate([unpacked(x) for x in shard[name].to_pylist()]), len(known)).astype(np.int64) for name in "ntef")
        out = [pa.array([packed(x[at[a:b]]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for x in (n, t, np.where(word, n - e, 0), np.where(word, t - f, 0))]
        rest = [0] * (len(keys) - 1)
        stats = [pa.array([int(x), *rest], pa.int64()) for x in (word.sum(), n[word].sum(), t[word].sum(), e.sum(), f.sum())]
        return pa.table([*[shard[c] for c in ("block", "first", "rows", "shard")], *out, *stats], names=["block", "first", "rows", "shard", "n", "t", "h", "g", "vocabulary", "words", "target_words", "starts", "target_starts"])

    schema = "block long, first long, rows long, shard long, n binary, t binary, h binary, g binary, vocabulary long, words long, target_words long, starts long, target_starts long"
    return written(asked.groupBy("shard").applyInArrow(add, schema), "answers")


def sizes(answered: DataFrame) -> tuple[int, int, int]:
    """Distinct words, and words of the target's and of all documents."""
    return tuple(x or 0 for x in answered.agg(F.sum("vocabulary"), F.sum("target_words"), F.sum("words")).first())


def starts(answered: DataFrame) -> tuple[int, int]:
    """Rows with words of the target's and of all documents: how often a first word can stand."""
    return tuple(x or 0 for x in answered.agg(F.sum("target_starts"), F.sum("starts")).first())


def counts(docs: DataFrame) -> np.ndarray:
    """A row each, the words of the target's and of all documents, from (text, target)."""
    return np.array(sizes(answers(requests(blocked(docs))))[1:]).reshape(2, 1)


def losses(word: np.ndarray, seen: np.ndarray, joint: np.ndarray, total: int, vocabulary: int) -> np.ndarray:
    """Negative log probability of words, from the counts of each, of any word behind the one before it, and of both."""
    p = (word + 1.0) / (total + vocabulary)
    return -np.log((joint + BACKOFF * p) / (seen + BACKOFF))


def cross_entropy_difference(docs: DataFrame, target: DataFrame) -> DataFrame:
    """A row for each row of docs (doc_id, text): doc_id, n_tokens, target_loss, background_loss, score.

    target (doc_id) names the documents of the target model; the background model counts all of docs.
    Losses are means over a document's words, in nats; score is target_loss - background_loss, lower
    for texts more like the target. Nulls: a null or empty text has no word and null losses; null ids are
    in no target. Repeated rows count as often as they stand; repeated target ids count once. Without a
    target its model is uniform. A text, however long, is counted and scored whole, in steps. Ties cannot be: nothing
    is chosen by rank. Other columns are ignored; an empty table gives an empty one.
    """
    own = text_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = few(target.select(target["doc_id"].cast("long").alias("_id")).dropna()).withColumn("_t", F.lit(True))
    marked = own.join(chosen, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", F.coalesce("_t", F.lit(False)).alias("target"))
    blocks = blocked(marked)
    answered = answers(requests(blocks))
    vocabulary, *totals = sizes(answered)
    rows_of = starts(answered)
    vocabulary = max(vocabulary, WORDS)
    names = ["doc_id", "n_tokens", "target_loss", "background_loss", "score"]

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        texts, known = texts.sort_by("row"), known.sort_by([("first", "ascending"), ("shard", "ascending")])
        start, out = texts["row"][0].as_py(), []
        firsts = known["first"].to_numpy()
        for first in np.unique(firsts):
            asked = known.filter(pa.array(firsts == first))
            some = texts.slice(first - start, asked["rows"][0].as_py())
            rows, word, pair, _ = all_grams(some["text"])
            word, pair = np.split(np.unique(np.concatenate([word, pair]), return_inverse=True)[1], 2)
            begins = np.append(True, rows[1:] != rows[:-1])[: len(rows)]
            n = np.bincount(rows, minlength=some.num_rows)
            loss = []
            for name, follows, total, all_rows in zip("tn", "gh", totals, rows_of, strict=True):
                table, seen = (np.concatenate([unpacked(x) for x in asked[c].to_pylist()]) for c in (name, follows))
                # Before a word stands the one before it, where that is followed, or a row's start.
                seen = np.where(begins, all_rows, seen[np.roll(word, 1)])
                each = losses(table[word], seen, table[pair], total, vocabulary)
                loss.append(np.bincount(rows, each, some.num_rows) / np.maximum(n, 1))
            scored = [pa.array(x, pa.float64(), mask=n == 0) for x in (*loss, loss[0] - loss[1])]
            out.append(pa.table([some["doc_id"], pa.array(n, pa.int64()), *scored], names=names))
        return pa.concat_tables(out)

    texts = blocks.select("block", "row", "doc_id", "text").groupBy("block")
    known = answered.select("block", "first", "rows", "shard", "n", "t", "h", "g").groupBy("block")
    return texts.cogroup(known).applyInArrow(score, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")
