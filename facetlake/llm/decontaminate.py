"""Benchmark decontamination by Wu-Manber search over words.

A pattern is a run of `size` consecutive words of a benchmark item, or the whole of
a shorter item. Patterns of one length share a table of shifts, indexed by a hash of
the two words that end a position: it says how far the next possible end lies. Where
the shift is 0, the bucket of that suffix gives the patterns to compare.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.llm.shared import bounded, few, row_blocks, string_buffer, text_columns, written
from facetlake.llm.textkit import MARKS, STEP, Words, mix, randoms

#: Bytes of benchmark texts in one broadcast set of tables, of which more are searched for in turns; words of a piece of an item.
PATTERN_BYTES, ITEM_WORDS = 4 << 20, 1 << 16
#: Ends of windows that one lane of a vectorised scan walks over.
LANE = 512
_BLOCK = randoms(23, 2)


class Table:
    """Shift table, suffix buckets and words of all patterns of one length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[int]], hashes: dict[bytes, int]):
        self.texts = list(patterns)
        self.items = [sorted(patterns[p]) for p in self.texts]
        self.length = m = len(self.texts[0])
        self.block = min(2, m)
        words = np.array([[hashes[w] for w in p] for p in self.texts], np.uint64)
        ends = self.block - 1
        bits = min(22, max(12, int(8 * words.size).bit_length()))
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.full(1 << bits, m - ends, np.uint16)
        for end in range(ends, m):
            at = (self.blocks(words.T, end) & self.mask).astype(np.int64)
            np.minimum.at(self.shift, at, m - 1 - end)
        suffix = self.blocks(words.T, m - 1)
        order = np.argsort(suffix, kind="stable")
        self.words, self.texts, self.items = words[order], [self.texts[i] for i in order], [self.items[i] for i in order]
        self.suffixes, self.first = np.unique(suffix[order], return_index=True)
        self.last = np.append(self.first[1:], len(order))

    def blocks(self, words: np.ndarray, ends) -> np.ndarray:
        out = words[ends] * _BLOCK[0]
        if self.block == 2:
            out = out + words[ends - 1] * _BLOCK[1]
        return mix(out)

    def occurrences(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern of every occurrence in the rows of a block of texts."""
        m = self.length
        rows = np.flatnonzero(words.counts >= m)
        lo, hi = words.first[rows] + m - 1, words.first[rows + 1]
        lanes = -((lo - hi) // LANE)
        part = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(lo, lanes) + part * LANE
        stop = np.minimum(at + LANE, np.repeat(hi, lanes))
        found: list[np.ndarray] = []
        while len(at):
            block = self.blocks(hashes, at)
            shift = self.shift[(block & self.mask).astype(np.int64)].astype(np.int64)
            if len(zero := np.flatnonzero(shift == 0)):
                k = np.minimum(np.searchsorted(self.suffixes, block[zero]), len(self.suffixes) - 1)
                hit = self.suffixes[k] == block[zero]
                k, ends = k[hit], at[zero][hit]
                n = self.last[k] - self.first[k]
                pattern = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[k], n)
                start = np.repeat(ends, n) - (m - 1)
                if len(start):
                    same = (hashes[start[:, None] + np.arange(m)] == self.words[pattern]).all(axis=1)
                    found.append(np.stack([start[same], pattern[same]]))
            at = at + np.maximum(shift, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        start, pattern = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        raw, s, e = words.raw.tobytes() if len(start) else b"", words.starts, words.ends
        sure = [i for i, (w, p) in enumerate(zip(start.tolist(), pattern.tolist(), strict=True)) if all(raw[s[w + j] : e[w + j]].lower() == x for j, x in enumerate(self.texts[p]))]
        return start[sure], pattern[sure]


def tables(items: list[tuple[int, str | None]], size: int) -> list[Table]:
    """The tables of some benchmark items, one for each length of their patterns."""
    by_length: dict[int, dict[tuple[bytes, ...], set[int]]] = defaultdict(lambda: defaultdict(set))
    hashes: dict[bytes, int] = {}
    for item, text in items:
        if item is None:
            continue
        raw, offsets = string_buffer(pa.array([text], pa.string()))
        words = Words(raw, offsets, MARKS)
        data = raw.tobytes()
        texts = [data[s:e].lower() for s, e in zip(words.starts, words.ends, strict=True)]
        hashes.update(zip(texts, words.hashes().tolist(), strict=True))
        n = min(size, len(texts))
        for i in range(len(texts) - n + 1 if n else 0):
            by_length[n][tuple(texts[i : i + n])].add(item)
    return [Table(x, hashes) for _, x in sorted(by_length.items())]


def lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def pass_over(raw: np.ndarray, offsets: np.ndarray, found: list[Table]):
    """Counts of words, runs of hit words and items with hits of each row."""
    words = Words(raw, offsets, MARKS)
    hashes = words.hashes()
    edge = np.zeros(len(words) + 1, np.int64)
    pairs: set[tuple[int, int]] = set()
    for t in found:
        start, pattern = t.occurrences(words, hashes)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + t.length, -1)
        rows = np.searchsorted(words.first, start, "right") - 1
        seen = set(zip(rows.tolist(), pattern.tolist(), strict=True))
        pairs.update((r, i) for r, p in seen for i in t.items[p])
    hit = np.cumsum(edge[:-1]) > 0
    rows = words.rows()
    new = np.ones(len(hit), bool)
    new[1:] = rows[1:] != rows[:-1]
    end = np.ones(len(hit), bool)
    end[:-1] = new[1:]
    first = np.flatnonzero(hit & (new | ~np.append(False, hit[:-1])))
    last = np.flatnonzero(hit & (end | ~np.append(hit[1:], False))) + 1
    at = rows[first]
    runs = lists(np.bincount(at, minlength=len(words.counts)), pa.StructArray.from_arrays([pa.array(first - words.first[at], pa.int64()), pa.array(last - words.first[at], pa.int64())], ["first", "last"]))
    ordered = sorted(pairs)
    items = lists(np.bincount([r for r, _ in ordered], minlength=len(words.counts)) if ordered else np.zeros(len(words.counts), np.int64), pa.array([i for _, i in ordered], pa.int64()))
    return words.counts, runs, items


def pieces(benchmark: DataFrame, size: int) -> DataFrame:
    """(item_id, text) of the items with id and text, once each; a long item in pieces that share size - 1 words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw, offsets = string_buffer(pa.array([text]))
                words = Words(raw, offsets, MARKS)
                for k in range(0, max(1, len(words) - size + 1), ITEM_WORDS) if len(words) else ():
                    last = min(k + ITEM_WORDS + size - 1, len(words))
                    ids.append(item)
                    texts.append(raw[words.starts[k] : words.ends[last - 1]].tobytes().decode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["item_id", "text"])

    own = text_columns(benchmark, "item_id", "text").selectExpr("cast(item_id as long) item_id", "text").dropna().distinct()
    return written(own.mapInArrow(cut, "item_id long, text string"), "items")


def turns(items: DataFrame) -> int:
    """Sets of tables, of about PATTERN_BYTES, in which the items are searched for."""
    return max(1, -(-items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // PATTERN_BYTES))


def one_turn(items: DataFrame, turn: int, of: int, size: int):
    """The broadcast tables of one of the sets."""
    own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(of)) == turn).collect()
    return items.sparkSession.sparkContext.broadcast(tables([(x[0], x[1]) for x in own], size))


def scanned(batch: pa.RecordBatch, at: int, known) -> Iterator[tuple[pa.RecordBatch, np.ndarray, pa.Array, pa.Array]]:
    """Parts of a batch with pass_over() of the texts in column `at`."""
    raw, offsets = string_buffer(batch.column(at))
    for a, b in row_blocks(offsets, STEP):
        yield batch.slice(a, b - a), *pass_over(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], known.value)


FOUND = "doc_id long, n_words long, runs array<struct<first:long,last:long>>, items array<long>"


def overlaps(docs: DataFrame, benchmark: DataFrame, size: int = 13) -> DataFrame:
    """A row for each row of docs (doc_id, text): doc_id, n_words, runs, items.

    runs: maximal runs of words, from first up to but without last, that lie in an occurrence of a
    pattern of benchmark (item_id, text); items: ids of the items whose patterns occur, ascending.
    Nulls: a null text has no words; an item without id, text or words has no pattern; a null doc_id stays null.
    A long text is searched whole, a long item in pieces that lose no pattern. Nothing is chosen by rank, so there are
    no ties. Repeated rows of docs each give a row; repeated items count once; other columns are ignored.
    Without items or documents the lists, or the result, are empty. A benchmark beyond PATTERN_BYTES is searched for in
    several scans of docs, which write no more than the hits; the result is the same.
    """
    items = pieces(benchmark, size)
    of = turns(items)
    own = text_columns(docs, "doc_id", "text").selectExpr("cast(doc_id as long) doc_id", "text")
    if of == 1:
        known = one_turn(items, 0, 1, size)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, n, runs, ids in scanned(batch, 1, known):
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), runs, ids], ["doc_id", "n_words", "runs", "items"])

        return own.mapInArrow(search, FOUND)
    own = written(own.withColumn("row", F.monotonically_increasing_id()), "rows")
    hits = None
    for turn in range(of):
        known = one_turn(items, turn, of, size)

        def hit(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, _, runs, ids in scanned(batch, 1, known):
                    found = pa.RecordBatch.from_arrays([part.column(2), runs, ids], ["row", "runs", "items"])
                    yield found.filter(pc.greater(pc.list_value_length(ids), 0))

        more = written(own.mapInArrow(hit, "row long, runs array<struct<first:long,last:long>>, items array<long>"), "hits")
        hits = more if hits is None else hits.unionByName(more)
    by_row = hits.groupBy(F.col("row").alias("_row")).agg(F.flatten(F.collect_list("runs")).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_buffer(batch.column(1))
            n = [Words(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], MARKS).counts for a, b in row_blocks(offsets, STEP)]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), pa.array(np.concatenate(n) if n else [], pa.int64())], ["row", "doc_id", "n_words"])

    # Runs of several turns are united: sorted, each joins the one before if it begins within it, as one pass has them.
    one = F.array_sort("runs")
    last = lambda x: F.element_at(x, -1)
    step = lambda done, r: F.when((F.size(done) > 0) & (last(done)["last"] >= r["first"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last(done)["first"].alias("first"), F.greatest(last(done)["last"], r["last"]).alias("last"))))).otherwise(F.concat(done, F.array(r)))
    none = F.array().cast("array<struct<first:bigint,last:bigint>>")
    counted = own.mapInArrow(count, "row long, doc_id long, n_words long")
    out = counted.join(by_row, F.col("row") == F.col("_row"), "left")
    return out.select("doc_id", "n_words", F.coalesce(F.aggregate(one, none, step), none).alias("runs"), F.coalesce("items", F.array().cast("array<long>")).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20) -> DataFrame:
    """overlaps() with n_hit, its hit words, and contaminated: some word is hit, and at least one of `share` is.

    Nulls, repeats, ties, long texts and empty tables are as in overlaps(); a text without words is not contaminated.
    """
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"])
    out = overlaps(docs, benchmark, size).withColumn("n_hit", n_hit)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20) -> DataFrame:
    """The rows of docs, with all their columns, whose text is not contaminated, row by row, whatever their ids; as contamination() tells."""
    items = pieces(benchmark, size)
    if turns(items) == 1:
        bounded(docs.sparkSession)
        known, at = one_turn(items, 0, 1, size), docs.columns.index("text")

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, n, runs, _ in scanned(batch, at, known):
                    first, last = runs.values.flatten()
                    ends = np.concatenate([[0], np.cumsum(last.to_numpy() - first.to_numpy())])[runs.offsets.to_numpy()]
                    n_hit = np.diff(ends)
                    yield part.filter(pa.array(~((n_hit > 0) & (share * n_hit >= n))))

        return docs.mapInArrow(keep, docs.schema)
    rows = written(docs.withColumn("_decontaminated_row", F.monotonically_increasing_id()), "rows")
    found = contamination(rows.select(F.col("_decontaminated_row").alias("doc_id"), "text"), benchmark, size, share)
    gone = few(found.filter("contaminated").select(F.col("doc_id").alias("_gone")))
    return rows.join(gone, rows["_decontaminated_row"] == gone["_gone"], "left_anti").drop("_decontaminated_row")
