"""Mixing sources to target weights: subset sums of exact document sizes.

Each source has a share of the budget by weight, at most `most` times its own size.
A source takes all its documents as often as its target allows, and fills what
remains with further copies: as many of each length as its part of the remainder,
then a few more, found by bounded-knapsack dynamic programming over the lengths, so
that the remainder is met as nearly as those lengths can. Which documents of a
length are taken follows a seeded hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from facetlake.llm.shared import row_blocks, string_buffer, text_columns, written
from facetlake.llm.textkit import STEP, Words

#: Words of a source's remainder that dynamic programming fills.
WINDOW = 1 << 16
#: Most bytes of the states of a programme over the whole remainder, tried where that of the window falls short.
STATES = 64 << 20
#: Parts by hash in which the documents of one length are counted, and rows to a part, so that no task holds or sorts them all.
PARTS, PART_ROWS = 64, 1 << 20
#: Sources up to which the table of targets is broadcast, about 100 bytes each; of more it is joined. The mix is the same.
FEW_SOURCES = 100_000


def sizes(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns `keep` of docs with size, the number of words between white space; 0 for a null text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_buffer(batch.column(batch.num_columns - 1))
            n = [Words(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]).counts for a, b in row_blocks(offsets, STEP)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(n) if n else [], pa.int64())], [*keep, "size"])

    own = text_columns(docs, *keep, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])
    return own.mapInArrow(count, f"{fields}, size long")


def targets(by_source: list[tuple[str | None, int]], weights: tuple[float, ...], share: float = 1.0, most: float = 3.0) -> dict[str | None, float]:
    """Target of each source: shares of `share` times all sizes by weight, none above `most` times its source.

    Sources stand in the order of their code points, null last, and take the weights in turn. What a
    source cannot use goes to the others by weight, again until none is above; with nothing left to
    take it, it stays unused.
    """
    order = sorted(by_source, key=lambda x: (x[0] is None, (x[0] or "").encode()))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    top = {s: most * n for s, n in order}
    left, out, free = share * sum(n for _, n in order), {}, [s for s, _ in order]
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / total > top[s]]
        if not full:
            out |= {s: left * weight[s] / total for s in free}
            break
        out |= {s: top[s] for s in full}
        left -= sum(top[s] for s in full)
        gone = set(full)
        free = [s for s in free if s not in gone]
    return out


def programme(lengths: np.ndarray, counts: np.ndarray, taken: np.ndarray, left: int) -> np.ndarray:
    """taken and more documents, whose sizes sum to `left` or as near below it as any do."""
    taken = taken.copy()
    limit = (1 << (left + 1)) - 1
    reach, steps = 1, []
    usable = [i for i in np.argsort(-lengths, kind="stable")[::-1] if 0 < lengths[i] <= left and counts[i] > taken[i]]
    for i in sorted(usable, key=lambda i: (-int(counts[i] - taken[i]), int(lengths[i]))):
        spare = min(int(counts[i] - taken[i]), left // int(lengths[i]))
        step = 1
        while spare > 0:
            n = min(step, spare)
            steps.append((i, n, reach))
            reach |= (reach << (n * int(lengths[i]))) & limit
            spare -= n
            step *= 2
        if reach >> left & 1:
            break
    at = reach.bit_length() - 1
    for i, n, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += n
            at -= n * int(lengths[i])
    return taken


def subset(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their sizes sum to the budget, or as near below it as found.

    A part of each length, in proportion, is fixed; of the rest, the best is found by one programme where it is
    no more than WINDOW, or where its states fit STATES, as those of few long documents do. Else long documents
    are chosen first, and less than the shortest document not taken is missing.
    """
    total = int((lengths * counts).sum())
    budget = min(budget, total)
    taken = np.minimum(counts, (counts.astype(object) * budget // max(total, 1)).astype(np.int64))
    order = np.argsort(-lengths, kind="stable")
    left = rest = budget - int((taken * lengths).sum())
    base = taken.copy()
    for i in order:  # long ones first, down to what the programme below handles
        if left <= WINDOW:
            break
        n = min(int(counts[i] - taken[i]), (left - WINDOW // 2) // int(lengths[i]))
        if n > 0:
            taken[i] += n
            left -= n * int(lengths[i])
    for i in order:
        if left <= WINDOW:
            break
        n = min(int(counts[i] - taken[i]), left // int(lengths[i]))
        taken[i] += n
        left -= n * int(lengths[i])
    if 0 < left <= WINDOW:
        taken = programme(lengths, counts, taken, left)
    if rest > WINDOW and int((taken * lengths).sum()) < budget:
        spare = np.minimum(counts - base, rest // np.maximum(lengths, 1))
        if sum(int(n).bit_length() for n in spare) * rest // 8 <= STATES:
            taken = programme(lengths, counts, base, rest)
    return taken


def mixture(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, most: int = 3, seed: int = 17) -> DataFrame:
    """A row for each row of docs (doc_id, source, text): doc_id, size, source_size, target, copies, taken.

    copies: how often the mix holds the document, 0 to `most`; taken: copies times size. The words
    taken of a source are its target, rounded, or as near below as subset() comes.
    The same seed gives the same mix. Nulls: a null source is a source of its own, a null text has
    size 0; documents of size 0 are never taken. A long text counts whole. Documents of one length that tie in the
    hash go by doc_id. Repeated rows are documents of their own, though equal rows may swap places. Other columns are ignored; an empty table gives an empty one.
    """
    # Equal rows of one id differ only in which of them is taken; their order is no part of the result.
    sized = written(sizes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), docs["text"]), "doc_id", "source"), "sizes")
    parts = max(PARTS, sized.count() // PART_ROWS)
    sized = sized.withColumn("part", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(parts)).cast("int"))
    counts = written(sized.groupBy("source", "size", "part").agg(F.count("*").alias("n")), "counts")
    by_source = [(x[0], x[1]) for x in counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n"))).collect()]
    goal = targets(by_source, tuple(weights), share, most)
    total = dict(by_source)
    spark = docs.sparkSession
    plan = spark.createDataFrame([(s, int(total[s]), float(goal[s])) for s in goal], "source string, source_size long, target double")

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        budget, size = round(float(rows["target"].iloc[0])), int(rows["source_size"].iloc[0])
        whole = min(most, budget // size) if size else 0
        out = rows[["source", "size", "n"]].copy()
        rest = budget - whole * size
        fits = (out["size"] > 0).to_numpy() & (whole < most)
        extra = np.zeros(len(out), np.int64)
        if rest > 0 and fits.any():
            extra[fits] = subset(out["size"].to_numpy()[fits], out["n"].to_numpy()[fits], rest)
        return out.assign(whole=np.where(out["size"] > 0, whole, 0), extra=extra)[["source", "size", "whole", "extra"]]

    # One group is the distinct lengths of one source, never its documents.
    lengths = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    lengths = lengths.join(F.broadcast(plan) if len(goal) <= FEW_SOURCES else plan, lengths["source"].eqNullSafe(plan["source"])).select(lengths["source"], "size", "n", "source_size", "target")
    chosen = lengths.groupBy("source").applyInPandas(fill, "source string, size long, whole long, extra long")
    chosen = written(chosen, "chosen").withColumnRenamed("source", "s").withColumnRenamed("size", "z")

    # Of each length, whole parts in turn, and in the part where the number ends, the first by hash.
    ahead = counts.join(chosen, counts["source"].eqNullSafe(chosen["s"]) & (counts["size"] == chosen["z"])).drop("s", "z")
    totals = ahead.groupBy("source", "size").agg(F.map_from_entries(F.collect_list(F.struct("part", "n"))).alias("by_part"), F.first("whole").alias("whole"), F.first("extra").alias("extra"))
    before = F.aggregate(F.sequence(F.lit(0), F.col("part") - 1), F.lit(0).cast("long"), lambda a, p: a + F.coalesce(F.col("by_part")[p], F.lit(0).cast("long")))
    ranked = totals.select("source", "size", "whole", "extra", "by_part", F.explode(F.map_keys("by_part")).alias("part"))
    ranked = ranked.withColumn("n", F.col("by_part")[F.col("part")]).withColumn("room", F.col("extra") - F.when(F.col("part") > 0, before).otherwise(0))
    ranked = ranked.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("p"), "whole", "n", F.greatest(F.lit(0), F.least("room", "n")).alias("room"))
    joined = sized.join(ranked, sized["source"].eqNullSafe(ranked["s"]) & (sized["size"] == ranked["z"]) & (sized["part"] == ranked["p"])).drop("s", "z", "p", "part")
    split = (F.col("room") > 0) & (F.col("room") < F.col("n"))
    clear = joined.filter(~split).withColumn("more", F.when(F.col("room") > 0, 1).otherwise(0))
    by_hash = Window.partitionBy("source", "size").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id")
    ended = joined.filter(split).withColumn("more", (F.row_number().over(by_hash) <= F.col("room")).cast("int"))
    out = clear.unionByName(ended).join(F.broadcast(plan) if len(goal) <= FEW_SOURCES else plan, joined["source"].eqNullSafe(plan["source"])).select("doc_id", joined["source"], "size", "source_size", "target", (F.col("whole") + F.col("more")).alias("copies"))
    return out.withColumn("taken", F.col("copies") * F.col("size"))
