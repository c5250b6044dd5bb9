"""Connected components of links by alternating large and small stars, on the executors."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.llm.shared import dropped, salted, written

#: Edges, at most, that one task connects in its memory; more take rounds over all executors.
SMALL = 50_000


class Forest:
    """Union of numbers, each tree named by its least."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, i: int) -> int:
        up = self.up
        while i in up:
            if up[i] in up:
                up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def _star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """Each vertex links its larger (or its smaller) neighbours to the least vertex that it knows of; one of many neighbours does so in several tasks."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n")), "least")
    near, known = salted(near, least, ("u",), ("u",), "v", total)
    out = near.join(known, ["u", "_salt"]).select("u", "v", "m")
    if large:
        out = out.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select("u", F.col("m").alias("v"))
        out = out.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    out = written(out.filter("u <> v").distinct(), "edges")
    dropped(least)
    return out


def _connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest, seen = Forest(), set()
    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(u, v)
            seen |= {u, v}
    rows = [(i, r) for i in sorted(seen) if (r := forest.root(i)) != i]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], ["id", "component_id"])


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("u", "v"), 20)), F.sum(F.shiftright(F.xxhash64("v", "u"), 20))).first())


def components(links: DataFrame) -> DataFrame:
    """Rows (id, component_id) for each vertex of the links (u, v) but those that are the least of their component.

    component_id is the least vertex that links reach. Links may repeat, run both ways or from a
    vertex to itself; those with a null are ignored; without links there are no rows. Up to SMALL edges are
    connected in one task; beyond, each round writes its edges, at most one for each link, to the shared folder, and
    rounds grow with the logarithm of the largest component. The result is the same either way.
    """
    edges = written(links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).filter("u <> v").distinct(), "edges")
    mark = _mark(edges)
    if mark[0] <= SMALL:
        return written(edges.repartition(1).mapInArrow(_connect, "id long, component_id long"), "components")
    while mark[0]:
        half = _star(edges, True, mark[0])
        dropped(edges)
        after = _star(half, False, mark[0])
        dropped(half)
        edges, old, mark = after, mark, _mark(after)
        if old == mark:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
