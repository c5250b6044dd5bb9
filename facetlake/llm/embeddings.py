"""Embedding near-duplicates by an epsilon grid order join.

On unit vectors a cosine bound is a distance bound, epsilon. Equal vectors are joined as one, with
their number. Vectors are sorted by their grid cells of that width on the leading principal axes, and
the sequence is cut into segments. Two intervals of the sequence whose bounding boxes, over those axes
and the length of what is left of a vector beside them, lie further apart than epsilon cannot link;
others are split and joined recursively, down to pieces. There, products of the leading coordinates
and of the lengths left bound the cosines from above, and exact ones are computed where the bound allows
a link. Segments meet in pairs, one task a pair, so that a vector is sent once for each segment, however
small the intervals are that are joined, and no task holds more than two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.llm.components import components
from facetlake.llm.shared import bounded, dropped, written

#: Leading principal axes of the grid; vectors in a piece that is multiplied out.
AXES, PIECE = 16, 256
#: Bytes and vectors in a segment, about, and segments at least, so that there are enough pairs for many tasks.
SEGMENT, BLOCK, SEGMENTS = 16 << 20, 1 << 17, 8
#: Vectors, at most, from which the axes come, and their bytes; the choice follows a seeded hash of vec_id. Links do not depend on it.
SAMPLE, SAMPLE_BYTES = 2048, 32 << 20
#: Equal vectors that are led back by a broadcast instead of a shuffle: those of at least BIG, and of so many that no more than MOST_BIG can be.
BIG, MOST_BIG = 10_000, 50_000
#: Candidates of a piece beyond which all its cosines are computed.
DENSE = 4096


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and packed components of the vectors that can link: no null, no non-finite one, not all zero."""
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    dtype, kind = (np.float32, "float") if kind == "float" else (np.float64, "double")
    fit = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.asarray(x, dtype).tobytes() for x in (batch.column(1).slice(i, 1).flatten().to_numpy(zero_copy_only=False) for i in range(batch.num_rows))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["vec_id", "x"])

    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    return own.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(fit).mapInArrow(pack, "vec_id long, x binary")


def _matrix(column: pa.Array, dtype, dim: int) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), dim))


def principal_axes(vectors: DataFrame, dtype, dim: int) -> np.ndarray:
    """Leading principal axes of a bounded sample of (id, x)."""
    most = max(2, min(SAMPLE, SAMPLE_BYTES // (dim * np.dtype(dtype).itemsize)))
    rows = vectors.orderBy(F.xxhash64(F.lit(29), "id"), "id").select("x").limit(most).collect()
    x = _unit(np.frombuffer(b"".join(r[0] for r in rows), dtype).reshape(len(rows), dim))
    return np.linalg.svd(x - x.mean(axis=0), full_matrices=False)[2][: min(AXES, dim)].T


def placed(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates of unit vectors on the axes, and the length of what is left; no further apart than the vectors, and their products no less."""
    p = x @ axes
    return np.concatenate([p, np.sqrt(np.maximum(0, 1 - (p * p).sum(axis=1, keepdims=True)))], axis=1)


def segments(vectors: DataFrame, axes: np.ndarray, dtype, dim: int, epsilon: float, n: int) -> DataFrame:
    """The vectors (id, m, x) in epsilon grid order, in rows of one segment each: seg, ids, m, x, lo, hi."""
    parts = max(-(-n * dim * np.dtype(dtype).itemsize // SEGMENT), -(-n // BLOCK), min(SEGMENTS, -(-n // PIECE)))
    size = max(PIECE, -(-5 * n // (4 * parts)))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = np.floor(_matrix(batch.column(2), dtype, dim) @ axes / epsilon).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c) for c in cells.T)], ["id", "m", "x", *cell])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def row(t: pa.Table) -> pa.RecordBatch:
            p = placed(_matrix(t.column(2), dtype, dim), axes)
            ids = t.column(0).to_numpy()
            blobs = [pa.array([x], pa.binary()) for x in (ids.tobytes(), t.column(1).to_numpy().tobytes(), b"".join(t.column(2).to_pylist()))]
            return pa.RecordBatch.from_arrays([pa.array([int(ids[0])], pa.int64()), *blobs, *(pa.array([x.tolist()]) for x in (p.min(axis=0), p.max(axis=0)))], ["seg", "ids", "m", "x", "lo", "hi"])

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            while rows >= size:
                t = pa.Table.from_batches(held)
                yield row(t.slice(0, size))
                held, rows = t.slice(size).to_batches(), rows - size
        if rows:
            yield row(pa.Table.from_batches(held))

    cell = [f"c{i}" for i in range(axes.shape[1])]
    located = vectors.select("id", "m", "x").mapInArrow(locate, "id long, m long, x binary, " + ", ".join(f"{c} int" for c in cell))
    ordered = located.repartitionByRange(parts, *cell, "id").sortWithinPartitions(*cell, "id")
    return ordered.mapInArrow(cut, "seg long, ids binary, m binary, x binary, lo array<double>, hi array<double>")


def partners(boxes: DataFrame, epsilon: float) -> DataFrame:
    """Pairs (i, j), i <= j, of segments whose boxes (seg, lo, hi) are no further apart than epsilon; they meet in cells of the first axis."""
    reach = epsilon * (1 + 1e-9)
    a = boxes.select(F.col("seg").alias("i"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"), F.explode(F.sequence(F.floor((F.col("lo")[0] - reach) / epsilon), F.floor((F.col("hi")[0] + reach) / epsilon))).alias("cell"))
    b = boxes.select(F.col("seg").alias("j"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"), F.explode(F.sequence(F.floor(F.col("lo")[0] / epsilon), F.floor(F.col("hi")[0] / epsilon))).alias("cell"))
    zero = F.lit(0.0)
    one, other = F.zip_with("alo", "bhi", lambda x, y: x - y), F.zip_with("blo", "ahi", lambda x, y: x - y)
    gap = F.aggregate(F.zip_with(one, other, lambda x, y: F.greatest(zero, x, y)), zero, lambda s, x: s + x * x)
    return a.join(b, "cell").filter((F.col("i") <= F.col("j")) & (gap <= reach * reach + 1e-9)).select("i", "j").distinct()


class Joiner:
    """Links between two segments, or within one; vectors have weights, the number of their copies."""

    def __init__(self, axes: np.ndarray, cosine: float):
        self.axes, self.cosine = axes, cosine
        self.far = 2 - 2 * cosine + 1e-9  # square of epsilon, with room for rounding
        self.low = np.float32(cosine - 1e-5)  # the same for bounds in single precision
        self.pieces = self.skipped = 0

    def join(self, a: np.ndarray, b: np.ndarray | None, wa: np.ndarray | None = None, wb: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
        """Weight of the links of each row of a and of b, and a forest over both, b's rows numbered after a's."""
        self.own = b is None
        self.a, self.pa = a, placed(a, self.axes)
        self.b, self.pb = (a, self.pa) if self.own else (b, placed(b, self.axes))
        self.fa, self.fb = self.pa.astype(np.float32), self.pb.astype(np.float32)
        self.wa = np.ones(len(a)) if wa is None else wa.astype(np.float64)
        self.wb = self.wa if self.own else np.ones(len(b)) if wb is None else wb.astype(np.float64)
        self.na, self.nb = np.zeros(len(a)), np.zeros(len(self.b))
        self.up: dict[int, int] = {}
        self._intervals(0, len(a), 0, len(self.b))
        return self.na.astype(np.int64), self.nb.astype(np.int64), self.up

    def _intervals(self, a0: int, a1: int, b0: int, b1: int) -> None:
        if self.own and b1 <= a0:  # the mirror image
            return
        p, q = self.pa[a0:a1], self.pb[b0:b1]
        gap = np.maximum(0, np.maximum(p.min(axis=0) - q.max(axis=0), q.min(axis=0) - p.max(axis=0)))
        if (gap * gap).sum() > self.far:
            self.skipped += -(-(a1 - a0) // PIECE) * -(-(b1 - b0) // PIECE)
        elif a1 - a0 <= PIECE and b1 - b0 <= PIECE:
            self._piece(a0, a1, b0, b1)
        elif a1 - a0 >= b1 - b0:
            m = a0 + max(PIECE, ((a1 - a0) // 2 + PIECE - 1) // PIECE * PIECE)
            self._intervals(a0, m, b0, b1)
            self._intervals(m, a1, b0, b1)
        else:
            m = b0 + max(PIECE, ((b1 - b0) // 2 + PIECE - 1) // PIECE * PIECE)
            self._intervals(a0, a1, b0, m)
            self._intervals(a0, a1, m, b1)

    def _piece(self, a0: int, a1: int, b0: int, b1: int) -> None:
        self.pieces += 1
        same = self.own and a0 == b0
        may = self.fa[a0:a1] @ self.fb[b0:b1].T >= self.low
        if same:
            np.fill_diagonal(may, False)
        n = int(np.count_nonzero(may))
        if not n:
            return
        shift = 0 if self.own else len(self.a)
        if n <= DENSE:
            i, j = np.nonzero(np.triu(may) if same else may)
            i, j = i + a0, j + b0
            sure = np.einsum("ij,ij->i", self.a[i], self.b[j]) >= self.cosine
            i, j = i[sure], j[sure]
            if len(i):
                self.na += np.bincount(i, self.wb[j], len(self.na))
                to = self.na if self.own else self.nb
                to += np.bincount(j, self.wa[i], len(to))
                for u, v in zip(i.tolist(), (j + shift).tolist(), strict=True):
                    self._unite(u, v)
            return
        link = self.a[a0:a1] @ self.b[b0:b1].T >= self.cosine
        if same:
            np.fill_diagonal(link, False)
        if not link.any():
            return
        self.na[a0:a1] += link @ self.wb[b0:b1]
        if self.own:
            if not same:
                self.na[b0:b1] += self.wa[a0:a1] @ link
        else:
            self.nb[b0:b1] += self.wa[a0:a1] @ link
        # Least labels spread over the links until they stand; a label is a row of a, or of b after them.
        rows, cols = np.flatnonzero(link.any(axis=1)), np.flatnonzero(link.any(axis=0))
        link = link[np.ix_(rows, cols)]
        x, y = rows + a0, cols + b0 + shift
        names, top = (x, y), np.iinfo(np.int64).max
        while True:
            y2 = np.minimum(y, np.where(link, x[:, None], top).min(axis=0))
            x2 = np.minimum(x, np.where(link, y2[None, :], top).min(axis=1))
            if (x2 == x).all() and (y2 == y).all():
                break
            x, y = x2, y2
        for name, label in zip(np.concatenate(names).tolist(), np.concatenate([x, y]).tolist(), strict=True):
            self._unite(name, label)

    def _unite(self, i: int, j: int) -> None:
        i, j = self._root(i), self._root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)

    def _root(self, i: int) -> int:
        up = self.up
        while i in up:
            if up[i] in up:
                up[i] = up[up[i]]
            i = up[i]
        return i


def joined(vectors: DataFrame, dtype, dim: int, cosine: float, n: int) -> DataFrame:
    """(u, n, v) for each segment pair and vector (id, m, x) with links there: their weight, and an edge of a forest."""
    epsilon = float(np.sqrt(max(2 - 2 * cosine, 1e-12)))
    axes = principal_axes(vectors, dtype, dim)
    cut = written(segments(vectors, axes, dtype, dim, epsilon, n), "segments", **{"parquet.block.row.count.limit": "1"})
    pairs = written(partners(cut.select("seg", "lo", "hi"), epsilon), "pairs")
    ways = pairs.select("i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("to"))
    sent = ways.join(cut.select("seg", "ids", "m", "x"), F.col("to") == F.col("seg")).select("i", "j", "seg", "ids", "m", "x")

    def join(rows: pa.Table) -> pa.Table:
        sides = {}
        for k in range(rows.num_rows):
            ids, m, x = (rows[c][k].as_buffer() for c in ("ids", "m", "x"))
            ids = np.frombuffer(ids, np.int64)
            sides[rows["seg"][k].as_py()] = ids, np.frombuffer(m, np.int64), _unit(np.frombuffer(x, dtype).reshape(len(ids), dim))
        (names, wa, a), *other = (sides[k] for k in sorted(sides))
        joiner = Joiner(axes, cosine)
        if other:
            na, nb, _ = joiner.join(a, other[0][2], wa, other[0][1])
            names, count = np.concatenate([names, other[0][0]]), np.concatenate([na, nb])
        else:
            count, _, _ = joiner.join(a, None, wa)
        at = np.flatnonzero(count)
        return pa.table([pa.array(names[at]), pa.array(count[at]), pa.array([int(names[joiner._root(k)]) for k in at.tolist()], pa.int64())], names=["u", "n", "v"])

    found = written(sent.groupBy("i", "j").applyInArrow(join, "u long, n long, v long"), "found")
    dropped(pairs)
    dropped(cut)
    return found


def linked(vectors: DataFrame, dtype, cosine: float) -> DataFrame | None:
    """vec_id, n_links, component_id of vectors (vec_id, x) of one dimension; None without vectors."""
    packed = written(vectors, "vectors")
    first = packed.select("x").first()
    if first is None:
        return None
    dim = len(first["x"]) // np.dtype(dtype).itemsize
    classes = written(packed.groupBy("x").agg(F.min("vec_id").alias("id"), F.count("*").alias("m")), "classes")
    n, total = classes.agg(F.count("*"), F.sum("m")).first()
    found = joined(classes, dtype, dim, cosine, n)
    counts = found.groupBy("u").agg(F.sum("n").alias("n"))
    comp = components(found.select("u", "v"))
    out = classes.select("x", "id", "m").join(counts, F.col("id") == F.col("u"), "left").join(comp.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left")
    out = written(out.select("x", "m", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")), "linked")
    # Copies learn the result of their class by their bytes; the rows of a class of very many stay where they are.
    big = out.filter(F.col("m") >= max(BIG, total // MOST_BIG)).drop("m")
    parts = [packed.join(F.broadcast(big), "x"), packed.join(F.broadcast(big.select("x")), "x", "left_anti").join(out.drop("m"), "x")]
    return parts[0].unionByName(parts[1]).select("vec_id", "n_links", "component_id")


def near_vectors(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """A row for each row of vectors (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors of one dimension link whose cosine, in double precision, is at least `cosine` (above 0).
    n_links: vectors linked directly; component_id: the least vec_id that links reach; kept marks its row.
    Nulls: vectors that are null, empty, zero or hold null or non-finite components link with nothing, and
    neither do those of a null vec_id, which keep a null component and are kept. Rows that repeat a vec_id
    are one vector, the least of theirs. Equal vectors of different ids link; there are no other ties. Other
    columns are ignored; an empty table gives an empty one.
    """
    bounded(vectors.sparkSession)
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vectors["embedding"])
    single = own
    if own.groupBy("vec_id").count().filter("count > 1").limit(1).count():
        single = own.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    kind = own.schema["embedding"].dataType.elementType.simpleString()
    results = None
    dims = [r[0] for r in single.select(F.size("embedding").alias("d")).filter("d > 0").distinct().collect()]
    for dim in sorted(dims):
        found = linked(usable(single.filter(F.size("embedding") == dim)), np.float32 if kind == "float" else np.float64, cosine)
        if found is not None:
            results = found if results is None else results.unionByName(found)
    out = own.select("vec_id")
    if results is None:
        out = out.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    else:
        out = out.join(results.withColumnRenamed("vec_id", "_id"), F.col("vec_id") == F.col("_id"), "left")
        out = out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
