"""Rasters in long form: a row (face, level, morton, y, x, code) for each sample.

Windows run along rows and columns of one tile, so they are partitioned by tile
and row, or tile and column, and no partition exceeds a raster's side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from facetlake.functions import elevation, keys, projection, topology
from facetlake.operators import index

KEY = ("face", "level", "morton")


def _row(*more):
    return Window.partitionBy(*KEY, "y").orderBy("x")


def _column():
    return Window.partitionBy(*KEY, "x").orderBy("y")


def delta2d(samples: DataFrame, code: str = "code") -> DataFrame:
    """residual of each sample: against left in the first row, above in the first column, else left + above - upper left; modulo 65536."""
    left, above = F.coalesce(F.lag(code).over(_row()), F.lit(0)), F.coalesce(F.lag(code).over(_column()), F.lit(0))
    # The row difference's difference by column is the whole predictor, with zeros beyond the edges.
    step = samples.withColumn("_h", F.col(code) - left)
    up = F.coalesce(F.lag("_h").over(_column()), F.lit(0))
    return step.withColumn("residual", F.pmod(F.col("_h") - up, F.lit(65536)).cast("int")).drop("_h")


def undelta2d(samples: DataFrame, residual: str = "residual") -> DataFrame:
    """code of each sample from its residual: sums along rows, then along columns, modulo 65536."""
    out = samples.withColumn("_s", F.sum(F.col(residual).cast("long")).over(_row().rowsBetween(Window.unboundedPreceding, 0)))
    total = F.sum("_s").over(_column().rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("code", total.bitwiseAND(F.lit(65535)).cast("int")).drop("_s")


def _binomial(value: str, window) -> Column:
    """Five taps 1 4 6 4 1 over those that are there, normalised; null with less than half the weight."""
    taps = [(F.lag(value, 2), 1), (F.lag(value, 1), 4), (F.col(value), 6), (F.lead(value, 1), 4), (F.lead(value, 2), 1)]
    taps = [(t if k == 2 else t.over(window), w) for k, (t, w) in enumerate(taps)]
    total = sum((F.when(t.isNotNull(), w).otherwise(0) for t, w in taps), F.lit(0))
    weighed = sum((F.coalesce(t, F.lit(0.0)) * w for t, w in taps), F.lit(0.0))
    return F.when(total >= 8, weighed / total)


def low_pass(samples: DataFrame, value: str) -> DataFrame:
    """smooth: the separable binomial filter of a value, along rows, then along columns; the value itself where no filter is."""
    out = samples.withColumn("_v", F.col(value).cast("double")).withColumn("_h", _binomial("_v", _row()))
    return out.withColumn("smooth", F.coalesce(_binomial("_h", _column()), F.col("_v"))).drop("_v", "_h")


def smoothstep(distance: Column, width: int = 32) -> Column:
    """Weight from 0 at the boundary to 1 at `width` samples from it."""
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), distance / F.lit(float(width))))
    return t * t * (3.0 - 2.0 * t)


def synthetic_faces(spark: SparkSession, cells: int = 256, amplitude: int = 2048) -> DataFrame:
    """Samples of the six root tiles on their lattice, from the analytic terrain."""
    n = cells + 1
    at = spark.range(6 * n * n).select((F.col("id") / (n * n)).cast("int").alias("face"), F.lit(0).alias("level"), F.lit(0).cast("long").alias("morton"), (F.floor(F.col("id") / n) % n).cast("int").alias("y"), (F.col("id") % n).cast("int").alias("x"))
    place = {a: (2 * F.col(b).cast("long") - cells).cast("double") / float(cells) for a, b in (("u", "x"), ("v", "y"))}
    out = projection.inverse(at.withColumns(place))
    return out.withColumn("code", elevation.quantize(elevation.synthetic(F.col("lat"), F.col("lon"), amplitude))).drop("u", "v", "lat", "lon")


def _on_edges(samples: DataFrame, cells: int, depth: int = 0) -> DataFrame:
    """Samples on each edge of their tile, or `depth` rows inside it, in one pass: face, level, morton, edge, p (place along the edge), code."""
    edges = [F.when(F.col(fixed) == at, F.struct(F.lit(e).alias("edge"), F.col(along).alias("p"))) for e, (fixed, along, at) in enumerate((("x", "y", depth), ("x", "y", cells - depth), ("y", "x", depth), ("y", "x", cells - depth)))]
    near = samples.filter((F.col("x").isin(depth, cells - depth)) | (F.col("y").isin(depth, cells - depth)))
    return near.select(*KEY, "code", F.explode(F.array_compact(F.array(*edges))).alias("e")).select(*KEY, "e.edge", "e.p", "code")


def edge_samples(samples: DataFrame, cells: int, depth: int = 0) -> DataFrame:
    """_on_edges() with the tile and edge that each edge touches, and the place there: nbr_face, nbr_morton, nbr_edge, q."""
    own = _on_edges(samples, cells, depth).withColumns({"x": keys.x_of(F.col("morton")), "y": keys.y_of(F.col("morton"))})
    own = topology.across(own)
    q = F.when(F.col("reversed"), cells - F.col("p")).otherwise(F.col("p"))
    return own.select(*KEY, "edge", "p", "code", "nbr_face", keys.morton(F.col("nbr_x"), F.col("nbr_y")).alias("nbr_morton"), F.col("touching").alias("nbr_edge"), q.alias("q"))


def seams(samples: DataFrame, cells: int) -> DataFrame:
    """Shared edges of the tiles of a level sample by sample, each pair once: face, level, morton, edge, nbr_face, nbr_morton, nbr_edge, p, code, nbr_code."""
    own = edge_samples(samples, cells).filter("(face, morton) < (nbr_face, nbr_morton)")
    other = _on_edges(samples, cells).select(F.col("face").alias("nbr_face"), "level", F.col("morton").alias("nbr_morton"), F.col("edge").alias("nbr_edge"), F.col("p").alias("q"), F.col("code").alias("nbr_code"))
    return own.join(other, ["nbr_face", "level", "nbr_morton", "nbr_edge", "q"]).select(*KEY, "edge", "nbr_face", "nbr_morton", "nbr_edge", "p", "code", "nbr_code")


def resolve_seams(samples: DataFrame, cells: int) -> DataFrame:
    """Samples of tiles, of any level, in which every sample that tiles of its level share has the code of the one of the lowest key.

    Only samples on edges and corners are grouped, by the lattice node that they share; the inside stays where it is.
    """
    x, y = F.col("x"), F.col("y")
    border = x.isin(0, cells) | y.isin(0, cells)
    gx, gy = keys.x_of(F.col("morton")) * cells + x, keys.y_of(F.col("morton")) * cells + y
    edge = samples.filter(border).withColumn("_node", topology.shared_node(F.col("face"), F.col("level"), gx, gy, cells))
    owner = edge.groupBy("level", "_node").agg(F.min_by("code", F.struct("face", "morton")).alias("_own"))
    fixed = edge.join(owner, ["level", "_node"]).withColumn("code", F.col("_own")).select(*samples.columns)
    return samples.filter(~border).unionByName(fixed)


def with_apron(samples: DataFrame, cells: int, sampler: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Tiles with a ring of one sample: the row next to the edge of the neighbour, mapped; corners repeat their own core's.

    Places move by one: the core lies at 1 to cells + 1. Each tile's inner rows go to the neighbours that exist. Where
    none of the level does, `sampler` gives the row that would stand there: it takes rows with face, u and v among
    their columns, on the neighbour's lattice, and adds their code. Without a sampler that part of the ring is left out.
    """
    core = samples.select(*KEY, (F.col("y") + 1).alias("y"), (F.col("x") + 1).alias("x"), "code")

    def ring(rows: DataFrame) -> DataFrame:
        e, q = F.col("edge"), F.col("q")
        x = F.when(e == 0, 0).when(e == 1, cells + 2).otherwise(q + 1)
        y = F.when(e == 2, 0).when(e == 3, cells + 2).otherwise(q + 1)
        return rows.select(*KEY, y.cast("int").alias("y"), x.cast("int").alias("x"), "code")

    tiles = samples.select(*KEY).distinct()
    there = tiles.select(F.col("face").alias("_f"), F.col("level").alias("_l"), F.col("morton").alias("_m"))
    given = edge_samples(samples, cells, 1).select(F.col("nbr_face").alias("face"), "level", F.col("nbr_morton").alias("morton"), F.col("nbr_edge").alias("edge"), "q", "code")
    on = (F.col("face") == F.col("_f")) & (F.col("level") == F.col("_l")) & (F.col("morton") == F.col("_m"))
    out = core.unionByName(ring(given.join(there, on, "left_semi")))
    corner = samples.filter(F.col("x").isin(0, cells) & F.col("y").isin(0, cells)).select(*KEY, F.when(F.col("y") == 0, 0).otherwise(cells + 2).alias("y"), F.when(F.col("x") == 0, 0).otherwise(cells + 2).alias("x"), "code")
    out = out.unionByName(corner)
    if sampler is None:
        return out
    at = topology.neighbors(tiles.withColumns({"x": keys.x_of(F.col("morton")), "y": keys.y_of(F.col("morton"))}))
    at = at.withColumn("nbr_morton", keys.morton(F.col("nbr_x"), F.col("nbr_y")))
    open_ = at.join(there, (F.col("nbr_face") == F.col("_f")) & (F.col("level") == F.col("_l")) & (F.col("nbr_morton") == F.col("_m")), "left_anti")
    open_ = open_.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(cells)))).withColumn("q", F.when(F.col("reversed"), cells - F.col("p")).otherwise(F.col("p")))
    t, p = F.col("touching"), F.col("p")
    i = F.when(t == 0, 1).when(t == 1, cells - 1).otherwise(p)
    j = F.when(t == 2, 1).when(t == 3, cells - 1).otherwise(p)
    span = cells * keys.axis(F.col("level"))
    place = {n: ((2 * (F.col(f"nbr_{a}") * cells + k) - span).cast("double") / span) for n, a, k in (("u", "x", i), ("v", "y", j))}
    # The sampler sees the neighbour's face; the tile's own waits under another name.
    asked = open_.select(F.col("face").alias("_face"), "level", "morton", "edge", "q", F.col("nbr_face").alias("face"), *[c.alias(n) for n, c in place.items()])
    return out.unionByName(ring(sampler(asked).drop("face").withColumnRenamed("_face", "face")))


def ancestor_error(samples: DataFrame, cells: int) -> DataFrame:
    """Per tile with a tile above it: the nearest one's level, and max_error, the largest difference from the surface that bilinear interpolation of its samples gives."""
    tiles = samples.select(*KEY).distinct()
    near = index.nearest_ancestor(tiles, tiles)
    down = F.col("level") - F.col("anc_level")
    step = keys.axis(down).cast("double")
    at = samples.join(near, list(KEY))
    for n, coord in (("x", keys.x_of), ("y", keys.y_of)):
        place = (coord(F.col("morton")) * cells + F.col(n)) / step - coord(F.col("anc_morton")) * cells
        low = F.least(F.floor(place), F.lit(cells - 1).cast("long"))
        at = at.withColumns({f"_{n}0": low.cast("int"), f"_{n}f": place - low})
    weight = lambda f, k: F.col(f) if k else 1 - F.col(f)
    corners = [F.struct((F.col("_x0") + i).alias("cx"), (F.col("_y0") + j).alias("cy"), (weight("_xf", i) * weight("_yf", j)).alias("w")) for i in (0, 1) for j in (0, 1)]
    rows = at.select(*KEY, "anc_level", "anc_morton", "y", "x", F.col("code").alias("_own"), F.explode(F.array(*corners)).alias("c")).select("*", "c.*").filter("w > 0")
    above = samples.select("face", F.col("level").alias("anc_level"), F.col("morton").alias("anc_morton"), F.col("y").alias("cy"), F.col("x").alias("cx"), F.col("code").alias("_up"))
    seen = rows.join(above, ["face", "anc_level", "anc_morton", "cy", "cx"])
    each = seen.groupBy(*KEY, "anc_level", "y", "x", "_own").agg(F.sum(F.col("w") * F.col("_up")).alias("_up"))
    return each.groupBy(*KEY, "anc_level").agg(F.max(F.abs(F.col("_own") - F.col("_up"))).alias("max_error"))


def geometric_error(fine: DataFrame, coarse: DataFrame) -> DataFrame:
    """Per tile, the largest difference of code from a coarser version on the same samples."""
    c = coarse.select(*KEY, "y", "x", F.col("code").alias("_c"))
    return fine.join(c, [*KEY, "y", "x"]).groupBy(*KEY).agg(F.max(F.abs(F.col("code") - F.col("_c"))).alias("max_error"))
