"""Edges of the six faces: which meet, who owns them, and neighbours across them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetlake.functions import keys

#: Of each face, 0 to 5, over its west, east, south and north edge, 0 to 3: face, edge, the face
#: there, the edge of that face, and whether the samples along it run the other way.
ROWS = [
    (0, 0, 3, 1, False),
    (0, 1, 1, 0, False),
    (0, 2, 5, 3, False),
    (0, 3, 4, 2, False),
    (1, 0, 0, 1, False),
    (1, 1, 2, 0, False),
    (1, 2, 5, 1, True),
    (1, 3, 4, 1, False),
    (2, 0, 1, 1, False),
    (2, 1, 3, 0, False),
    (2, 2, 5, 2, True),
    (2, 3, 4, 3, True),
    (3, 0, 2, 1, False),
    (3, 1, 0, 0, False),
    (3, 2, 5, 0, False),
    (3, 3, 4, 0, True),
    (4, 0, 3, 3, True),
    (4, 1, 1, 3, False),
    (4, 2, 0, 3, False),
    (4, 3, 2, 3, True),
    (5, 0, 3, 2, False),
    (5, 1, 1, 2, True),
    (5, 2, 2, 2, True),
    (5, 3, 0, 2, False),
]


def topology(spark: SparkSession) -> DataFrame:
    """The 24 edges: face, edge, nbr_face, nbr_edge, reversed."""
    return spark.createDataFrame(ROWS, "face int, edge int, nbr_face int, nbr_edge int, reversed boolean")


def _table(field: int, face: Column, edge: Column) -> Column:
    return F.element_at(F.array(*[F.lit(r[field]) for r in ROWS]), face * 4 + edge + 1)


def nbr_face(face: Column, edge: Column) -> Column:
    return _table(2, face, edge)


def nbr_edge(face: Column, edge: Column) -> Column:
    return _table(3, face, edge)


def is_reversed(face: Column, edge: Column) -> Column:
    return _table(4, face, edge)


def owns_edge(face: Column, edge: Column) -> Column:
    """The face of the smaller number owns an edge."""
    return face < nbr_face(face, edge)


def corner_owner(face: Column, u_edge: Column, v_edge: Column) -> Column:
    """The least of the three faces at a corner of a west or east with a south or north edge."""
    corner = u_edge.isin(0, 1) & v_edge.isin(2, 3)
    return F.when(corner, F.least(face, nbr_face(face, u_edge), nbr_face(face, v_edge))).otherwise(face)


def across(edges: DataFrame) -> DataFrame:
    """For each row (face, level, x, y, edge, ...) the tile of the same level over that edge: nbr_face, nbr_x, nbr_y, touching, reversed."""
    last = keys.axis(F.col("level")) - 1
    x, y, e = F.col("x"), F.col("y"), F.col("edge")
    inside = F.when(e == 0, x > 0).when(e == 1, x < last).when(e == 2, y > 0).otherwise(y < last)
    out = edges.withColumn("_in", inside).withColumn("touching", F.when(F.col("_in"), F.element_at(F.array(*map(F.lit, (1, 0, 3, 2))), e + 1)).otherwise(nbr_edge(F.col("face"), e)))
    out = out.withColumn("reversed", F.when(F.col("_in"), F.lit(False)).otherwise(is_reversed(F.col("face"), e)))
    along = F.when(e < 2, y).otherwise(x)
    along = F.when(F.col("reversed"), last - along).otherwise(along)
    t = F.col("touching")
    out = out.withColumn("nbr_face", F.when(F.col("_in"), F.col("face")).otherwise(nbr_face(F.col("face"), e)))
    out = out.withColumn("nbr_x", F.when(F.col("_in"), x + F.when(e == 0, -1).when(e == 1, 1).otherwise(0)).when(t == 0, 0).when(t == 1, last).otherwise(along))
    out = out.withColumn("nbr_y", F.when(F.col("_in"), y + F.when(e == 2, -1).when(e == 3, 1).otherwise(0)).when(t == 2, 0).when(t == 3, last).otherwise(along))
    return out.withColumn("nbr_x", F.col("nbr_x").cast("long")).withColumn("nbr_y", F.col("nbr_y").cast("long")).drop("_in")


def neighbors(tiles: DataFrame) -> DataFrame:
    """For each row (face, level, x, y, ...) four more columns by edge: nbr_face, nbr_x, nbr_y, touching, reversed."""
    return across(tiles.withColumn("edge", F.explode(F.array(*[F.lit(e) for e in range(4)]))))


def touching_pairs(tiles: DataFrame) -> DataFrame:
    """Pairs of tiles (face, level, x, y) that both exist and share an edge, each once: with edge, nbr_face, nbr_x, nbr_y."""
    own = tiles.select("face", "level", "x", "y").distinct()
    there = own.select(F.col("face").alias("nbr_face"), "level", F.col("x").alias("nbr_x"), F.col("y").alias("nbr_y"))
    return neighbors(own).join(there, ["nbr_face", "level", "nbr_x", "nbr_y"], "left_semi").filter("(face, x, y) < (nbr_face, nbr_x, nbr_y)")


def shared_node(face: Column, level: Column, gx: Column, gy: Column, cells: int) -> Column:
    """Struct (face, gx, gy) of a lattice node of a level, 0 to cells * 2^level: of its places on all faces it lies on, the least."""
    n = cells * keys.axis(level)
    places = [F.struct(face.cast("int").alias("face"), gx.alias("gx"), gy.alias("gy"))]
    for edge, (at, end, along) in enumerate(((gx, F.lit(0), gy), (gx, n, gy), (gy, F.lit(0), gx), (gy, n, gx))):
        e = F.lit(edge)
        to, q = nbr_edge(face, e), F.when(is_reversed(face, e), n - along).otherwise(along)
        x = F.when(to == 0, F.lit(0).cast("long")).when(to == 1, n).otherwise(q)
        y = F.when(to == 2, F.lit(0).cast("long")).when(to == 3, n).otherwise(q)
        places.append(F.when(at == end, F.struct(nbr_face(face, e).cast("int").alias("face"), x.cast("long").alias("gx"), y.cast("long").alias("gy"))))
    return F.least(*places)
