"""The tile index: a row for each tile, keyed by (face, level, morton).

Queries below a root are range predicates on plain columns, so a table written
partitioned by face and level and sorted by morton is pruned by them. Joins with
many roots go over ancestors as equal keys, never over ranges.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetlake.functions import keys, topology

KEY = ("face", "level", "morton")


def build_index(samples: DataFrame, code: str = "code") -> DataFrame:
    """Per tile of samples (face, level, morton, code): n, min_code, max_code, sum_code; nulls of code are not counted."""
    return samples.groupBy(*KEY).agg(F.count(code).alias("n"), F.min(code).alias("min_code"), F.max(code).alias("max_code"), F.sum(F.col(code).cast("long")).alias("sum_code"))


def write_index(index: DataFrame, path: str) -> None:
    """Parquet by face and level, each file sorted by morton over a range of its own."""
    index.repartitionByRange("face", "level", "morton").sortWithinPartitions(*KEY).write.partitionBy("face", "level").mode("overwrite").parquet(path)


def find(index: DataFrame, face: int, level: int, morton: int) -> DataFrame:
    """The row of one key; none if the tile is not there."""
    return index.filter((F.col("face") == face) & (F.col("level") == level) & (F.col("morton") == morton))


def subtree(index: DataFrame, face: int, level: int, morton: int, deepest: int | None = None) -> DataFrame:
    """A root, if it is a tile, and all tiles below it.

    With the index's deepest level given, each level's range of Morton codes is a constant that reaches the
    scan of a written table; without it, one shift of the code is compared.
    """
    below = keys.in_subtree(F.col("face"), F.col("level"), F.col("morton"), F.lit(face), F.lit(level), F.lit(morton))
    if deepest is not None:
        below = F.lit(False)
        for deep in range(level, deepest + 1):
            lo = morton << 2 * (deep - level)
            below = below | ((F.col("level") == deep) & F.col("morton").between(lo, lo + (1 << 2 * (deep - level)) - 1))
    return index.filter((F.col("face") == face) & (F.col("level") >= level) & below)


def subtrees(index: DataFrame, roots: DataFrame) -> DataFrame:
    """Tiles below each of many roots (root_face, root_level, root_morton): an equi-join over the tiles' ancestors."""
    up = index.withColumn("_up", F.explode(keys.ancestors(F.col("level"), F.col("morton"))))
    on = (F.col("face") == F.col("root_face")) & (F.col("_up.level") == F.col("root_level")) & (F.col("_up.morton") == F.col("root_morton"))
    return up.join(roots, on).drop("_up")


def children_of(index: DataFrame, parents: DataFrame) -> DataFrame:
    """The tiles of index right below each of parents (face, level, morton), with parent_level and parent_morton and quadrant."""
    level, m = keys.parent(F.col("level"), F.col("morton"))
    below = index.withColumns({"parent_level": level, "parent_morton": m, "quadrant": keys.quadrant(F.col("morton"))})
    p = parents.select(F.col("face").alias("_f"), F.col("level").alias("_l"), F.col("morton").alias("_m"))
    return below.join(p, (F.col("face") == F.col("_f")) & (F.col("parent_level") == F.col("_l")) & (F.col("parent_morton") == F.col("_m"))).drop("_f", "_l", "_m")


def child_masks(index: DataFrame) -> DataFrame:
    """Per parent of some tile: child_mask, a bit for each quadrant that is there."""
    level, m = keys.parent(F.col("level"), F.col("morton"))
    bit = keys.left(F.lit(1), keys.quadrant(F.col("morton")))
    below = index.filter("level > 0").select("face", level.alias("level"), m.alias("morton"), bit.alias("bit"))
    return below.groupBy(*KEY).agg(F.bit_or("bit").alias("child_mask"))


def _families(index: DataFrame) -> DataFrame:
    """A row for each key that is a tile or the parent of one: _own (the tile's other columns, null if there is none), child_mask.

    Tiles and marks for their parents meet in one aggregate, so that the index is computed once.
    """
    others = [c for c in index.columns if c not in KEY and c != "child_mask"]
    level, m = keys.parent(F.col("level"), F.col("morton"))
    own = F.struct(F.lit(True).alias("_there"), *others)
    tile = F.struct("face", "level", "morton", own.alias("_own"), F.lit(0).alias("bit"))
    mark = F.struct("face", level.alias("level"), m.alias("morton"), F.when(F.lit(False), own).alias("_own"), keys.left(F.lit(1), keys.quadrant(F.col("morton"))).alias("bit"))
    rows = index.select(F.explode(F.array(tile, mark)).alias("r")).select("r.*").filter("level is not null")
    return rows.groupBy(*KEY).agg(F.first("_own", ignorenulls=True).alias("_own"), F.bit_or("bit").alias("child_mask"))


def with_child_mask(index: DataFrame) -> DataFrame:
    """index, whose keys are distinct, with child_mask as its tiles give it; 0 for a leaf."""
    names = [c for c in index.columns if c != "child_mask"]
    return _families(index).filter("_own is not null").select(*[c if c in KEY else F.col(f"_own.{c}").alias(c) for c in names], "child_mask")


def leaves(index: DataFrame, stored: str | None = None) -> DataFrame:
    """Tiles without children: by a stored mask column, trusted as it is, or by the tiles themselves, whose keys are distinct."""
    if stored:
        return index.filter(F.col(stored) == 0)
    own = index.drop("child_mask") if "child_mask" not in index.columns else index.withColumnRenamed("child_mask", "_mask")
    out = with_child_mask(own).filter("child_mask = 0").drop("child_mask")
    return out.withColumnRenamed("_mask", "child_mask").select(*index.columns)


def orphans(index: DataFrame) -> DataFrame:
    """Tiles below level 0, of distinct keys, whose parent is missing: a parent's key meets its up to four children in one aggregate."""
    level, m = keys.parent(F.col("level"), F.col("morton"))
    child = F.struct(*index.columns)
    tile = F.struct("face", "level", "morton", F.when(F.lit(False), child).alias("child"))
    below = F.struct("face", level.alias("level"), m.alias("morton"), child.alias("child"))
    rows = index.select(F.explode(F.array(tile, below)).alias("r")).select("r.*").filter("level is not null")
    families = rows.groupBy(*KEY).agg(F.max(F.col("child").isNull()).alias("there"), F.collect_list("child").alias("children"))
    return families.filter("not there").select(F.explode("children").alias("c")).select("c.*")


def with_ancestors(tiles: DataFrame) -> DataFrame:
    """The distinct keys of tiles and of all above them."""
    up = tiles.select("face", F.explode(keys.ancestors(F.col("level"), F.col("morton"))).alias("a"))
    return up.select("face", F.col("a.level").alias("level"), F.col("a.morton").alias("morton")).distinct()


def nearest_ancestor(tiles: DataFrame, index: DataFrame) -> DataFrame:
    """Per key of tiles: anc_level and anc_morton of the deepest tile of index strictly above it, if any."""
    up = tiles.select(*KEY).distinct().withColumn("a", F.explode(keys.ancestors(F.col("level"), F.col("morton")))).filter("a.level < level")
    there = index.select(F.col("face").alias("_f"), F.col("level").alias("_l"), F.col("morton").alias("_m")).distinct()
    hit = up.join(there, (F.col("face") == F.col("_f")) & (F.col("a.level") == F.col("_l")) & (F.col("a.morton") == F.col("_m")))
    best = hit.groupBy(*KEY).agg(F.max(F.struct(F.col("a.level").alias("level"), F.col("a.morton").alias("morton"))).alias("b"))
    return best.select(*KEY, F.col("b.level").alias("anc_level"), F.col("b.morton").alias("anc_morton"))


#: Bits of a Morton code below which a window runs: 65,536 tiles at most.
WINDOW_BITS = 16


def running(tiles: DataFrame, size: Column, name: str, deepest: int = keys.MAX_LEVEL, bits: int = 0) -> DataFrame:
    """tiles, of distinct keys, with the sum of size over the tiles before each of its face and level, in Morton order.

    Windows run over ranges of at most 2**WINDOW_BITS codes, whose sums are run over in the same way; `deepest` is the
    deepest level that there may be, and spares ranges that cannot be.
    """
    part = keys.right(F.col("morton"), WINDOW_BITS)
    w = Window.partitionBy("face", "level", "_part").orderBy("morton").rowsBetween(Window.unboundedPreceding, -1)
    rows = tiles.withColumns({"_size": size, "_part": part})
    rows = rows.withColumn(name, F.coalesce(F.sum("_size").over(w), F.lit(0)))
    if 2 * deepest - bits <= WINDOW_BITS:
        return rows.drop("_part", "_size")
    sums = rows.groupBy("face", "level", F.col("_part").alias("morton")).agg(F.sum("_size").alias("_sum"))
    before = f"_before{bits}"
    sums = running(sums, F.col("_sum"), before, deepest, bits + WINDOW_BITS).select("face", "level", F.col("morton").alias("_part"), before)
    return rows.join(sums, ["face", "level", "_part"]).withColumn(name, F.col(name) + F.col(before)).select(*tiles.columns, name)


def pack_groups(index: DataFrame, target: Column | int, size: str = "stored_bytes", deepest: int = keys.MAX_LEVEL) -> DataFrame:
    """Packs by face and level: a tile starts in the pack that its bytes so far, in Morton order, divided by target, number."""
    return running(index, F.col(size), "_bytes", deepest).withColumn("pack_part", F.floor(F.col("_bytes") / target).cast("long")).drop("_bytes")


def pack_ids(tiles: DataFrame, deepest: int = keys.MAX_LEVEL) -> DataFrame:
    """tiles, of distinct keys, with pack_id, their number from 0 by (face, level, morton); a window runs over the faces and levels, 174 at most."""
    own = running(tiles, F.lit(1).cast("long"), "_at", deepest)
    sums = tiles.groupBy("face", "level").agg(F.count("*").alias("_n"))
    w = Window.orderBy("face", "level").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_first", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    return own.join(F.broadcast(sums), ["face", "level"]).withColumn("pack_id", F.col("_first") + F.col("_at")).drop("_first", "_at").select(*tiles.columns, "pack_id")


def adequate_level(resolution: Column, radius: float = 1737400.0, cells: int = 256, distortion: float = 1.0) -> Column:
    """The coarsest level whose samples, a quarter of the circumference over cells * 2^level of them, stretched by distortion, lie no further apart than resolution; null for none above 0."""
    spacing = F.lit(radius * pi / 2 * distortion / cells) / resolution
    return F.when((resolution > 0) & (resolution < float("inf")), F.greatest(F.lit(0), F.least(F.lit(keys.MAX_LEVEL), F.ceil(F.log2(spacing))))).cast("int")


def sparse_plan(footprints: DataFrame, level: Column) -> DataFrame:
    """Keys of the tiles to build: each footprint (face, level, morton) at the wanted level below it, or itself if that is above, and all ancestors."""
    down = F.greatest(level - F.col("level"), F.lit(0)).cast("int")
    first = keys.left(F.col("morton"), 2 * down)
    below = footprints.select("face", (F.col("level") + down).alias("level"), F.explode(F.sequence(first, first + keys.left(F.lit(1).cast("long"), 2 * down) - 1)).alias("morton"))
    return with_ancestors(below.distinct())


def balanced(tiles: DataFrame, deepest: int) -> DataFrame:
    """Leaves (face, level, morton) subdivided until no two that share an edge are more than one level apart, with derived: not in tiles.

    From the deepest level up, the parents of a level's neighbours must be tiles themselves where some leaf covers
    them; a tile that is needed comes with its siblings and those of all above it, up to that leaf. One round a
    level, none of which collects; where the session has a checkpoint folder, each cuts the lineage there.
    """
    cut = tiles.sparkSession.sparkContext.getCheckpointDir() is not None
    own = tiles.select(*KEY).distinct()
    roots = own.select(F.col("face").alias("_f"), F.col("level").alias("_l"), F.col("morton").alias("_m"))
    above = (F.col("face") == F.col("_f")) & (F.col("a.level") == F.col("_l")) & (F.col("a.morton") == F.col("_m"))
    up = F.explode(keys.ancestors(F.col("level"), F.col("morton"))).alias("a")

    def below_a_leaf(some: DataFrame) -> DataFrame:
        return some.select(*KEY, up).filter("a.level < level").join(roots, above, "left_semi").select(*KEY)

    nodes = with_ancestors(own)
    for level in range(deepest, 1, -1):
        at = nodes.filter(F.col("level") == level).withColumns({"x": keys.x_of(F.col("morton")), "y": keys.y_of(F.col("morton"))})
        beside = topology.neighbors(at).select(F.col("nbr_face").alias("face"), F.lit(level - 1).alias("level"), keys.right(keys.morton(F.col("nbr_x"), F.col("nbr_y")), 2).alias("morton"))
        needed = below_a_leaf(beside.distinct()).distinct().select("face", up).select("face", "a.level", "a.morton").filter("level > 0").distinct()
        first = 4 * keys.right(F.col("morton"), 2)
        siblings = needed.select("face", "level", F.explode(F.sequence(first, first + 3)).alias("morton")).distinct()
        nodes = nodes.unionByName(below_a_leaf(siblings)).distinct()
        nodes = nodes.checkpoint() if cut else nodes
    return leaves(nodes).join(own.withColumn("_own", F.lit(True)), list(KEY), "left").withColumn("derived", F.col("_own").isNull()).drop("_own")


def level_stats(index: DataFrame) -> DataFrame:
    """Tiles and code range by face and level, by face, and in all; null marks a total."""
    return index.rollup("face", "level").agg(F.count("*").alias("tiles"), F.min("min_code").alias("min_code"), F.max("max_code").alias("max_code"))


def diff(a: DataFrame, b: DataFrame, digest: str = "digest") -> DataFrame:
    """Keys whose digest differs between two indexes: change is added, removed or changed."""
    x, y = a.select(*KEY, F.col(digest).alias("_a"), F.lit(True).alias("_x")), b.select(*KEY, F.col(digest).alias("_b"), F.lit(True).alias("_y"))
    both = x.join(y, list(KEY), "full_outer")
    change = F.when(F.col("_x").isNull(), "added").when(F.col("_y").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return both.select(*KEY, change.alias("change")).filter("change is not null")


def to_rebuild(wanted: DataFrame, built: DataFrame, digest: str = "digest") -> DataFrame:
    """Tiles whose dependency digest is not that of the tile built before: what an incremental build must make."""
    return wanted.join(built.select(*KEY, digest), [*KEY, digest], "left_anti")
