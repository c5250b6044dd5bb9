"""Queries over the tile index and its hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.functions import keys
from facetlake.operators import index
from facetlake.plans.carriers import LEVELS, TILES, hexed, levels, query, table, tiles

INDEX = "idx as (select face, level, morton, count(code) n, min(code) min_code, max(code) max_code, sum(code)::bigint sum_code from {src} group by all)"
IDX4, IDXL = INDEX.format(src="tiles"), INDEX.format(src="levels")


def index4(spark, sf_dir) -> DataFrame:
    return index.build_index(tiles(spark, sf_dir))


def index_levels(spark, sf_dir) -> DataFrame:
    return index.build_index(levels(spark, sf_dir))


@query(f"with {TILES}, {IDX4} select *, {hexed()} key_hex from idx")
def tile_index_build(spark, sf_dir) -> DataFrame:
    return index4(spark, sf_dir).withColumn("key_hex", keys.key_hex(F.col("face"), F.col("level"), F.col("morton")))


@query(f"with {TILES}, {IDX4} select * from idx where face = 2 and level = 4 and morton = 80 union all select * from idx where face = 2 and level = 5 and morton = 80")
def tile_lookup(spark, sf_dir) -> DataFrame:
    own = index4(spark, sf_dir)
    return index.find(own, 2, 4, 80).unionByName(index.find(own, 2, 5, 80))


@query(f"with {LEVELS}, {IDXL} select * from idx where face = 2 and level >= 2 and (morton >> (2 * (level - 2))::int) = 5")
def subtree(spark, sf_dir) -> DataFrame:
    return index.subtree(index_levels(spark, sf_dir), 2, 2, 5)


def _below(spark, sf_dir, roots: DataFrame) -> DataFrame:
    roots = roots.select(F.col("face").alias("root_face"), F.col("level").alias("root_level"), F.col("morton").alias("root_morton")).distinct()
    return index.subtrees(index_levels(spark, sf_dir), roots).groupBy("root_face", "root_level", "root_morton").agg(F.count("*").alias("tiles"), F.sum("n").alias("n"))


@query(f"""with {LEVELS}, {IDXL}, roots as (select distinct face, level, morton from levels where level in (1, 2))
select r.face root_face, r.level root_level, r.morton root_morton, count(*) tiles, sum(n)::bigint n from roots r join idx i
on i.face = r.face and i.level >= r.level and (i.morton >> (2 * greatest(i.level - r.level, 0))::int) = r.morton group by all""")
def subtree_multi_join(spark, sf_dir) -> DataFrame:
    return _below(spark, sf_dir, levels(spark, sf_dir).filter("level in (1, 2)"))


@query(f"with {LEVELS}, {IDXL} select face, level, morton, n from idx where face = 1 and (n % 4) = 0")
def leaves_stored(spark, sf_dir) -> DataFrame:
    own = index_levels(spark, sf_dir).withColumn("child_mask", F.col("n") % 4)
    return index.leaves(index.subtree(own, 1, 0, 0), "child_mask").select("face", "level", "morton", "n")


@query(f"with {LEVELS}, {IDXL} select face, level, morton from idx i where not exists (select 1 from idx c where c.face = i.face and c.level = i.level + 1 and (c.morton >> 2) = i.morton)")
def leaves_computed(spark, sf_dir) -> DataFrame:
    return index.leaves(index_levels(spark, sf_dir)).select("face", "level", "morton")


@query(f"""with {LEVELS}, {IDXL} select i.face, i.level, i.morton, coalesce(bit_or((1 << (c.morton & 3)::int)), 0)::int child_mask
from idx i left join idx c on c.face = i.face and c.level = i.level + 1 and (c.morton >> 2) = i.morton group by all""")
def child_mask(spark, sf_dir) -> DataFrame:
    return index.with_child_mask(index_levels(spark, sf_dir)).select("face", "level", "morton", "child_mask")


@query(f"""with {LEVELS}, {IDXL}, sparse as (select * from idx where n % 3 > 0)
select face, level, morton from sparse s where level > 0 and not exists (select 1 from sparse p where p.face = s.face and p.level = s.level - 1 and p.morton = (s.morton >> 2))""")
def orphans(spark, sf_dir) -> DataFrame:
    return index.orphans(index_levels(spark, sf_dir).filter("n % 3 > 0")).select("face", "level", "morton")


@query(f"""with {LEVELS}, {IDXL}, p as (select * from idx where level between 1 and 2)
select c.face, c.level, c.morton, (c.level - 1)::int parent_level, (c.morton >> 2) parent_morton, (c.morton & 3)::int quadrant from idx c join p on p.face = c.face and p.level = c.level - 1 and p.morton = (c.morton >> 2)""")
def children_join(spark, sf_dir) -> DataFrame:
    own = index_levels(spark, sf_dir)
    return index.children_of(own, own.filter("level between 1 and 2")).select("face", "level", "morton", "parent_level", "parent_morton", "quadrant")


@query(f"with {TILES} select distinct face, (level - u)::int as level, (morton >> (2 * u)::int) morton from tiles, range(5) t(u)")
def sparse_plan(spark, sf_dir) -> DataFrame:
    return index.with_ancestors(tiles(spark, sf_dir))


@query(f"""with {LEVELS}, {IDXL}, there as (select * from idx where n % 2 = 0)
select i.face, i.level, i.morton, max(t.level) anc_level, arg_max(t.morton, t.level) anc_morton from idx i join there t on t.face = i.face and t.level < i.level and t.morton = (i.morton >> (2 * greatest(i.level - t.level, 0))::int) group by all""")
def nearest_ancestor(spark, sf_dir) -> DataFrame:
    own = index_levels(spark, sf_dir)
    return index.nearest_ancestor(own, own.filter("n % 2 = 0"))


@query(f"with {LEVELS}, {IDXL} select face, level, count(*) tiles, min(min_code) min_code, max(max_code) max_code from idx group by rollup (face, level)")
def level_stats(spark, sf_dir) -> DataFrame:
    return index.level_stats(index_levels(spark, sf_dir))


@query(f"""with {TILES}, {IDX4} select face, level, morton, floor((sum(n * 100) over (partition by face, level order by morton) - n * 100) / 1000)::bigint pack_part from idx""")
def pack_rollover(spark, sf_dir) -> DataFrame:
    own = index4(spark, sf_dir).withColumn("stored_bytes", F.col("n") * 100)
    return index.pack_groups(own, 1000, deepest=4).select("face", "level", "morton", "pack_part")


@query(f"with {LEVELS}, {IDXL} select face, level, morton, row_number() over (order by face, level, morton) - 1 pack_id from idx")
def pack_ids(spark, sf_dir) -> DataFrame:
    return index.pack_ids(index_levels(spark, sf_dir)).select("face", "level", "morton", "pack_id")


FOOT = "foot as (select (s_suppkey % 6)::int face, 2::int as level, (s_suppkey % 16)::bigint morton, 3000.0::double / (1 + s_suppkey % 7) resolution from supplier)"


@query(f"""with {FOOT}, want as (select *, greatest(0, least(28, ceil(log2(1737400 * pi() / 2 / 256 / resolution))))::int deep from foot),
below as (select face, greatest(level, deep) as level, (morton << (2 * greatest(deep - level, 0))) + i morton from want, unnest(range(1::bigint << (2 * greatest(deep - level, 0)))) t(i))
select distinct face, (level - up)::int as level, morton >> (2 * up)::int morton from below, range(29) t(up) where up <= level""")
def footprint_plan(spark, sf_dir) -> DataFrame:
    s, k = table(spark, sf_dir, "supplier", "s_suppkey"), F.col("s_suppkey")
    foot = s.select((k % 6).cast("int").alias("face"), F.lit(2).alias("level"), (k % 16).alias("morton"), (F.lit(3000.0) / (1 + k % 7)).alias("resolution"))
    return index.sparse_plan(foot, index.adequate_level(F.col("resolution")))


@query(f"""with {TILES}, {IDX4}, a as (select face, level, morton, sum_code from idx where morton % 5 > 0), b as (select face, level, morton, case when morton % 7 = 0 then sum_code + 1 else sum_code end sum_code from idx where morton % 3 > 0)
select face, level, morton, case when a.sum_code is null then 'added' when b.sum_code is null then 'removed' else 'changed' end change from a full join b using (face, level, morton) where a.sum_code is distinct from b.sum_code""")
def index_diff(spark, sf_dir) -> DataFrame:
    own = index4(spark, sf_dir)
    a, b = own.filter("morton % 5 > 0"), own.filter("morton % 3 > 0").withColumn("sum_code", F.when(F.col("morton") % 7 == 0, F.col("sum_code") + 1).otherwise(F.col("sum_code")))
    return index.diff(a, b, "sum_code")


@query(f"""with {TILES}, {IDX4} select face, level, morton, sum_code from idx where not (morton % 7 > 0 and morton % 3 > 0)""")
def incremental_anti(spark, sf_dir) -> DataFrame:
    own = index4(spark, sf_dir)
    built = own.filter("morton % 3 > 0").withColumn("sum_code", F.when(F.col("morton") % 7 == 0, F.col("sum_code") + 1).otherwise(F.col("sum_code")))
    return index.to_rebuild(own, built, "sum_code").select("face", "level", "morton", "sum_code")


@query(f"with {TILES}, {IDX4} select * from idx")
def union_roots(spark, sf_dir) -> DataFrame:
    own = index4(spark, sf_dir)
    out = None
    for face in range(6):
        part = index.subtree(own, face, 0, 0)
        out = part if out is None else out.unionByName(part)
    return out


def _covered(spark, sf_dir, li: DataFrame) -> DataFrame:
    cov = li.select(F.col("l_suppkey").alias("dataset"), (F.col("l_orderkey") % 6).cast("int").alias("root_face"), F.lit(2).alias("root_level"), (F.col("l_partkey") % 16).alias("root_morton")).distinct()
    return index.subtrees(index4(spark, sf_dir), cov).groupBy("dataset", "face").agg(F.countDistinct("morton").alias("tiles"))


@query(f"""with {TILES}, {IDX4}, cov as (select l_suppkey dataset, (l_orderkey % 6)::int face, 2 as level, (l_partkey % 16)::bigint morton from lineitem)
select dataset, i.face, count(distinct i.morton) tiles from (select distinct * from cov) c join idx i on i.face = c.face and (i.morton >> 4) = c.morton group by all""")
def coverage_join(spark, sf_dir) -> DataFrame:
    return _covered(spark, sf_dir, table(spark, sf_dir, "lineitem", "l_suppkey", "l_orderkey", "l_partkey"))


@query(f"""with {LEVELS}, {IDXL}, leaf as (select face, level, morton, min_code from idx i where not exists (select 1 from idx c where c.face = i.face and c.level = i.level + 1 and (c.morton >> 2) = i.morton))
select face, level, morton from leaf where face in (0, 3) and level between 1 and 3 and min_code < 40000""")
def region_request(spark, sf_dir) -> DataFrame:
    return index.leaves(index_levels(spark, sf_dir)).filter("face in (0, 3) and level between 1 and 3 and min_code < 40000").select("face", "level", "morton")


@query(f"""with {TILES}, {IDX4} select count(*) tiles, count(*) * (259 * 259 * 2 + 32) logical_bytes, min({hexed()}) first_key, max({hexed()}) last_key from idx""")
def plan_estimate(spark, sf_dir) -> DataFrame:
    hex_ = keys.key_hex(F.col("face"), F.col("level"), F.col("morton"))
    return index4(spark, sf_dir).agg(F.count("*").alias("tiles"), (F.count("*") * (259 * 259 * 2 + 32)).alias("logical_bytes"), F.min(hex_).alias("first_key"), F.max(hex_).alias("last_key"))
