"""Queries over rasters, seams and fusion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.functions import topology
from facetlake.operators import fusion, raster
from facetlake.plans.carriers import LEVELS, TOPOLOGY, grid, grid_sql, levels, quads, quads_sql, query, table

CELLS = 16
GRID = grid_sql(CELLS)
WIN = "window r as (partition by face, y order by x), c as (partition by face, x order by y)"
EDGES = f"""edges as (select face, 0 edge, y p, code from grid where x = 0 union all select face, 1, y, code from grid where x = {CELLS}
  union all select face, 2, x, code from grid where y = 0 union all select face, 3, x, code from grid where y = {CELLS})"""


@query(f"""with {GRID}, d as (select *, lag(code) over r as l, lag(code) over c as a from grid {WIN})
select g.face, g.y, g.x, (((d.code - case when g.x = 0 and g.y = 0 then 0 when g.y = 0 then d.l when g.x = 0 then d.a else d.l + d.a - u.code end) % 65536 + 65536) % 65536)::int residual
from grid g join d using (face, y, x) left join grid u on u.face = g.face and u.y = g.y - 1 and u.x = g.x - 1""")
def delta2d_encode(spark, sf_dir) -> DataFrame:
    return raster.delta2d(grid(spark, sf_dir)).select("face", "y", "x", "residual")


@query(f"with {GRID} select face, y, x, code from grid")
def delta2d_decode(spark, sf_dir) -> DataFrame:
    return raster.undelta2d(raster.delta2d(grid(spark, sf_dir)).drop("code")).select("face", "y", "x", "code")


def _taps(v: str, w: str) -> str:
    taps = [f"lag({v}, 2) over {w}", f"lag({v}) over {w}", v, f"lead({v}) over {w}", f"lead({v}, 2) over {w}"]
    total = " + ".join(f"(case when {t} is null then 0 else {n} end)" for t, n in zip(taps, (1, 4, 6, 4, 1), strict=True))
    sums = " + ".join(f"coalesce({t}, 0) * {n}" for t, n in zip(taps, (1, 4, 6, 4, 1), strict=True))
    return f"case when {total} >= 8 then ({sums}) / ({total}) end"


HOLES = "holes as (select face, y, x, case when (y * 17 + x) % 3 = 0 and face < 2 then null else code::double end v from grid)"


@query(f"""with {GRID}, {HOLES}, h as (select *, {_taps("v", "r")} h from holes {WIN}), s as (select *, {_taps("h", "c")} s from h {WIN})
select face, y, x, round(coalesce(s, v) * 1000)::bigint smooth from s""")
def lowpass5(spark, sf_dir) -> DataFrame:
    own = grid(spark, sf_dir).withColumn("v", F.when(((F.col("y") * 17 + F.col("x")) % 3 == 0) & (F.col("face") < 2), None).otherwise(F.col("code").cast("double")))
    return raster.low_pass(own, "v").select("face", "y", "x", F.round(F.col("smooth") * 1000).cast("long").alias("smooth"))


@query(f"with {GRID}, d as (select *, least(y, x, {CELLS} - y, {CELLS} - x) / 6.0::double t from grid) select face, y, x, round(least(1, t) * least(1, t) * (3 - 2 * least(1, t)) * 1e9)::bigint w from d")
def smoothstep(spark, sf_dir) -> DataFrame:
    d = F.least("y", "x", CELLS - F.col("y"), CELLS - F.col("x"))
    return grid(spark, sf_dir).select("face", "y", "x", F.round(raster.smoothstep(d, 6) * 1e9).cast("long").alias("w"))


SEAMS = f"""seams as (select a.face, a.edge, t.nf nbr_face, t.ne nbr_edge, a.p, a.code, b.code nbr_code from edges a join topo t on t.face = a.face and t.edge = a.edge and a.face < t.nf
  join edges b on b.face = t.nf and b.edge = t.ne and b.p = case when t.rev then {CELLS} - a.p else a.p end)"""


@query(f"with {GRID}, {EDGES}, {TOPOLOGY}, {SEAMS} select face, edge, nbr_face, nbr_edge, count(*) n from seams group by all")
def seam_pairs(spark, sf_dir) -> DataFrame:
    return raster.seams(grid(spark, sf_dir), CELLS).groupBy("face", "edge", "nbr_face", "nbr_edge").agg(F.count("*").alias("n"))


@query(f"with {GRID}, {EDGES}, {TOPOLOGY}, {SEAMS} select face, edge, p::int p, code, nbr_code from seams where code <> nbr_code")
def seam_mismatch(spark, sf_dir) -> DataFrame:
    return raster.seams(grid(spark, sf_dir), CELLS).filter("code <> nbr_code").select("face", "edge", "p", "code", "nbr_code")


FIXED = f"""better as (select a.face, case a.edge when 0 then 0 when 1 then {CELLS} else a.p end x, case a.edge when 2 then 0 when 3 then {CELLS} else a.p end y, t.nf own_face, b.code own
  from edges a join topo t on t.face = a.face and t.edge = a.edge and t.nf < a.face join edges b on b.face = t.nf and b.edge = t.ne and b.p = case when t.rev then {CELLS} - a.p else a.p end),
fixed as (select g.face, g.y, g.x, coalesce(b.own, g.code) code from grid g left join (select face, x, y, arg_min(own, own_face) own from better group by all) b using (face, x, y))"""


@query(f"with {GRID}, {EDGES}, {TOPOLOGY}, {FIXED} select * from fixed")
def seam_resolve(spark, sf_dir) -> DataFrame:
    return raster.resolve_seams(grid(spark, sf_dir), CELLS).select("face", "y", "x", "code")


INNER = f"""inner_ as (select face, 0 edge, y p, code from grid where x = 1 union all select face, 1, y, code from grid where x = {CELLS} - 1
  union all select face, 2, x, code from grid where y = 1 union all select face, 3, x, code from grid where y = {CELLS} - 1)"""


@query(f"""with {GRID}, {INNER}, {TOPOLOGY} select face, y + 1 y, x + 1 x, code from grid
union all select t.face, case t.edge when 2 then 0 when 3 then {CELLS + 2} else p + 1 end, case t.edge when 0 then 0 when 1 then {CELLS + 2} else p + 1 end, code
  from topo t, lateral (select case when t.rev then {CELLS} - i.p else i.p end p, code from inner_ i where i.face = t.nf and i.edge = t.ne)
union all select face, case y when 0 then 0 else {CELLS + 2} end, case x when 0 then 0 else {CELLS + 2} end, code from grid where x in (0, {CELLS}) and y in (0, {CELLS})""")
def apron(spark, sf_dir) -> DataFrame:
    return raster.with_apron(grid(spark, sf_dir), CELLS).select("face", "y", "x", "code")


@query(f"with {GRID} select face, max(abs(a.code - b.code))::int max_error from grid a join grid b using (face) where b.y = a.y // 4 * 4 and b.x = a.x // 4 * 4 group by face")
def geometric_error(spark, sf_dir) -> DataFrame:
    own = grid(spark, sf_dir)
    coarse = own.filter("y % 4 = 0 and x % 4 = 0").select("face", "level", "morton", F.col("y").alias("cy"), F.col("x").alias("cx"), "code")
    near = own.select("face", "level", "morton", "y", "x", (F.col("y") - F.col("y") % 4).alias("cy"), (F.col("x") - F.col("x") % 4).alias("cx")).join(coarse, ["face", "level", "morton", "cy", "cx"])
    return raster.geometric_error(own, near).select("face", "max_error")


SOURCES = "src as (select l_orderkey % 500 cell, l_suppkey dataset, (l_suppkey % 3)::int priority, floor(l_extendedprice)::bigint v, (l_linenumber % 4 > 0) valid from lineitem)"


def _sources(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_extendedprice", "l_linenumber")
    return li.select((F.col("l_orderkey") % 500).alias("cell"), F.col("l_suppkey").alias("dataset"), (F.col("l_suppkey") % 3).cast("int").alias("priority"), F.floor("l_extendedprice").alias("v"), (F.col("l_linenumber") % 4 > 0).alias("valid"))


@query(f"with {SOURCES} select cell, v, dataset, priority from src where valid qualify row_number() over (partition by cell order by priority desc, dataset, v) = 1")
def fusion_replace(spark, sf_dir) -> DataFrame:
    return fusion.replace(_sources(spark, sf_dir).filter("valid"), ["cell"], "v", "dataset", "priority")


@query(f"""with {GRID}, fine as (select face, y, x, code + (y * x) % 7 f from grid), bias as (select face, (sum(f - code))::double / count(*) b from grid join fine using (face, y, x) group by face)
select face, y, x, round((f - b) * 1000)::bigint h from fine join bias using (face)""")
def fusion_bias(spark, sf_dir) -> DataFrame:
    own = grid(spark, sf_dir)
    fine = own.withColumn("f", F.col("code") + F.col("y") * F.col("x") % 7)
    return fusion.bias_corrected(fine, ["face"], "f", "code").select("face", "y", "x", F.round(F.col("h") * 1000).cast("long").alias("h"))


@query(f"""with {GRID}, fine as (select *, code::double + (y * x) % 7 v from grid), h as (select *, {_taps("v", "r")} h from fine {WIN}), s as (select *, {_taps("h", "c")} s from h {WIN})
select face, y, x, round((code + t * t * (3 - 2 * t) * (v - s)) * 1000)::bigint h from (select *, least(1, least(y, x, {CELLS} - y, {CELLS} - x) / 8.0::double) t from s)""")
def fusion_residual(spark, sf_dir) -> DataFrame:
    own = grid(spark, sf_dir)
    fine = own.withColumn("v", F.col("code") + F.col("y") * F.col("x") % 7)
    d = F.least("y", "x", CELLS - F.col("y"), CELLS - F.col("x"))
    return fusion.residual(fine, "code", "v", d, 8).select("face", "y", "x", F.round(F.col("h") * 1000).cast("long").alias("h"))


@query(f"""with {TOPOLOGY}, {GRID}, {EDGES}, {SEAMS} select count(distinct face * 4 + edge) seams, count(*) samples, count(*) filter (where code <> nbr_code) mismatches from seams""")
def seam_report(spark, sf_dir) -> DataFrame:
    s = raster.seams(grid(spark, sf_dir), CELLS)
    return s.agg(F.countDistinct(F.col("face") * 4 + F.col("edge")).alias("seams"), F.count("*").alias("samples"), F.count_if(F.col("code") != F.col("nbr_code")).alias("mismatches"))


QUADS = quads_sql(CELLS)
SPAN = 2 * CELLS


@query(f"""with {LEVELS}, {TOPOLOGY}, own as (select distinct face, level, x, y from levels),
e as (select l.*, edge, nf, ne, rev, (1::bigint << level) - 1 last, case edge when 0 then x > 0 when 1 then x < (1::bigint << level) - 1 when 2 then y > 0 else y < (1::bigint << level) - 1 end ins from own l join topo using (face)),
a as (select *, case when rev then last - (case when edge < 2 then y else x end) else (case when edge < 2 then y else x end) end along from e),
n as (select face, level, x, y, edge, case when ins then face else nf end f2, case when ins then x + (case edge when 0 then -1 when 1 then 1 else 0 end) when ne = 0 then 0 when ne = 1 then last else along end x2,
  case when ins then y + (case edge when 2 then -1 when 3 then 1 else 0 end) when ne = 2 then 0 when ne = 3 then last else along end y2 from a)
select n.level, edge, count(*) pairs from n join own o on o.face = f2 and o.level = n.level and o.x = x2 and o.y = y2 where (n.face, n.x, n.y) < (f2, x2, y2) group by all""")
def seams_of_tiles(spark, sf_dir) -> DataFrame:
    """Neighbouring tiles of the index that both exist, each pair once."""
    return topology.touching_pairs(levels(spark, sf_dir)).groupBy("level", "edge").agg(F.count("*").alias("pairs"))


#: Lattice nodes of level 1 that lie on an edge of a tile, with all places they have; the least names the node.
NODES = f"""near as (select * from quads where x in (0, {CELLS}) or y in (0, {CELLS})),
places as (select face, morton, y, x, code, face nf, gx ngx, gy ngy from near
  union all select q.face, morton, y, x, code, t.nf, case t.ne when 0 then 0 when 1 then {SPAN} else pos end, case t.ne when 2 then 0 when 3 then {SPAN} else pos end
  from (select q.*, t.nf, t.ne, case when t.rev then {SPAN} - (case when t.edge < 2 then gy else gx end) else (case when t.edge < 2 then gy else gx end) end pos
    from near q join topo t on t.face = q.face and ((t.edge = 0 and gx = 0) or (t.edge = 1 and gx = {SPAN}) or (t.edge = 2 and gy = 0) or (t.edge = 3 and gy = {SPAN}))) q join topo t on t.face = q.face and t.nf = q.nf and t.ne = q.ne),
named as (select face, morton, y, x, any_value(code) code, min(nf::bigint * 1000000 + ngx * 1000 + ngy) node from places group by face, morton, y, x),
owned as (select *, first_value(code) over (partition by node order by face, morton) own from named)"""


@query(f"""with {QUADS}, {TOPOLOGY}, {NODES} select q.face, q.morton, q.y, q.x, coalesce(o.own, q.code) code from quads q left join owned o using (face, morton, y, x)""")
def seam_resolve_quads(spark, sf_dir) -> DataFrame:
    return raster.resolve_seams(quads(spark, sf_dir, CELLS), CELLS).select("face", "morton", "y", "x", "code")


@query(f"""with {QUADS}, {TOPOLOGY}, e as (select face, morton, 0 edge, y p, code, morton % 2 tx, morton // 2 ty from quads where x = 0 union all select face, morton, 1, y, code, morton % 2, morton // 2 from quads where x = {CELLS}
  union all select face, morton, 2, x, code, morton % 2, morton // 2 from quads where y = 0 union all select face, morton, 3, x, code, morton % 2, morton // 2 from quads where y = {CELLS}),
n as (select e.*, case edge when 0 then tx > 0 when 1 then tx < 1 when 2 then ty > 0 else ty < 1 end ins, nf, ne, rev, case when rev then 1 - (case when edge < 2 then ty else tx end) else (case when edge < 2 then ty else tx end) end along from e join topo using (face, edge)),
m as (select face, morton, edge, p, code, case when ins then face else nf end f2, case when ins then [1, 0, 3, 2][edge + 1] else ne end e2, case when not ins and rev then {CELLS} - p else p end q,
  case when ins then tx + (case edge when 0 then -1 when 1 then 1 else 0 end) when ne = 0 then 0 when ne = 1 then 1 else along end x2, case when ins then ty + (case edge when 2 then -1 when 3 then 1 else 0 end) when ne = 2 then 0 when ne = 3 then 1 else along end y2 from n)
select m.face, m.morton, m.edge, f2 nbr_face, x2 + 2 * y2 nbr_morton, e2 nbr_edge, count(*) n, count(*) filter (where m.code <> o.code) differ from m join e o on o.face = f2 and o.morton = x2 + 2 * y2 and o.edge = e2 and o.p = q
where (m.face, m.morton) < (f2, x2 + 2 * y2) group by all""")
def seam_pairs_quads(spark, sf_dir) -> DataFrame:
    s = raster.seams(quads(spark, sf_dir, CELLS), CELLS)
    return s.groupBy("face", "morton", "edge", "nbr_face", "nbr_morton", "nbr_edge").agg(F.count("*").alias("n"), F.count_if(F.col("code") != F.col("nbr_code")).alias("differ"))


@query(f"""with {GRID}, {QUADS}, spot as (select q.face, q.morton, q.code, q.gx / 2.0::double px, q.gy / 2.0::double py from quads q),
low as (select *, least(floor(px), {CELLS - 1})::int x0, least(floor(py), {CELLS - 1})::int y0 from spot),
c as (select l.*, g.code a, h.code b, i.code c, j.code d from low l join grid g on g.face = l.face and g.x = x0 and g.y = y0 join grid h on h.face = l.face and h.x = x0 + 1 and h.y = y0
  join grid i on i.face = l.face and i.x = x0 and i.y = y0 + 1 join grid j on j.face = l.face and j.x = x0 + 1 and j.y = y0 + 1)
select face, morton, 0::int anc_level, max(abs(code - ((1 - (px - x0)) * (1 - (py - y0)) * a + (px - x0) * (1 - (py - y0)) * b + (1 - (px - x0)) * (py - y0) * c + (px - x0) * (py - y0) * d))) max_error from c group by face, morton""")
def ancestor_error(spark, sf_dir) -> DataFrame:
    own = grid(spark, sf_dir, CELLS).unionByName(quads(spark, sf_dir, CELLS))
    return raster.ancestor_error(own, CELLS).select("face", "morton", "anc_level", "max_error")


@query(f"""with src as (select l_orderkey % 500 cell, l_suppkey dataset, (l_suppkey % 3)::int priority, (l_linenumber % 4) weight, case when l_suppkey % 5 = 0 then null when l_suppkey % 2 = 1 then l_extendedprice + 1737400.0::double else l_extendedprice end v, (l_suppkey % 2 + l_suppkey % 4 // 2 * 8)::int flags from lineitem),
each as (select cell, priority, dataset, sum(weight * (case when flags & 1 = 1 then v - 1737400.0::double else v end)) h, sum(weight) w, bit_or(flags & ~1) q from src where v is not null and weight > 0 group by all),
best as (select * from each qualify priority = max(priority) over (partition by cell))
select cell, min(dataset) primary_source, round(sum(h) / sum(w) * 100)::bigint elevation, count(*) sources, round(max(w) / sum(w) * 1e6)::bigint top_share, (bit_or(q) | (case when count(*) > 1 then 4 else 0 end))::int quality from best group by cell""")
def canonical_sampler(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_extendedprice", "l_linenumber")
    k, v = F.col("l_suppkey"), F.col("l_extendedprice")
    value = F.when(k % 5 == 0, None).when(k % 2 == 1, v + 1737400.0).otherwise(v)
    flags = (k % 2 + F.expr("l_suppkey % 4 div 2") * 8).cast("int")
    own = li.select((F.col("l_orderkey") % 500).alias("cell"), k.alias("dataset"), (k % 3).cast("int").alias("priority"), (F.col("l_linenumber") % 4).alias("weight"), value.alias("value"), flags.alias("flags"))
    out = fusion.canonical(own, ["cell"])
    top = F.array_max(F.transform("contributions", lambda c: c["fraction"]))
    return out.select("cell", F.col("primary").alias("primary_source"), F.round(F.col("elevation") * 100).cast("long").alias("elevation"), F.size("contributions").cast("long").alias("sources"), F.round(top * 1e6).cast("long").alias("top_share"), "quality")
