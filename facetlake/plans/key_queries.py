"""Queries over keys, topology and the projection."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.functions import elevation, keys, projection, topology
from facetlake.operators import raster
from facetlake.plans.carriers import LEVELS, TILES, TOPOLOGY, hexed, levels, query, table, tiles


@query(f"with {TILES} select o_orderkey, face, level, morton, {hexed()} key_hex from tiles")
def key_encode(spark, sf_dir) -> DataFrame:
    return tiles(spark, sf_dir).select("o_orderkey", "face", "level", "morton", keys.key_hex(F.col("face"), F.col("level"), F.col("morton")).alias("key_hex"))


@query(f"with {TILES} select o_orderkey, face, level, x, y, morton from tiles")
def key_decode(spark, sf_dir) -> DataFrame:
    key = keys.from_hex(keys.key_hex(F.col("face"), F.col("level"), F.col("morton")))
    own = tiles(spark, sf_dir).select("o_orderkey", key.alias("key"))
    m = keys.morton_of(F.col("key"))
    return own.select("o_orderkey", keys.face_of(F.col("key")).alias("face"), keys.level_of(F.col("key")).alias("level"), keys.x_of(m).alias("x"), keys.y_of(m).alias("y"), m.alias("morton"))


@query(f"with {TILES} select o_orderkey, printf('QSC/F%d/L%02d/%04d/%04d', face, level, x * 700, y) as text from (select * replace (9 + level as level) from tiles)")
def key_text(spark, sf_dir) -> DataFrame:
    return tiles(spark, sf_dir).select("o_orderkey", keys.text(F.col("face"), F.col("level") + 9, F.col("x") * 700, F.col("y")).alias("text"))


@query(f"""with {LEVELS}, texts as (select o_orderkey, o_orderkey % 7 k, face, level, x, y, printf('QSC/F%d/L%02d/%04d/%04d', face, level, x, y) t from levels)
select o_orderkey, case when k in (0, 5, 6) then face end face, case when k in (0, 5, 6) then level end as level, case when k in (0, 5, 6) then x end x, case when k in (0, 5, 6) then y end y, k in (0, 5, 6) ok from texts""")
def key_parse(spark, sf_dir) -> DataFrame:
    own = levels(spark, sf_dir)
    t = keys.text(F.col("face"), F.col("level"), F.col("x"), F.col("y"))
    k = F.col("o_orderkey") % 7
    bad = F.when(k == 1, F.lower(t)).when(k == 2, F.concat(t, F.lit("/0000"))).when(k == 3, F.regexp_replace(t, "L0", "L")).when(k == 4, F.regexp_replace(t, "/00", "/0000")).otherwise(t)
    p = own.select("o_orderkey", keys.parse(bad).alias("p"))
    return p.select("o_orderkey", "p.face", "p.level", "p.x", "p.y", F.col("p").isNotNull().alias("ok"))


@query("""select o_orderkey, (face <= 5 and level <= 28 and x < (1::hugeint << least(level, 28)) and y < (1::hugeint << least(level, 28))) ok,
  (face <= 5 and level <= 28 and (m >> (2 * least(level, 28))) = 0) key_ok
from (select o_orderkey, o_orderkey % 8 face, o_custkey % 32 as level, o_orderkey % 300 x, o_custkey % 257 y, o_orderkey * 37 m from orders)""")
def key_valid(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    o = o.select("o_orderkey", (F.col("o_orderkey") % 8).cast("int").alias("face"), (F.col("o_custkey") % 32).cast("int").alias("level"), (F.col("o_orderkey") % 300).alias("x"), (F.col("o_custkey") % 257).alias("y"), (F.col("o_orderkey") * 37).alias("m"))
    return o.select("o_orderkey", keys.valid(F.col("face"), F.col("level"), F.col("x"), F.col("y")).alias("ok"), keys.valid_key(keys.encode(F.col("face"), F.col("level"), F.col("m"))).alias("key_ok"))


@query(f"with {LEVELS} select o_orderkey, face, case when level > 0 then level - 1 end as level, case when level > 0 then morton >> 2 end morton, (morton & 3)::int quadrant from levels")
def key_parent(spark, sf_dir) -> DataFrame:
    level, m = keys.parent(F.col("level"), F.col("morton"))
    return levels(spark, sf_dir).select("o_orderkey", "face", level.alias("level"), m.alias("morton"), keys.quadrant(F.col("morton")).alias("quadrant"))


@query(f"with {LEVELS} select o_orderkey, face, level + 1 as level, morton * 4 + q morton from levels, range(4) t(q)")
def key_children(spark, sf_dir) -> DataFrame:
    own = levels(spark, sf_dir).withColumn("c", F.explode(keys.children(F.col("level"), F.col("morton"))))
    return own.select("o_orderkey", "face", "c.level", "c.morton")


@query(f"with {LEVELS} select o_orderkey, face, (level - up)::int as level, morton >> (2 * up)::int morton from levels, range(5) t(up) where up <= level")
def key_ancestors(spark, sf_dir) -> DataFrame:
    own = levels(spark, sf_dir).withColumn("a", F.explode(keys.ancestors(F.col("level"), F.col("morton"))))
    return own.select("o_orderkey", "face", "a.level", "a.morton")


@query(f"""with {LEVELS}, {TOPOLOGY}, e as (select l.*, edge, nf, ne, rev, (1::bigint << level) - 1 last, case edge when 0 then x > 0 when 1 then x < (1::bigint << level) - 1 when 2 then y > 0 else y < (1::bigint << level) - 1 end ins
  from (select distinct face, level, x, y from levels) l join topo using (face)),
a as (select *, case when rev then last - (case when edge < 2 then y else x end) else (case when edge < 2 then y else x end) end along from e)
select face, level, x, y, edge, case when ins then face else nf end nbr_face,
  case when ins then x + (case edge when 0 then -1 when 1 then 1 else 0 end) when ne = 0 then 0 when ne = 1 then last else along end nbr_x,
  case when ins then y + (case edge when 2 then -1 when 3 then 1 else 0 end) when ne = 2 then 0 when ne = 3 then last else along end nbr_y,
  case when ins then [1, 0, 3, 2][edge + 1] else ne end touching, (not ins and rev) reversed from a""")
def key_neighbors(spark, sf_dir) -> DataFrame:
    return topology.neighbors(levels(spark, sf_dir).select("face", "level", "x", "y").distinct())


@query(f"with {TOPOLOGY} select face, edge, nf nbr_face, ne nbr_edge, rev reversed, face < nf owns from topo")
def edge_owner(spark, sf_dir) -> DataFrame:
    t = topology.topology(spark)
    return t.withColumn("owns", topology.owns_edge(F.col("face"), F.col("edge")))


@query(f"with {TOPOLOGY} select a.face, a.edge u_edge, b.edge v_edge, least(a.face, a.nf, b.nf) owner from topo a join topo b on a.face = b.face and a.edge < 2 and b.edge > 1")
def corner_owner(spark, sf_dir) -> DataFrame:
    t = topology.topology(spark)
    a, b = t.filter("edge < 2").select("face", F.col("edge").alias("u_edge")), t.filter("edge > 1").select("face", F.col("edge").alias("v_edge"))
    return a.join(b, "face").withColumn("owner", topology.corner_owner(F.col("face"), F.col("u_edge"), F.col("v_edge")))


@query("""select l_orderkey, l_linenumber, ((2 * (t * 256 + i) - (256 << lv))::double / (256 << lv)) u
from (select l_orderkey, l_linenumber, (l_partkey % 9)::int lv, l_suppkey % (1 << (l_partkey % 9)::int) t, l_orderkey % 257 i from lineitem)""")
def lattice_coord(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").withColumn("lv", (F.col("l_partkey") % 9).cast("int"))
    return li.select("l_orderkey", "l_linenumber", projection.lattice(F.expr("l_suppkey % shiftleft(1, lv)"), (F.col("l_orderkey") % 257).cast("int"), F.col("lv")).alias("u"))


_STRENGTHS = ("x", "y", "-x", "-y", "z", "-z")


def _face_sql() -> str:
    """The choice of a face as nested SQL, one axis after the other."""
    inner = "select *, x s0, 0 f0 from xyz"
    for k in range(1, 6):
        s = _STRENGTHS[k]
        inner = f"select *, case when {s} > s{k - 1} + 32 * 2.220446049250313e-16 then {s} else s{k - 1} end s{k}, case when {s} > s{k - 1} + 32 * 2.220446049250313e-16 then {k} else f{k - 1} end f{k} from ({inner})"
    return inner


FORWARD = f"""pts as (select l_orderkey, l_linenumber, ((l_partkey % 1799) - 899) / 899.0::double * 1.57 lat, ((l_orderkey % 3600) - 1800) / 1800.0::double * 3.14 lon from lineitem),
xyz as (select *, cos(lat) * cos(lon) x, cos(lat) * sin(lon) y, sin(lat) z from pts),
fc as (select *, f5 face, case f5 when 0 then x when 1 then y when 2 then -x else -y end nrm, case f5 when 0 then y when 1 then -x when 2 then -y else x end side from ({_face_sql()})),
ph as (select *, case face when 4 then pi() / 2 - lat when 5 then pi() / 2 + lat else acos(greatest(-1, least(1, nrm))) end phi from fc),
t as (select *, case when face >= 4 then lon when phi < 1e-10 then 0 else atan2(z, side) end a from ph),
ar as (select *, case when face = 4 then (case when a between pi() / 4 and 3 * pi() / 4 then 0 when a > 3 * pi() / 4 or a <= -3 * pi() / 4 then 1 when a > -3 * pi() / 4 and a <= -pi() / 4 then 2 else 3 end)
  when face = 5 then (case when a between pi() / 4 and 3 * pi() / 4 then 0 when a < pi() / 4 and a >= -pi() / 4 then 1 when a < -pi() / 4 and a >= -3 * pi() / 4 then 2 else 3 end)
  else (case when abs(a) <= pi() / 4 then 0 when a > pi() / 4 and a <= 3 * pi() / 4 then 1 when a > 3 * pi() / 4 or a <= -3 * pi() / 4 then 2 else 3 end) end area from t),
th as (select *, case when face = 4 then (case area when 0 then a - pi() / 2 when 1 then (case when a > 0 then a - pi() else a + pi() end) when 2 then a + pi() / 2 else a end)
  when face = 5 then (case area when 0 then pi() / 2 - a when 1 then -a when 2 then -a - pi() / 2 else (case when a > 0 then pi() - a else -a - pi() end) end)
  else (case area when 0 then a when 1 then a - pi() / 2 when 2 then (case when a >= 0 then a - pi() else a + pi() end) else a + pi() / 2 end) end theta from ar),
mu as (select *, atan(12 / pi() * (theta + acos(sin(theta) * sqrt(0.5)) - pi() / 2)) m from th),
rr as (select *, sqrt(greatest(0, (1 - cos(phi)) / (cos(m) * cos(m) * (1 - cos(atan(1 / cos(theta))))))) r, m + area * pi() / 2 mm from mu)"""


@query(f"with {FORWARD} select l_orderkey, l_linenumber, face, round(r * cos(mm) * 1e6)::bigint u6, round(r * sin(mm) * 1e6)::bigint v6 from rr")
def qsc_forward_code(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    pts = li.select("l_orderkey", "l_linenumber", ((F.col("l_partkey") % 1799 - 899) / F.lit(899.0) * 1.57).alias("lat"), ((F.col("l_orderkey") % 3600 - 1800) / F.lit(1800.0) * 3.14).alias("lon"))
    out = projection.forward(pts)
    return out.select("l_orderkey", "l_linenumber", "face", F.round(F.col("u") * 1e6).cast("long").alias("u6"), F.round(F.col("v") * 1e6).cast("long").alias("v6"))


def inverse_sql(source: str) -> str:
    """CTEs that take (face, u, v, ...) of a source to lat and lon in `geo`."""
    return f"""i1 as (select *, case when u >= 0 and u >= abs(v) then 0 when v >= 0 and v >= abs(u) then 1 when u < 0 and -u >= abs(v) then 2 else 3 end area, atan2(v, u) m0 from {source}),
i2 as (select *, case area when 0 then m0 when 1 then m0 - pi() / 2 when 2 then (case when m0 < 0 then m0 + pi() else m0 - pi() end) else m0 + pi() / 2 end mu from i1),
i3 as (select *, pi() / 12 * tan(mu) t from i2),
i4 as (select *, atan(sin(t) / (cos(t) - sqrt(0.5))) th, tan(atan(sqrt(u * u + v * v))) nu from i3),
i5 as (select *, greatest(-1, least(1, 1 - cos(mu) * cos(mu) * nu * nu * (1 - cos(atan(1 / cos(th)))))) q from i4),
i6 as (select *, case when q * q >= 1 then 0 else sqrt(greatest(0, 1 - q * q)) * sin(th) end s from i5),
i7 as (select *, case when q * q + s * s >= 1 then 0 else sqrt(greatest(0, 1 - (q * q + s * s))) end r from i6),
i8 as (select *, case area when 0 then r when 1 then -s when 2 then -r else s end r2, case area when 0 then s when 1 then r when 2 then -s else -r end s2 from i7),
i9 as (select *, case face when 4 then pi() / 2 - acos(q) when 5 then acos(q) - pi() / 2 else acos(greatest(-1, least(1, -s2))) - pi() / 2 end la,
  case face when 4 then (case area when 0 then th + pi() / 2 when 1 then (case when th < 0 then th + pi() else th - pi() end) when 2 then th - pi() / 2 else th end)
  when 5 then (case area when 0 then pi() / 2 - th when 1 then -th when 2 then -th - pi() / 2 else (case when th < 0 then -th - pi() else pi() - th end) end)
  when 0 then atan2(r2, q) when 1 then atan2(q, -r2) when 2 then atan2(-r2, -q) else atan2(-q, r2) end lo from i8),
geo as (select *, case when abs(abs(la) - pi() / 2) <= 32 * 2.220446049250313e-16 then sign(la) * pi() / 2 else la end lat,
  case when abs(abs(la) - pi() / 2) <= 32 * 2.220446049250313e-16 then 0 else lo - 2 * pi() * floor((lo + pi()) / (2 * pi())) end lon from i9)"""


@query(f"""with uv as (select l_orderkey, l_linenumber, (l_suppkey % 6)::int face, ((l_partkey % 199) - 99) / 100.0::double u, ((l_orderkey % 197) - 98) / 99.0::double v from lineitem), {inverse_sql("uv")}
select l_orderkey, l_linenumber, round(lat * 1e6)::bigint lat6, round(cos(lat) * cos(lon) * 1e6)::bigint x6, round(cos(lat) * sin(lon) * 1e6)::bigint y6 from geo""")
def qsc_inverse_code(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    uv = li.select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 6).cast("int").alias("face"), ((F.col("l_partkey") % 199 - 99) / F.lit(100.0)).alias("u"), ((F.col("l_orderkey") % 197 - 98) / F.lit(99.0)).alias("v"))
    out = projection.inverse(uv)
    x, y, _ = projection.cartesian(F.col("lat"), F.col("lon"), F.lit(0.0), 1.0)
    return out.select("l_orderkey", "l_linenumber", F.round(F.col("lat") * 1e6).cast("long").alias("lat6"), F.round(x * 1e6).cast("long").alias("x6"), F.round(y * 1e6).cast("long").alias("y6"))


SYNTH = f"""uv as (select (i // 66049)::int face, (2 * (i % 257) - 256) / 256.0::double u, (2 * ((i // 257) % 257) - 256) / 256.0::double v from range(396294) t(i)), {inverse_sql("uv")},
el as (select face, round_even((2048 * (0.55::double * sin(lat) + 0.25::double * cos(lat) * cos(lon) * cos(lat) * sin(lon) + 0.20::double * (cos(lat) * cos(lon) * cos(lat) * cos(lon) - cos(lat) * sin(lon) * cos(lat) * sin(lon))) + 16384) / 0.5::double, 0)::int code from geo)"""


@query(f"with {SYNTH} select face, min(code) min_code, max(code) max_code, count(*) n from el group by face")
def synth_faces_minmax(spark, sf_dir) -> DataFrame:
    return raster.synthetic_faces(spark).groupBy("face").agg(F.min("code").alias("min_code"), F.max("code").alias("max_code"), F.count("*").alias("n"))


@query("""select l_orderkey, l_linenumber, case when s between 0 and 65535 then round_even(s, 0)::int end code,
  case when e >= 0 then floor(e * 1000 + 0.5)::bigint end mm from (select l_orderkey, l_linenumber, (l_extendedprice / 4 - 20000.25) e, (l_extendedprice / 4 - 20000.25 + 16384) / 0.5 s from lineitem)""")
def quantize_even(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice").withColumn("e", F.col("l_extendedprice") / 4 - 20000.25)
    return li.select("l_orderkey", "l_linenumber", elevation.quantize(F.col("e")).alias("code"), elevation.millimetres(F.col("e")).alias("mm"))


@query(f"with {TILES} select o_orderkey, (-16384.0::double + code * 0.5::double)::float metres, case when o_orderkey % 2 = 1 then code * 100.0::double - 1737400.0::double else code * 100.0::double end elev from tiles")
def dequantize(spark, sf_dir) -> DataFrame:
    own = tiles(spark, sf_dir)
    return own.select("o_orderkey", elevation.dequantize(F.col("code")).alias("metres"), elevation.to_elevation(F.col("code") * F.lit(100.0), F.col("o_orderkey").cast("int")).alias("elev"))


