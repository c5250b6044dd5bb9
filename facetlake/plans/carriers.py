"""Tile data derived from the driver's tables, as DataFrames and as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetlake.functions import keys
from facetlake.functions.topology import ROWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with the SQL for its rows."""

    def register(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLES[key] = sql.strip()
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tile of level 4 for each order: o_orderkey, face, level, x, y, morton, code."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    x, y = F.expr("o_orderkey div 6 % 16"), F.col("o_custkey") % 16
    code = F.floor("o_totalprice") % 65536
    return o.select("o_orderkey", (F.col("o_orderkey") % 6).cast("int").alias("face"), F.lit(4).alias("level"), x.alias("x"), y.alias("y"), code.cast("int").alias("code")).withColumn("morton", keys.morton(F.col("x"), F.col("y")))


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tile of level 0 to 4 for each order: o_orderkey, face, level, x, y, morton, code."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    o = o.select("o_orderkey", (F.col("o_orderkey") % 6).cast("int").alias("face"), (F.col("o_custkey") % 5).cast("int").alias("level"), "o_totalprice")
    x, y = F.expr("o_orderkey div 6 % shiftleft(1L, level)"), F.expr("o_orderkey div 96 % shiftleft(1L, level)")
    code = (F.floor("o_totalprice") % 65536).cast("int")
    return o.withColumns({"x": x, "y": y, "code": code}).drop("o_totalprice").withColumn("morton", keys.morton(F.col("x"), F.col("y")))


def grid(spark: SparkSession, sf_dir: str, cells: int = 16) -> DataFrame:
    """Rasters of the six root tiles, (cells + 1)^2 samples each, whose codes come from line items: face, level, morton, y, x, code."""
    n = cells + 1
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    at = li.select((F.col("l_orderkey") % 6).cast("int").alias("face"), (F.col("l_partkey") % n).cast("int").alias("y"), (F.col("l_suppkey") % n).cast("int").alias("x"), F.floor("l_extendedprice").alias("p"))
    sums = at.groupBy("face", "y", "x").agg((F.sum("p") % 65536).cast("int").alias("code"))
    full = spark.range(6 * n * n).select((F.col("id") / (n * n)).cast("int").alias("face"), F.lit(0).alias("level"), F.lit(0).cast("long").alias("morton"), (F.floor(F.col("id") / n) % n).cast("int").alias("y"), (F.col("id") % n).cast("int").alias("x"))
    return full.join(sums, ["face", "y", "x"], "left").select("face", "level", "morton", "y", "x", F.coalesce("code", F.expr("(face * 1000 + y * 31 + x * 17) % 65536")).alias("code"))


def bits(x: str, y: str, n: int = 12) -> str:
    """SQL for the Morton code of two expressions of n bits."""
    return "(" + " + ".join(f"((({x} >> {i}) & 1) << {2 * i}) + ((({y} >> {i}) & 1) << {2 * i + 1})" for i in range(n)) + ")::bigint"


def hexed(face: str = "face", level: str = "level", morton: str = "morton") -> str:
    """SQL for a key's sixteen digits."""
    return f"lpad(lower(to_hex(({face}::ubigint << 61) | ({level}::ubigint << 56) | {morton}::ubigint)), 16, '0')"


TILES = f"""tiles as (select *, {bits("x", "y", 4)} morton from (
  select o_orderkey, (o_orderkey % 6)::int face, 4::int as level, (o_orderkey // 6) % 16 x, o_custkey % 16 y, (floor(o_totalprice)::bigint % 65536)::int code from orders))"""
LEVELS = f"""levels as (select *, {bits("x", "y", 4)} morton from (
  select *, (o_orderkey // 6) % (1::bigint << level) x, (o_orderkey // 96) % (1::bigint << level) y from (
    select o_orderkey, (o_orderkey % 6)::int face, (o_custkey % 5)::int as level, (floor(o_totalprice)::bigint % 65536)::int code from orders)))"""
TOPOLOGY = "topo(face, edge, nf, ne, rev) as (values " + ", ".join(f"({f},{e},{nf},{ne},{str(r).lower()})" for f, e, nf, ne, r in ROWS) + ")"


def quads(spark: SparkSession, sf_dir: str, cells: int = 16) -> DataFrame:
    """Rasters of the 24 tiles of level 1, but for the last of face 2, whose samples on shared edges differ by tile: face, level, morton, y, x, code."""
    n = 2 * cells + 1
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    at = li.select((F.col("l_orderkey") % 6).cast("int").alias("face"), (F.col("l_partkey") % n).cast("int").alias("gy"), (F.col("l_suppkey") % n).cast("int").alias("gx"), F.floor("l_extendedprice").alias("p"))
    sums = at.groupBy("face", "gy", "gx").agg((F.sum("p") % 4000).cast("int").alias("s"))
    side = (cells + 1) ** 2
    i = F.col("id")
    full = spark.range(24 * side).select(F.expr(f"cast(id div {4 * side} as int)").alias("face"), F.lit(1).alias("level"), F.expr(f"id div {side} % 4").alias("morton"), F.expr(f"cast(id div {cells + 1} % {cells + 1} as int)").alias("y"), (i % (cells + 1)).cast("int").alias("x"))
    full = full.filter("not (face = 2 and morton = 3)").withColumns({"gx": (F.col("morton") % 2 * cells + F.col("x")).cast("int"), "gy": (F.expr("morton div 2") * cells + F.col("y")).cast("int")})
    code = F.coalesce("s", F.expr("(face * 100 + gy * 31 + gx * 17) % 4000")) + F.col("morton") * 3 + F.col("face")
    return full.join(sums, ["face", "gy", "gx"], "left").select("face", "level", "morton", "y", "x", code.cast("int").alias("code"))


def quads_sql(cells: int = 16) -> str:
    n, side = 2 * cells + 1, (cells + 1) ** 2
    return f"""quads as (select f.face::int face, 1::int as level, f.morton, f.y::int y, f.x::int x, f.gx, f.gy, (coalesce(s.s, (f.face * 100 + f.gy * 31 + f.gx * 17) % 4000) + f.morton * 3 + f.face)::int code
  from (select *, morton % 2 * {cells} + x gx, morton // 2 * {cells} + y gy from (select i // {4 * side} face, i // {side} % 4 morton, i // {cells + 1} % {cells + 1} y, i % {cells + 1} x from range({24 * side}) t(i)) where not (face = 2 and morton = 3)) f
  left join (select l_orderkey % 6 face, l_partkey % {n} gy, l_suppkey % {n} gx, (sum(floor(l_extendedprice)::bigint) % 4000)::int s from lineitem group by all) s using (face, gy, gx))"""


def grid_sql(cells: int = 16) -> str:
    n = cells + 1
    return f"""grid as (select f.face::int face, 0::int as level, 0::bigint morton, f.y::int y, f.x::int x, coalesce(s.code, (f.face * 1000 + f.y * 31 + f.x * 17) % 65536)::int code
  from (select i // {n * n} face, (i // {n}) % {n} y, i % {n} x from range({6 * n * n}) t(i)) f
  left join (select l_orderkey % 6 face, l_partkey % {n} y, l_suppkey % {n} x, (sum(floor(l_extendedprice)::bigint) % 65536)::int code from lineitem group by all) s
  on f.face = s.face and f.y = s.y and f.x = s.x)"""
