"""Queries over source catalogues, provenance, documents of metadata and coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.functions import checks, projection
from facetlake.operators import catalog
from facetlake.plans.carriers import query, table

CATALOG = """cat as (select s_suppkey dataset, case when s_suppkey % 7 = 0 then null when s_suppkey % 11 = 0 then '' else 'mean_radius' end datum,
  case when s_suppkey % 5 = 0 then null else 'equirectangular' end projection, ['radius', 'elevation', 'unknown'][s_suppkey % 3 + 1] sample_kind,
  case when s_suppkey % 13 = 0 then 'nan'::double when s_suppkey % 17 = 0 then 0 else 100.0 end pixel_scale, case when s_suppkey % 4 = 0 then -32768.0 end no_data, s_suppkey % 2 = 0 nodata_declared,
  case when s_suppkey % 19 = 0 then 1738000.0 else 1737400.0 end radius_m from supplier)"""


@query(f"""with {CATALOG} select dataset, 'unknown_datum' as rule from cat where coalesce(datum, '') = '' or radius_m <> 1737400
union all select dataset, 'missing_projection' from cat where projection is null union all select dataset, 'ambiguous_samples' from cat where sample_kind not in ('radius', 'elevation')
union all select dataset, 'bad_pixel_scale' from cat where isnan(pixel_scale) or pixel_scale <= 0 union all select dataset, 'undeclared_no_data' from cat where nodata_declared and no_data is null""")
def catalog_rules(spark, sf_dir) -> DataFrame:
    s, k = table(spark, sf_dir, "supplier", "s_suppkey"), F.col("s_suppkey")
    own = s.select(
        k.alias("dataset"),
        F.when(k % 7 == 0, None).when(k % 11 == 0, "").otherwise("mean_radius").alias("datum"),
        F.when(k % 5 != 0, "equirectangular").alias("projection"),
        F.element_at(F.array(F.lit("radius"), F.lit("elevation"), F.lit("unknown")), (k % 3 + 1).cast("int")).alias("sample_kind"),
        F.when(k % 13 == 0, float("nan")).when(k % 17 == 0, 0.0).otherwise(100.0).alias("pixel_scale"),
        F.when(k % 4 == 0, -32768.0).alias("no_data"),
        (k % 2 == 0).alias("nodata_declared"),
        F.when(k % 19 == 0, 1738000.0).otherwise(1737400.0).alias("radius_m"),
    )
    return catalog.violations(own)


def _palettes(li: DataFrame) -> DataFrame:
    return li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_suppkey").alias("dataset_id")))).alias("palette"))


def _entries(li: DataFrame) -> DataFrame:
    return catalog.palette_entries(_palettes(li)).select("l_orderkey", F.col("pos").cast("long").alias("pos"), "dataset_id")


def _mapped(li: DataFrame) -> DataFrame:
    pal = _palettes(li).withColumn("map", F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: ((F.col("l_orderkey") + i) % 4).cast("int")))
    return catalog.map_entries(pal).select("l_orderkey", F.col("pos").cast("long").alias("pos"), "dataset_id")


@query("""with p as (select l_orderkey, list(distinct l_suppkey order by l_suppkey) ids from lineitem group by l_orderkey)
select l_orderkey, i - 1 as pos, ids[i] dataset_id from p, unnest(range(1, len(ids) + 1)) t(i)""")
def provenance_palette(spark, sf_dir) -> DataFrame:
    return _entries(table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey").distinct())


@query("""with p as (select l_orderkey, list(distinct l_suppkey order by l_suppkey) ids from lineitem group by l_orderkey)
select l_orderkey, i pos, ids[(l_orderkey + i) % 4 + 1] dataset_id from p, range(6) t(i)""")
def provenance_map(spark, sf_dir) -> DataFrame:
    return _mapped(table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey").distinct())


@query("select o_custkey, count(distinct o_orderpriority) n, min(o_orderpriority) first_one, list_contains(list(o_orderpriority), '1-URGENT') urgent from orders group by o_custkey")
def dataset_sets(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderpriority").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("s"))
    return o.select("o_custkey", F.size("s").cast("long").alias("n"), F.array_min("s").alias("first_one"), F.array_contains("s", "1-URGENT").alias("urgent"))


@query("select l_orderkey, arg_min(l_partkey, l_linenumber * 1000000 + l_partkey) filter (where l_returnflag = 'R') first_returned from lineitem group by l_orderkey")
def find_first(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_linenumber") * 1000000 + F.col("l_partkey"))
    return li.groupBy("l_orderkey").agg(F.min_by("l_partkey", returned).alias("first_returned"))


@query("""select c_custkey, json_object('amount', c_custkey, 'name', c_name || chr(10) || '"')::varchar doc, c_custkey % 3 > 0 is_object from customer""")
def meta_object(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name").withColumn("doc", F.to_json(F.struct(F.col("c_custkey").alias("amount"), F.concat("c_name", F.lit('\n"')).alias("name"))))
    cut = F.when(F.col("c_custkey") % 3 == 0, F.expr("substring(doc, 1, length(doc) - 1)")).otherwise(F.col("doc"))
    return c.select("c_custkey", "doc", checks.json_object(cut).alias("is_object"))


@query("""select p_partkey, round((1737400 + h) * cos(la) * cos(lo) * 10)::bigint x, round((1737400 + h) * cos(la) * sin(lo) * 10)::bigint y, round((1737400 + h) * sin(la) * 10)::bigint z
from (select p_partkey, p_retailprice h, (p_partkey % 179 - 89) * pi() / 180 la, (p_partkey % 359 - 179) * pi() / 180 lo from part)""")
def cartesian(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part", "p_partkey", "p_retailprice")
    at = projection.cartesian(F.radians(F.col("p_partkey") % 179 - 89), F.radians(F.col("p_partkey") % 359 - 179), F.col("p_retailprice"))
    return p.select("p_partkey", *[F.round(v * 10).cast("long").alias(n) for n, v in zip("xyz", at, strict=True)])


@query("select e.event_type, date_trunc('hour', ts) as hour, count(*) n, min(user_id) lo, max(user_id) hi from events e group by all")
def windowed_summary(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events", "event_type", "ts", "user_id")
    w = e.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.min("user_id").alias("lo"), F.max("user_id").alias("hi"))
    return w.select("event_type", F.col("w.start").alias("hour"), "n", "lo", "hi")
