"""Queries over registries, packs, hashes and checks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from facetlake.functions import checks, hashing, keys
from facetlake.operators import registry
from facetlake.plans.carriers import TILES, hexed, query, table, tiles
from facetlake.plans.index_queries import IDX4, index4

PACKS = f"""entries as (select *, (face * 4 + (morton // 64))::bigint pack_id, {hexed()} key_hex from idx)"""


def entries(spark, sf_dir) -> DataFrame:
    """The level-4 index with a pack for each quarter of a face."""
    return index4(spark, sf_dir).withColumns({"pack_id": F.col("face") * 4 + F.floor(F.col("morton") / 64), "key_hex": keys.key_hex(F.col("face"), F.col("level"), F.col("morton"))})


@query(f"with {TILES}, {IDX4}, {PACKS} select pack_id, count(*) n, min(key_hex) first_key, max(key_hex) last_key from entries group by pack_id")
def pack_registry(spark, sf_dir) -> DataFrame:
    return registry.group_summary(entries(spark, sf_dir), "pack_id", "key_hex")


@query(f"""with {TILES}, {IDX4}, {PACKS}, packs as (select pack_id, sum(n) * 90::bigint file_bytes from entries where pack_id % 5 > 0 group by pack_id),
laid as (select *, 64 + sum(n * 96) over (partition by pack_id order by key_hex) - n * 96 as off from entries)
select l.key_hex, l.pack_id, case when p.pack_id is null then 'missing' else 'outside' end problem from laid l left join packs p using (pack_id) where p.pack_id is null or off + n * 96 > file_bytes""")
def pack_bounds_check(spark, sf_dir) -> DataFrame:
    own = entries(spark, sf_dir)
    packs = own.filter("pack_id % 5 > 0").groupBy("pack_id").agg((F.sum("n") * 90).alias("file_bytes"))
    laid = registry.offsets(own, "key_hex", F.col("n") * 96, "pack_id", base=64, to=8)
    both = laid.join(packs, "pack_id", "left")
    problem = F.when(F.col("file_bytes").isNull(), "missing").when(~checks.range_fits(F.col("offset"), F.col("n") * 96, F.col("file_bytes")), "outside")
    return both.select("key_hex", "pack_id", problem.alias("problem")).filter("problem is not null")


@query("""select o_custkey, o_orderkey, k, prev from (select o_custkey, o_orderkey, o_orderkey % 1000 k, lag(o_orderkey % 1000) over (partition by o_custkey order by o_orderkey) prev from orders) where k <= prev""")
def sorted_unique_violations(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey").withColumn("k", F.col("o_orderkey") % 1000)
    return registry.not_increasing(o, "o_orderkey", "k", "o_custkey")


SPANS = "spans as (select o_custkey, o_orderkey, o_orderkey % 5000 a, o_orderkey % 5000 + 1 + (floor(o_totalprice)::bigint % 700) b from orders)"


def _spans(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_totalprice")
    return o.select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 5000).alias("a"), (F.col("o_orderkey") % 5000 + 1 + F.floor("o_totalprice") % 700).alias("b"))


@query(f"with {SPANS} select * from (select *, max(b) over (partition by o_custkey order by a, b rows between unbounded preceding and 1 preceding) reach from spans) where a < reach")
def overlap_violations(spark, sf_dir) -> DataFrame:
    """Of a customer's equal spans, which the SQL leaves in any order, the one with the smallest o_orderkey is the earlier."""
    return registry.overlapping(_spans(spark, sf_dir), "a", "b", "o_custkey", ties=("o_orderkey",)).select("o_custkey", "o_orderkey", "a", "b", "reach")


@query(f"with {SPANS} select o_custkey, sum(gap)::bigint gap_bytes, count(*) gaps from (select *, a - lag(b) over (partition by o_custkey order by a, b) gap from spans) where gap > 0 group by o_custkey")
def gap_check(spark, sf_dir) -> DataFrame:
    return registry.gaps(_spans(spark, sf_dir), "a", "b", "o_custkey").groupBy("o_custkey").agg(F.sum("gap").alias("gap_bytes"), F.count("*").alias("gaps"))


STRINGS = """texts as (select s_name as text from supplier union select n_name from nation union select r_name from region union select 'Packs/' || p_brand || '.ltp' from part),
strs as (select text, strlen(text) bytes, 4 + coalesce(sum((strlen(text) + 4 + 3) // 4 * 4) over (order by text rows between unbounded preceding and 1 preceding), 0)::bigint string_id from texts where text <> '')"""


def _texts(spark, sf_dir) -> DataFrame:
    parts = [table(spark, sf_dir, t, c).select(F.col(c).alias("text")) for t, c in (("supplier", "s_name"), ("nation", "n_name"), ("region", "r_name"))]
    parts.append(table(spark, sf_dir, "part", "p_brand").select(F.concat(F.lit("Packs/"), "p_brand", F.lit(".ltp")).alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@query(f"with {STRINGS} select text, string_id, bytes from strs")
def string_table(spark, sf_dir) -> DataFrame:
    return registry.string_table(_texts(spark, sf_dir))


@query(f"with {STRINGS} select count(*) n, count(distinct text) d, min(text) lo, max(text) hi from texts")
def string_union(spark, sf_dir) -> DataFrame:
    return _texts(spark, sf_dir).distinct().agg(F.count("*").alias("n"), F.countDistinct("text").alias("d"), F.min("text").alias("lo"), F.max("text").alias("hi"))


@query(f"with {STRINGS} select p_partkey, 4 * (p_partkey % 700) string_id from part where 4 * (p_partkey % 700) not in (select string_id from strs)")
def string_fk_missing(spark, sf_dir) -> DataFrame:
    refs = table(spark, sf_dir, "part", "p_partkey").withColumn("string_id", 4 * (F.col("p_partkey") % 700))
    return registry.missing(refs, "string_id", registry.string_table(_texts(spark, sf_dir)).withColumnRenamed("string_id", "sid"), "sid")


@query(f"with {STRINGS} select p_partkey, text from part join strs on string_id = 4 * (p_partkey % 700)")
def string_join(spark, sf_dir) -> DataFrame:
    refs = table(spark, sf_dir, "part", "p_partkey").withColumn("ref", 4 * (F.col("p_partkey") % 700))
    return refs.join(registry.string_table(_texts(spark, sf_dir)), F.col("ref") == F.col("string_id")).select("p_partkey", "text")


@query(f"with {TILES} select distinct face, level, morton from tiles where o_orderkey % 137 in (select s_suppkey from supplier where s_suppkey % 2 = 0)")
def dataset_semi(spark, sf_dir) -> DataFrame:
    known = table(spark, sf_dir, "supplier", "s_suppkey").filter("s_suppkey % 2 = 0")
    return tiles(spark, sf_dir).withColumn("d", F.col("o_orderkey") % 137).join(known, F.col("d") == F.col("s_suppkey"), "left_semi").select("face", "level", "morton").distinct()


@query(f"with {TILES} select o_orderkey, o_orderkey % 137 dataset from tiles where o_orderkey % 137 not in (select s_suppkey from supplier)")
def dataset_anti(spark, sf_dir) -> DataFrame:
    own = tiles(spark, sf_dir).select("o_orderkey", (F.col("o_orderkey") % 137).alias("dataset"))
    return registry.missing(own, "dataset", table(spark, sf_dir, "supplier", "s_suppkey"), "s_suppkey")


@query("""with meta as (select string_agg('{"id":' || n_nationkey || '}', '' order by n_nationkey) m from nation),
laid as (select n_nationkey, length('{"id":' || n_nationkey || '}') b, coalesce(sum(length('{"id":' || n_nationkey || '}')) over (order by n_nationkey rows between unbounded preceding and 1 preceding), 0)::bigint o from nation)
select n_nationkey::bigint n_nationkey, o as offset_, substring(m, o + 1, b) doc from laid, meta""")
def meta_slice(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation", "n_nationkey").select(F.col("n_nationkey").cast("long").alias("n_nationkey")).withColumn("doc", F.concat(F.lit('{"id":'), F.col("n_nationkey").cast("string"), F.lit("}")))
    laid = registry.offsets(n, "n_nationkey", F.octet_length("doc"))
    meta = n.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "doc"))), lambda x: x["doc"]), "").alias("m"))
    out = laid.crossJoin(F.broadcast(meta))
    return out.select("n_nationkey", F.col("offset").alias("offset_"), F.substring("m", F.col("offset").cast("int") + 1, F.octet_length("doc")).alias("doc"))


@query("""select c_custkey, sha256(c_name) sha, lower(sha256(c_name)) = sha256(c_name) lower_ok, starts_with(sha256(c_name), substr(sha256(c_name), 1, 32)) prefix_ok from customer""")
def digest_prefix(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name").withColumn("sha", F.sha2("c_name", 256))
    return c.select("c_custkey", "sha", checks.is_digest(F.col("sha")).alias("lower_ok"), checks.digest_prefix(F.col("sha"), F.upper(F.substring("sha", 1, 32))).alias("prefix_ok"))


def _framed(domain: str, text: str) -> str:
    """SQL for a framed hash of an ASCII text of less than 65536 bytes."""
    zero = "".join("\\x00" for _ in range(6))
    size = f"unhex(lpad(to_hex(strlen({text}) % 256), 2, '0') || lpad(to_hex(strlen({text}) // 256), 2, '0'))"
    return f"sha256('{domain}'::blob || '\\x00'::blob || {size} || '{zero}'::blob || {text}::blob)"


@query(f"select c_custkey, {_framed('LTDB_SEMANTIC_CONFIG_V1', 'c_name')} hash from customer")
def framed_hash(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer", "c_custkey", "c_name").select("c_custkey", hashing.framed("LTDB_SEMANTIC_CONFIG_V1", F.col("c_name")).alias("hash"))


@query(f"select s_suppkey, ('0x' || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2))::bigint dataset_id from (select s_suppkey, {_framed('LTDB_DATASET_V1', 's_name')} h from supplier)")
def dataset_id(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier", "s_suppkey", "s_name").select("s_suppkey", hashing.dataset_id(F.col("s_name")).alias("dataset_id"))


@query("select c_custkey, substr(sha256('LTDB_DATABASE_ID_V1'::blob || '\\x00'::blob || unhex(sha256(c_name)) || unhex(sha256(c_mktsegment))), 1, 32) id from customer")
def database_id(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    return c.select("c_custkey", hashing.database_id(F.sha2("c_name", 256), F.sha2("c_mktsegment", 256)).alias("id"))


@query(f"with {TILES}, {IDX4}, {PACKS} select pack_id, sha256(string_agg(key_hex || ':' || sum_code, '|' order by key_hex)) digest from entries group by pack_id")
def ordered_digest(spark, sf_dir) -> DataFrame:
    return registry.ordered_digest(entries(spark, sf_dir), "pack_id", "key_hex", F.concat("key_hex", F.lit(":"), F.col("sum_code").cast("string")))


def _dependency(hex_: str) -> str:
    return f"""'{{"builder_algorithm_version":1,"tile_key":"' || {hex_} || '","tile_schema_version":1}}'"""


@query(f"with {TILES}, {IDX4}, j as (select face, morton, {_dependency(hexed())} t from idx) select face, morton, {_framed('LTDB_TILE_DEP_V1', 't')} hash from j")
def dependency_hash(spark, sf_dir) -> DataFrame:
    text = F.format_string('{"builder_algorithm_version":1,"tile_key":"%s","tile_schema_version":1}', keys.key_hex(F.col("face"), F.col("level"), F.col("morton")))
    return index4(spark, sf_dir).select("face", "morton", hashing.framed("LTDB_TILE_DEP_V1", text).alias("hash"))


@query("select doc_id, sha256(encode(text)[1:8] || '\\x00\\x00\\x00\\x00'::blob || encode(text)[13:]) hash from documents where text is not null and strlen(text) >= 12")
def pack_hash_zeroed(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text").filter("text is not null and octet_length(text) >= 12")
    return d.select("doc_id", hashing.zeroed_hash(F.col("text").cast("binary"), 8, 4).alias("hash"))


@query("select l_orderkey, l_linenumber, o >= 0 and b >= 0 and o <= t and b <= t - o fits, ((b + 7) & -8) aligned from (select l_orderkey, l_linenumber, l_partkey - 50 o, l_suppkey * 20 b, l_orderkey % 3000 t from lineitem)")
def range_fits(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return li.select("l_orderkey", "l_linenumber", checks.range_fits(F.col("l_partkey") - 50, F.col("l_suppkey") * 20, F.col("l_orderkey") % 3000).alias("fits"), hashing.align(F.col("l_suppkey") * 20, 8).alias("aligned"))


@query(f"""select o_orderkey, (o_custkey % 16 & ~3) = 0 flags_ok, case when o_orderkey % 4 > 0 and (o_custkey % 16 & 1) = 1 then 'unsupported_feature' end error,
  {[*checks.ERRORS, 'unknown', 'unknown']}[o_orderkey % 17 + 1] code_name from orders""")
def flag_mask(spark, sf_dir) -> DataFrame:
    o, flags = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey"), F.col("o_custkey") % 16
    return o.select("o_orderkey", checks.only_flags(flags, 3).alias("flags_ok"), checks.feature_error(F.col("o_orderkey") % 4 == 0, flags).alias("error"), checks.error_name((F.col("o_orderkey") % 17).cast("int")).alias("code_name"))


@query("""select event_id, not (p like '%\\%' or p like '%:%') and regexp_full_match(p, '[^/]+(/[^/]+)*') and not regexp_matches(p, '(^|/)\\.{1,2}(/|$)') path_ok,
  regexp_full_match(event_type || '_' || (event_id % 9), '[a-z0-9._-]+') key_ok
from (select event_id, event_type, case event_id % 6 when 0 then 'Packs/' || event_type when 1 then '/' || event_type when 2 then 'a/../' || event_type when 3 then 'C:' || event_type when 4 then 'a//b' else event_type || '/./x' end p from events)""")
def portable_path(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events", "event_id", "event_type")
    k, t = F.col("event_id") % 6, F.col("event_type")
    p = F.when(k == 0, F.concat(F.lit("Packs/"), t)).when(k == 1, F.concat(F.lit("/"), t)).when(k == 2, F.concat(F.lit("a/../"), t)).when(k == 3, F.concat(F.lit("C:"), t)).when(k == 4, "a//b").otherwise(F.concat(t, F.lit("/./x")))
    return e.select("event_id", checks.portable_path(p).alias("path_ok"), checks.stable_key(F.concat(t, F.lit("_"), (F.col("event_id") % 9).cast("string"))).alias("key_ok"))


@query("""select p_partkey, isfinite(v) finite, isfinite(v) and v > 0 positive from (select p_partkey, case p_partkey % 5 when 0 then 'nan'::double when 1 then 'inf'::double when 2 then -p_retailprice when 3 then 0 else p_retailprice end v from part)""")
def finite_positive(spark, sf_dir) -> DataFrame:
    p, k = table(spark, sf_dir, "part", "p_partkey", "p_retailprice"), F.col("p_partkey") % 5
    v = F.when(k == 0, float("nan")).when(k == 1, float("inf")).when(k == 2, -F.col("p_retailprice")).when(k == 3, 0.0).otherwise(F.col("p_retailprice"))
    return p.select("p_partkey", checks.finite(v).alias("finite"), checks.positive(v).alias("positive"))


@query("""select l_orderkey, count(*) n, bool_and((l_suppkey % 64 & 224) = 0) quality_ok, count(*) filter (where (l_suppkey & 4) = 4) transitions, bit_or(l_suppkey % 32)::bigint flags from lineitem group by l_orderkey""")
def quality_bits(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey")
    own = li.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.collect_list(F.col("l_suppkey") % 64).alias("q"), F.count_if(F.col("l_suppkey").bitwiseAND(F.lit(4)) == 4).alias("transitions"), F.bit_or(F.col("l_suppkey") % 32).alias("flags"))
    return own.select("l_orderkey", "n", checks.quality_bits(F.col("q")).alias("quality_ok"), "transitions", "flags")


PALETTE = "pal as (select l_orderkey, l_suppkey, count(*)::double / sum(count(*)) over (partition by l_orderkey) as frac from lineitem group by l_orderkey, l_suppkey)"


def _palette(spark, sf_dir) -> DataFrame:
    # One shuffle, by order, serves the counts, the totals, and what is grouped by order later.
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey").repartition("l_orderkey").groupBy("l_orderkey", "l_suppkey").agg(F.count("*").alias("c"))
    total = F.sum("c").over(Window.partitionBy("l_orderkey"))
    return li.select("l_orderkey", "l_suppkey", (F.col("c").cast("double") / total).alias("frac"))


@query(f"with {PALETTE} select l_orderkey, l_suppkey dominant, round(frac * 1e6)::bigint share from pal qualify row_number() over (partition by l_orderkey order by frac desc, l_suppkey) = 1")
def dominant_source(spark, sf_dir) -> DataFrame:
    return registry.dominant(_palette(spark, sf_dir), ["l_orderkey"], "l_suppkey", "frac").select("l_orderkey", "dominant", F.round(F.col("share") * 1e6).cast("long").alias("share"))


@query(f"with {PALETTE} select l_orderkey, round(sum(frac) * 1e4)::bigint total from (select * from pal where not (l_orderkey % 10 = 0 and l_suppkey % 4 = 0)) group by l_orderkey having abs(sum(frac) - 1) > 1e-6")
def contribution_sum(spark, sf_dir) -> DataFrame:
    own = _palette(spark, sf_dir).filter("not (l_orderkey % 10 = 0 and l_suppkey % 4 = 0)")
    pal = own.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_suppkey", F.col("frac").alias("fraction")))).alias("palette"))
    return registry.contribution_errors(pal).select("l_orderkey", F.round(F.col("total") * 1e4).cast("long").alias("total"))


def _tag_counts(o: DataFrame) -> DataFrame:
    tags = F.array(*map(F.lit, ("DSET", "META", "PACK", "STRS", "TIDX", "XTRA")))
    t = o.select(F.element_at(tags, (F.col("o_orderkey") % 6 + 1).cast("int")).alias("tag"))
    return t.groupBy("tag").agg(F.count("*").alias("n")).withColumns({"once": F.col("n") == 1, "mandatory": F.col("tag") != "XTRA"})


@query("""with t(tag) as (select ['DSET', 'META', 'PACK', 'STRS', 'TIDX', 'XTRA'][o_orderkey % 6 + 1] from orders)
select tag, count(*) n, count(*) = 1 as once, tag <> 'XTRA' mandatory from t group by tag""")
def chunk_counts(spark, sf_dir) -> DataFrame:
    return _tag_counts(table(spark, sf_dir, "orders", "o_orderkey"))


@query(f"""with {TILES}, {IDX4}, h as (select face, morton, min_code + (case when morton % 13 = 0 then 1 else 0 end) min_code, max_code from idx)
select face, morton, case when i.min_code <> h.min_code then 'min_code' else 'max_code' end field from idx i join h using (face, morton) where i.min_code <> h.min_code or i.max_code <> h.max_code""")
def tile_agreement(spark, sf_dir) -> DataFrame:
    own = index4(spark, sf_dir).select("face", "morton", "min_code", "max_code")
    head = own.select("face", "morton", (F.col("min_code") + F.when(F.col("morton") % 13 == 0, 1).otherwise(0)).alias("h_min"), F.col("max_code").alias("h_max"))
    both = own.join(head, ["face", "morton"]).filter("min_code <> h_min or max_code <> h_max")
    return both.select("face", "morton", F.when(F.col("min_code") != F.col("h_min"), "min_code").otherwise("max_code").alias("field"))


@query("""with a as (select s_suppkey, s_name from supplier), b as (select s_suppkey, case when s_suppkey % 9 = 0 then s_name || '!' else s_name end s_name from supplier)
select 'only_a' side, * from (select * from a except all select * from b) union all select 'only_b', * from (select * from b except all select * from a)""")
def byte_equality(spark, sf_dir) -> DataFrame:
    a = table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    b = a.withColumn("s_name", F.when(F.col("s_suppkey") % 9 == 0, F.concat("s_name", F.lit("!"))).otherwise(F.col("s_name")))
    return a.exceptAll(b).withColumn("side", F.lit("only_a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("only_b")))


@query("""with steps as (select list(v order by i) t from (select i, list_reduce(range(9), lambda c, k: case when k = 0 then c when c & 1 = 1 then xor(c >> 1, 2197175160) else c >> 1 end, i) v from range(256) r(i)))
select c_custkey, xor(list_reduce(list_transform(string_split(c_name, ''), lambda x: ord(x)::bigint), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295), 4294967295)::bigint crc32c from customer, steps""")
def crc32c(spark, sf_dir) -> DataFrame:
    return hashing.with_crc32c(table(spark, sf_dir, "customer", "c_custkey", "c_name"), "c_name").select("c_custkey", "crc32c")


@query("""select o_orderkey, o_custkey::decimal(20, 0) u64, o_totalprice f64, o_totalprice::float::double f32, (o_custkey % 65536)::bigint u16 from orders""")
def typed_bytes(spark, sf_dir) -> DataFrame:
    """Numbers written to bytes, least first, and read again."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")

    def write(batches):
        for batch in batches:
            ids, key, price = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            rows = np.rec.fromarrays([key.astype("<u8"), price.astype("<f8"), price.astype("<f4"), (key % 65536).astype("<u2")], dtype=[("a", "<u8"), ("b", "<f8"), ("c", "<f4"), ("d", "<u2")])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([r.tobytes() for r in rows], pa.binary())], ["o_orderkey", "data"])

    data = o.mapInArrow(write, "o_orderkey long, data binary")
    d = F.col("data")
    return data.select("o_orderkey", hashing.from_le(d, 0, 8).alias("u64"), hashing.float_from_le(d, 8, 8).alias("f64"), hashing.float_from_le(d, 16, 4).alias("f32"), hashing.from_le(d, 20, 2).alias("u16"))


@query("""select o_orderkey, case when a + b < 18446744073709551616 then (a + b)::decimal(20, 0) end total, case when a + b >= 18446744073709551616 then 'arithmetic_overflow' end total_error,
  case when o_custkey::hugeint * b < 18446744073709551616 then (o_custkey::hugeint * b)::decimal(20, 0) end product, case when o_custkey::hugeint * b >= 18446744073709551616 then 'arithmetic_overflow' end product_error
from (select o_orderkey, o_custkey, 18446744073709550000::hugeint + o_orderkey a, (o_custkey * 100000007)::hugeint * 3000 b from orders)""")
def checked_arithmetic(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    a = F.lit("18446744073709550000").cast("decimal(20,0)") + F.col("o_orderkey")
    b = (F.col("o_custkey") * 100000007).cast("decimal(20,0)") * 3000
    total, product = checks.checked("add", a, b), checks.checked("multiply", F.col("o_custkey"), b)
    out = o.select("o_orderkey", total.alias("t"), product.alias("p"))
    return out.select("o_orderkey", F.col("t.value").alias("total"), F.col("t.error").alias("total_error"), F.col("p.value").alias("product"), F.col("p.error").alias("product_error"))
