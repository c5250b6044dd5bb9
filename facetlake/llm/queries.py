"""The queries opN_<name> of the ten operators and the SQL that some of them equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetlake.llm import decontaminate, embeddings, html, lm, minhash, mixing, quality, suffix, tokens, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, threshold=(85, 100))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = quality.fold("doc_id", 5) == 0
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    scored = quality.quality_scores(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "labels").filter("quality = 1")
    return lm.cross_entropy_difference(table(spark, sf_dir, "documents"), target)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = quality.fold("doc_id", 4) == 2
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    scored = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality": op3_quality,
    "op4_token_counts": op4_token_counts,
    "op5_mixing": op5_mixing,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_html_text": op8_html_text,
    "op9_toxicity": op9_toxicity,
    "op10_suffix_dedup": op10_suffix_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op6_embedding_dedup": """
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: x::double) e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id u, b.vec_id v from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) as (select vec_id, vec_id from embeddings union select reach.a, links.v from reach join links on reach.b = links.u)
select vec_id, coalesce(n, 0)::bigint n_links, c component_id, vec_id = c kept
from embeddings left join (select u, count(*) n from links group by u) on u = vec_id join (select a, min(b) c from reach group by a) on a = vec_id""",
    "op1_minhash_dedup": r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) s from words),
sizes as (select doc_id, count(*) n from shingles group by doc_id),
pairs as (select a.doc_id u, b.doc_id v, count(*) c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (select u, v from pairs join sizes x on x.doc_id = u join sizes y on y.doc_id = v where 100 * c >= 85 * (x.n + y.n - c)),
ways as (select u, v from links union all select v, u from links),
reach(a, b) as (select doc_id, doc_id from documents union select reach.a, ways.v from reach join ways on reach.b = ways.u)
select doc_id, coalesce(n, 0)::bigint n_shingles, c component_id, doc_id = c kept
from documents left join sizes using (doc_id) join (select a, min(b) c from reach group by a) on a = doc_id""",
    "op2_decontaminate": r"""
with dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
iw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
pats as (
  select distinct item_id, least(len(w), 13) m, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) p
  from iw where len(w) > 0),
lens as (select distinct m from pats),
wins as (select doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') p from dw, lens, unnest(range(1, len(w) - m + 2)) t(i) where len(w) >= m),
occ as (select doc_id, i, wins.m, item_id from wins join pats on wins.m = pats.m and wins.p = pats.p),
hits as (select doc_id, count(distinct k) n from occ, unnest(range(i, i + m)) t(k) group by doc_id),
ids as (select doc_id, count(*) n, string_agg(s, ',' order by s) l from (select distinct doc_id, item_id::varchar s from occ) group by doc_id)
select doc_id, len(w)::bigint n_words, coalesce(hits.n, 0)::bigint n_hit, coalesce(ids.n, 0)::bigint n_items, sha256(coalesce(l, '')) items_sha256,
  coalesce(hits.n, 0) > 0 and 20 * coalesce(hits.n, 0) >= len(w) contaminated
from dw left join hits using (doc_id) left join ids using (doc_id)""",
}
