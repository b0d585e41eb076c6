"""The registered queries of this subpackage: thin digests of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import ann, divergence, exact_topk, language, line_dedup, media, near_dedup, packing, prefix_trie, source_mix, token_store, toxicity, url_filter
from tallyloom.llm.shared import shared_dir, table, text_or_empty


def tokenizer(name: str) -> str:
    """Where a public vocabulary lies; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def crc_mod(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``: which fold a row is in."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(n))


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).withColumnRenamed("id", "vec_id")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_dedup.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return classes.select(F.col("id").alias("doc_id"), "class_id", (F.col("row") == F.col("keeper")).alias("kept"))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), "text")
    rows = media.wav_features(media.to_wav(docs).select("doc_id", "n_bytes", "media"))
    return rows.select("doc_id", "n_bytes", "media_features.*")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"), F.col("url_rule").alias("rule"), F.col("url_verdict").alias("verdict"), F.col("url_strict").alias("strict_terms"), F.col("url_soft").alias("soft_terms"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer("word_bpe_49k.json"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), removed="removed")
    return out.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Learned from the labelled rows outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 3) != 1)
    return toxicity.train(table(spark, sf_dir, "documents").select("doc_id", "text"), labels.select("doc_id", "toxic"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"), toxicity_model(spark, sf_dir))
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-store")
    token_store.write_store(table(spark, sf_dir, "documents").select("doc_id", "text"), path, tokenizer("byte_bpe_50k.json"))
    token_store.verify(spark, path)
    return token_store.read_store(spark, path).select(F.col("doc").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), "ids_crc32")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod("doc_id", 5) == 0
    model = language.train(docs.where(~held_out))
    out = language.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = source_mix.mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest": op1_nearest,
    "op2_near_dedup": op2_near_dedup,
    "op3_media_columns": op3_media_columns,
    "op4_url_filters": op4_url_filters,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_token_store": op8_token_store,
    "op9_language_id": op9_language_id,
    "op10_mix_sources": op10_mix_sources,
    "op11_source_divergence": op11_source_divergence,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_exact_topk": op13_exact_topk,
}

_OP6 = """
with lines as (
  select doc_id, hash(text) as h, text, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos
  from documents where text is not null),
windows as (
  select distinct doc_id, text, pos, line || chr(10) || l1 || chr(10) || l2 as w
  from (select *, lead(line, 1) over p as l1, lead(line, 2) over p as l2
        from (select distinct doc_id, text, pos, line from lines) window p as (partition by doc_id, text order by pos))
  where l2 is not null and (trim(line) <> '' or trim(l1) <> '' or trim(l2) <> '')),
placed as (select *, row_number() over (partition by w order by doc_id, pos) as place from windows),
cut as (select distinct doc_id, text, pos + d as pos from placed, range(3) as r(d) where place > 1),
gone as (select doc_id, text, count(*) as n, list(pos order by pos) as cut_lines from cut group by all)
select d.doc_id,
  case when g.n is null then d.text else coalesce((select string_agg(x.l, chr(10) order by x.i) from
    (select unnest(string_split(d.text, chr(10))) as l, unnest(range(len(string_split(d.text, chr(10))))) as i) x where not list_contains(g.cut_lines, x.i)), '') end as text,
  coalesce(g.n, 0) as n_removed, coalesce(array_to_string(g.cut_lines, ','), '') as removed_lines
from documents d left join gone g on d.doc_id = g.doc_id and d.text = g.text"""

ORACLE_SQL: dict[str, str] = {"op4_url_filters": url_filter.oracle(), "op6_line_dedup": _OP6, "op10_mix_sources": source_mix.oracle(), "op11_source_divergence": divergence.oracle(), "op12_prefix_trie": prefix_trie.oracle(), "op13_exact_topk": exact_topk.oracle()}
