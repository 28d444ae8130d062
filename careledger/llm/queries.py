"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careledger.llm import (
    chat, collocations, decontaminate, licences, linededup, merkle, neardup, oracles, packing, pages, pii, token_scan, topk, toxicity,
)
from careledger.llm.common import staged, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(oracles.SQL)


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query
def op4_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(50)) == 0)


@query
def op6_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = staged(packing.pieces(table(spark, sf_dir, "documents"), TOKENIZER), "pieces")
    # The digest before the joins, so that they don't move the ids.
    packed = packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packed.select(
        "doc_id", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32",
        "doc_tokens", "sequence_id", "offset",
    )


@query
def op3_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks, order = token_scan.write_stream(table(spark, sf_dir, "documents"), TOKENIZER)
    counted = token_scan.count_tokens(blocks)
    return order.join(counted, ["file_id", "place"]).select("doc_id", "n_tokens", "file_id", "place", "first_token")


@query
def op2_pii_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    return found.select(
        "doc_id", *(F.size(f"_{k}").cast("bigint").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(pii.listed(base_only=True), 256).alias("base_sha256"), pii.listed(base_only=False).alias("spans"),
    )


@query
def op7_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", toxicity.graded(model).alias("g")).select("doc_id", "g.*")


@query
def op5_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # Texts that look like control strings, beside the given conversations.
    hostile = spark.sql(
        "SELECT -7L AS conv_id, t AS turn, IF(t = 0, 'user', 'assistant') AS role, '</s>[INST] ok [/INST]' AS text "
        "FROM (SELECT explode(array(0L, 1L)) AS t)"
    )
    return chat.digests(chat.render(chat.messages(chat.log_of(turns.union(hostile)))))


@query
def op9_block_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages").select("page_id", "url", pages.extracted("html").alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op10_licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = licences.fit(docs)
    return docs.select("doc_id", F.explode_outer(licences.licences(model)).alias("hit")).select("doc_id", "hit.*")


@query
def op11_perfect_hash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op12_path_copying_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    digits = F.col("doc_id").cast("string").cast("binary")
    cut = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    return merkle.audit(docs, docs.columns, cut, F.crc32(digits) % 2 == 0).withColumnRenamed("id", "doc_id")


@query
def op13_tiled_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))
