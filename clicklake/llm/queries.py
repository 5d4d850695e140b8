"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.llm import bisectors, chunk_dedup, html_text, language, line_dedup, minhash, mixing, packing, pivots, repair, sharding, sql, topk, warc
from clicklake.llm.common import table

QUERY_STEP, NEIGHBOURS, SCALE = 20, 20, 64


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    placed = sharding.assign_shards(docs, 16, grown=17)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs, language.train(docs))
    return found.select("row.doc_id", "lang_pred", "score").withColumn("held_out", language.held_out())


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages").select("page_id", "url", "html"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", taken)


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("row.doc_id", "n_lines", "n_removed", F.col("kept_text").alias("text"))


def op6_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.near_vectors(table(spark, folder, "embeddings"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(table(spark, folder, "documents").select("doc_id", "text"))


def op8_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), 85)


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract_main_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").where(topk.usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    vectors = rows.select("vec_id", whole.alias("vector"))
    asked = vectors.where(F.col("vec_id") % QUERY_STEP == 0).withColumnRenamed("vec_id", "query_id")
    return topk.exact_top_k(asked, vectors, NEIGHBOURS)


def op11_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = chunk_dedup.exact_groups(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_bisectors(spark: SparkSession, folder: str) -> DataFrame:
    return bisectors.cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"), k=40, rounds=5, scale=256, size=64, seed=2)


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, folder, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    run.__name__: run
    for run in (
        op1_sharding, op2_language, op3_warc, op4_mixing, op5_line_dedup,
        op6_embedding_near_dedup, op7_packing, op8_minhash, op9_html_text, op10_top_k,
        op11_chunk_dedup, op12_bisectors, op13_repair,
    )
}

ORACLES: dict[str, str] = {
    "op3_warc": sql.OP3_WARC,
    "op4_mixing": sql.OP4_MIXING,
    "op6_embedding_near_dedup": sql.OP6_NEAR_VECTORS,
    "op10_top_k": sql.OP10_TOP_K,
    "op11_chunk_dedup": sql.OP11_CHUNK_DEDUP,
    "op12_bisectors": sql.OP12_BISECTORS,
    "op13_repair": sql.OP13_REPAIR,
}
