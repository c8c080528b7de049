"""The queries of this subpackage's operators on the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmend.llm import centroids, hamming_search, html_text, merkle, mixing, ngram_join, packing, repair, secret_scan, sharding, toxicity, url_filter, vector_dedup
from gridmend.llm.tables import table
from gridmend.session import scratch_path


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    repair.write_ids(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return repair.read_digests(spark, path)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("document.doc_id", "size", "source_size", "target", "taken")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.in_fold(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op7_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    return merkle.manifest(documents.withColumn("tampered", merkle.tampered(F.col("doc_id"), F.col("text"))))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_repair_ids": op1_repair_ids,
    "op2_mix_sources": op2_mix_sources,
    "op3_toxicity": op3_toxicity,
    "op4_ngram_join": op4_ngram_join,
    "op5_vector_dedup": op5_vector_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_hamming_search": op7_hamming_search,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_url_filter": op9_url_filter,
    "op10_shards": op10_shards,
    "op11_centroids": op11_centroids,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_html_text": op13_html_text,
}

ORACLES = {
    "op2_mix_sources": mixing.MIX_SQL.format(documents="documents") + "SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed",
    "op11_centroids": centroids.sql(),
    "op12_merkle_manifest": merkle.sql(),
}
