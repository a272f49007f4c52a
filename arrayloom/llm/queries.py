"""The registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dedup, filter_audit, fingerprints, html_mincut, jaccard, langid, licenses, matroska, mixing, packing, secret_scan, sharding, vector_codes
from .common import documents


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_rows(documents(spark, sf_dir), n_shards=16, load_factor=1.0)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.media_features(matroska.media_column(documents(spark, sf_dir)))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = langid.learn(docs.where(~held))
    out = langid.label_languages(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html_mincut.extract_pages(pages, weights=html_mincut.learn(pages))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).drop("rid")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_components(documents(spark, sf_dir), words=3, num=90, den=100)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_groups(documents(spark, sf_dir))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_orders(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP10_SQL = """SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""

QUERIES = {f.__name__: f for f in (op1_sharding, op2_matroska, op3_language_id, op4_html_extraction, op5_mixing, op6_packing, op7_license_scan, op8_ngram_jaccard, op9_secret_scan, op10_exact_dedup, op11_fingerprints, op12_vector_codes, op13_filter_audit)}
ORACLE_SQL = {"op7_license_scan": licenses.license_sql(), "op10_exact_dedup": OP10_SQL, "op12_vector_codes": vector_codes.vector_codes_sql(), "op13_filter_audit": filter_audit.filter_orders_sql()}
