"""One query per operator, over the driver's whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, editfp, langid, lm, packing, sharding, simhash, toxicity, warc
from .common import table


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies; the operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, distance=2)


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"), lm.training_rows(F.col("doc_id")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), n_shards=8)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editfp.fingerprint_documents(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_language, op3_simhash, op4_ann, op5_lm, op6_toxicity, op7_shards, op8_packing, op9_warc, op10_fingerprints)}

#: Only the archive query has an exact form in SQL; the others are tested against brute force in tests/llm.
ORACLE_SQL = {
    "op9_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
             g AS (SELECT payload_digest, max(page_id) AS largest FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < largest THEN largest END AS refers_to
        FROM p LEFT JOIN g USING (payload_digest)
    """,
}
