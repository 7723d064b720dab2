"""Queries of this subpackage's operators over whole test tables, with DuckDB SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bitsliced_topk, iforest_rules, kk_packing, kn_langid, license_rules, merkle, mixing, secret_tokens, simhash_anchor,
               sparse_suffix, warc_zstd, weak_quality, whitening)
from .common import table

#: Vocabulary files, by the path they have on every executor.
PACK_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SECRET_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: Share of all tokens that each labelled domain shall have in the mix.
TARGETS = {"good": 0.92, "good_toxic": 0.045, "poor": 0.03, "poor_toxic": 0.005}


def labelled_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, domain`` of the labelled documents."""
    return (table(spark, sf_dir, "labels").dropna(subset=["quality", "toxic"])
            .select("doc_id", F.concat(F.when(F.col("quality") > 0, "good").otherwise("poor"),
                                       F.when(F.col("toxic") > 0, "_toxic").otherwise("")).alias("domain")))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.quality_scores(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_anchor.simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kk_packing.pack(table(spark, sf_dir, "documents"), PACK_VOCABULARY)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kn_langid.identify(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iforest_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sparse_suffix.repeated_passages(table(spark, sf_dir, "documents"), min_words=50)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced_topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.find_licenses(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_tokens.find_secrets(table(spark, sf_dir, "documents"), SECRET_VOCABULARY)
    base = F.filter("found", lambda x: x["kind"] != "random")

    def number(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))

    return found.select("doc_id", number("assign"), number("access"), number("hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.domain_rates(table(spark, sf_dir, "documents"), labelled_domains(spark, sf_dir), TARGETS)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zstd.archive_pages(table(spark, sf_dir, "pages"), min_bytes=0)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_simhash": op2_simhash,
    "op3_packing": op3_packing,
    "op4_language": op4_language,
    "op5_quality_rules": op5_quality_rules,
    "op6_passages": op6_passages,
    "op7_topk": op7_topk,
    "op8_licenses": op8_licenses,
    "op9_secrets": op9_secrets,
    "op10_mixing": op10_mixing,
    "op11_warc": op11_warc,
    "op12_merkle": op12_merkle,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {
    "op8_licenses": license_rules.duckdb_sql(),
    "op11_warc": warc_zstd.duckdb_sql(),
    "op12_merkle": merkle.duckdb_sql(),
    "op7_topk": """
        WITH parts AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
            FROM parts q JOIN parts c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}
