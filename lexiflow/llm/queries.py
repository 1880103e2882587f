"""The registered queries opN_<name>: each operator over its whole table, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.llm import (ann_tree, cotrain_quality, decontaminate, embedding_dedup, html_extract,
                          license_scan, merkle, packing, poisson_mix, secret_scan, simhash_dedup,
                          token_counts, whitening)
from lexiflow.llm.common import table
from lexiflow.session import scratch_path

PIECE_MODEL = "piece_bpe_32k.model"
RANK_FILE = "byte_bpe_50k.tiktoken"


def op1_cotrain_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain_quality.score_documents(table(spark, sf_dir, "documents"),
                                           table(spark, sf_dir, "labels"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path(PIECE_MODEL))


def op3_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the documents and ``copies``, ``copy``, ``order_key``; input columns of these names are left out."""
    added = {"_copies": "copies", "_copy": "copy", "_key": "order_key"}
    mixed = poisson_mix.mix(table(spark, sf_dir, "documents").drop(*added, *added.values()))
    return mixed.withColumnsRenamed(added)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a ledger of its own per call: the query's rows are those of a first, whole scan
    found = secret_scan.scan(table(spark, sf_dir, "documents"), scratch_path(spark, "ledger"))
    return secret_scan.finding_digest(found).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))


def op6_ann_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE),
                        public_tokenizers.PATTERN)


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.near_duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_cotrain_quality, op2_token_counts, op3_poisson_mix, op4_secret_scan, op5_decontaminate,
    op6_ann_tree, op7_license_scan, op8_pack_tokens, op9_html_extract, op10_simhash_dedup,
    op11_merkle_manifest, op12_embedding_whitening, op13_embedding_dedup)}
