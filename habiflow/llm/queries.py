"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from habiflow.llm import bpe, chat, filter_audit, lattice, lexical, mixing, order_minhash, quality, secret_scan, sequences, simhash, suffix_dedup, warc

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _on(table: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    query.__doc__ = operator.__doc__
    return query


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op1_mixing(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.op12_ranked_search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.op13_filter_audit(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": _op1,
    "op2_quality_rules": _on("documents", quality.op2_quality_rules),
    "op3_chat_formatting": _on("conversations", chat.op3_chat_formatting),
    "op4_suffix_dedup": _on("documents", suffix_dedup.op4_suffix_dedup),
    "op5_document_fingerprints": _on("documents", order_minhash.op5_document_fingerprints),
    "op6_token_output": _on("documents", lambda docs: sequences.op6_token_output(docs, VOCABULARY)),
    "op7_secret_scans": _on("documents", secret_scan.op7_secret_scans),
    "op8_simhash_near_dedup": _on("documents", simhash.op8_simhash_near_dedup),
    "op9_bpe_encoding": _on("documents", lambda docs: bpe.op9_bpe_encoding(docs, VOCABULARY)),
    "op10_warc_revisits": _on("pages", warc.op10_warc_revisits),
    "op11_embedding_near_dedup": _on("embeddings", lattice.op11_embedding_near_dedup),
    "op12_ranked_search": _op12,
    "op13_filter_audit": _op13,
}

SQL: dict[str, str] = {
    "op3_chat_formatting": chat.OP3_SQL,
    "op10_warc_revisits": warc.OP10_SQL,
    "op11_embedding_near_dedup": lattice.OP11_SQL,
    "op12_ranked_search": lexical.OP12_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
