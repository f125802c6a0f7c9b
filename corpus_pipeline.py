"""A corpus pipeline of five stages, each calling one operator of habiflow.llm.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; all but
the last return the columns of documents.  Nulls, empty and long texts, ties,
repeated rows, empty tables and further columns are handled as the operators
define; further columns are carried along in one struct, so names can't clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from habiflow.llm import bpe, mixing, quality, secret_scan, simhash
from habiflow.llm.common import stored
from habiflow.llm.queries import VOCABULARY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the base or the posterior rejects go."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "text")
    return quality.quality_rules(packed, "_doc").filter("kept").select("_doc.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group one row stays: that of the smallest id, if any has one; ties go by the text's hash.

    Rows are told apart by id and text, so an id that unrelated texts share, or
    that is null, neither drops nor keeps more than its own groups; of rows
    that repeat both, the other columns decide.
    """
    first = stored(simhash.first_rows(docs), "first_rows")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select(*simhash.row_key(), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                         F.to_json(F.struct(*others or [F.lit(0).alias("_")])).alias("_tie"))
    once = packed.groupBy(*simhash.KEY).agg(F.min_by("_doc", "_tie").alias("_doc"))
    return once.join(first, list(simhash.KEY), "left_semi").select("_doc.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: secrets give way to the mark of their kind; ``n_chars`` follows the text."""
    clean = secret_scan.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: a row stays with a chance of its rate, drawn from its id and text; none is repeated.

    Least squares may give the purest documents rates far above one and others
    of the clean domain little; as nothing is repeated here, documents that are
    likelier clean than not stay whatever their rate, and the rates decide on
    the other domains' documents.
    """
    labels = mixing.label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rates = mixing.mixed(docs, labels, budget_of="clean", spare=1.1)
    draw = F.pmod(F.xxhash64("doc_id", "_h", F.lit("mixing")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    out = rates.filter((draw >= F.col("rate")) & (F.col("p_clean") < 0.5)).select(F.col("doc_id").alias("_id"), F.col("_h").alias("_out"))
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col("doc_id").alias("_key"),
                    mixing.text_hash().alias("_h"))
    # shuffled at any size: what goes is a share of all rows, not a table that stays small
    return (d.join(out.hint("merge"), F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_out")), "left_anti")
            .select("_doc.*"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what is left."""
    return bpe.op9_bpe_encoding(docs, VOCABULARY)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("mixing", mixing_to_targets),
    ("bpe_encoding", bpe_encoding),
]

ORACLE_SQL = None  # an EM fit, components and a vocabulary file; the README says what tests hold against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
