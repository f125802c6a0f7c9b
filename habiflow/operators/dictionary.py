"""Joins of long tables to dictionaries whose common keys would land in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habiflow.session import cut_lineage

SHARE = 1000      # a key with more than 1/1000 of the rows is common, so there are 1000 common keys at most
SPREAD = 1 << 20  # stand-ins that rows without a key or with a common one are dealt to


def common_keys(rows: DataFrame, key: str, share: int = SHARE) -> DataFrame:
    """``key`` of more than 1/``share`` of the rows that have one; ``share`` rows at most."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = cut_lineage(counts)
    limit = total.agg((F.sum("n") / share).alias("limit"))
    # one row beside the counts
    return total.crossJoin(F.broadcast(limit)).filter("n > limit").select(key)


def dictionary_join(rows: DataFrame, dictionary: DataFrame, key: str, share: int = SHARE) -> DataFrame:
    """Left join of ``rows`` to ``dictionary`` (one row a ``key``, a string) without a long task for a common key.

    The entries of the common keys, of which there are ``share`` at most, are
    broadcast.  Their rows and those without a key then take part in the
    shuffled join of the rest under stand-in keys that no entry has, so they
    are spread over all tasks.  Key and row order are kept out of the result's
    meaning: every row of ``rows`` comes out once.
    """
    values = [c for c in dictionary.columns if c != key]
    common = common_keys(rows, key, share)
    entries = common.withColumnRenamed(key, "__k").join(dictionary, F.col("__k") == F.col(key), "left")
    frequent = entries.select("__k", F.struct(*values).alias("__common"))
    rare = dictionary.select(F.concat(F.lit("k"), F.col(key)).alias("__rare_key"), F.struct(*values).alias("__rare"))
    x = rows.join(F.broadcast(frequent), F.col(key) == F.col("__k"), "left")
    stand_in = F.concat(F.lit("-"), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("string"))
    x = x.withColumn("__own_key", F.when(F.col(key).isNull() | F.col("__k").isNotNull(), stand_in)
                     .otherwise(F.concat(F.lit("k"), F.col(key))))
    x = x.join(rare, F.col("__own_key") == F.col("__rare_key"), "left")
    found = [F.coalesce(F.col(f"__common.{c}"), F.col(f"__rare.{c}")).alias(c) for c in values]
    return x.select(*rows.columns, *found)
