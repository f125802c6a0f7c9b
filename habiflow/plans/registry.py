"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def finalize(df: DataFrame) -> DataFrame:
    """Output convention: local timestamps become zone-less (TIMESTAMP_NTZ),
    matching plain SQL TIMESTAMP."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from habiflow.session import apply_query_conf, ensure_checkpoint_dir
            apply_query_conf(spark)
            ensure_checkpoint_dir(spark)
            return finalize(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, sql)
        return fn
    return deco
