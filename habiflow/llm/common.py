"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habiflow.session import cut_lineage, stage_path

# fixed values: white space that separates words
WORD_BREAK = r"[\x20\x09-\x0D]+"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of ``[^\\x20\\x09-\\x0D]`` in text order."""
    return F.array_remove(F.split(text, WORD_BREAK), "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts lineage with a table every executor can see; each call takes a new
    folder, so a repeated run never reads another run's rows.
    """
    path = stage_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


__all__ = ["WORD_BREAK", "cut_lineage", "stored", "text_or_empty", "words"]
