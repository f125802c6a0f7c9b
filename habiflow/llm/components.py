"""Connected components of a link table, for links of any number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habiflow.llm.common import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of itself and its neighbours."""
    both = edges.select(F.col("u").alias("n"), F.col("v").alias("m")).union(edges.select("v", "u"))
    least = both.groupBy("n").agg(F.min("m").alias("_m")).select("n", F.least("n", "_m").alias("least"))
    return (both.filter("m > n").join(least, "n").select(F.col("m").alias("u"), F.col("least").alias("v"))
            .distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("n"), F.least("u", "v").alias("m")).filter("n > m")
    least = down.groupBy("n").agg(F.min("m").alias("least"))
    moved = down.join(least, "n").filter("m > least").select(F.col("m").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select(F.col("n").alias("u"), F.col("least").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(u, v)``; root is the smallest node it reaches.

    Alternates large-star and small-star rounds until every node hangs off its
    root.  Each round is reliably checkpointed and only counts reach the
    driver; a hub's links are rows of a join, never a collected list.
    """
    links = cut_lineage(edges.select("u", "v").filter("u <> v").distinct())
    last = None
    while True:
        links = cut_lineage(_small_star(_large_star(links)))
        row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == last or row[0] == 0:
            break
        last = tuple(row)
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.distinct())
