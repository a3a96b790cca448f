"""Connected components by alternating stars, over tables of links only.

Each node hands its larger neighbours, then its smaller ones, to the least node it knows, until every
link leads to the least node of its component. Minima are partial aggregates, and every step is stored in
the shared folder, so a node with very many links neither gathers in one task nor lengthens the lineage; the
joins are between stored tables, which adaptive execution splits where one node is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Links ``a > b``. Large star: each node's larger neighbours to its least; small star: the others."""
    if larger:
        sides = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = links
    least = materialise(sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
    moved = sides.join(least, "a")
    if larger:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b")))
    return moved.where("a <> b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether the links are stars: each larger node has one link, to a node that has none itself."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0)).isEmpty()


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of ``links`` (``a``, ``b``, longs)."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialise(links, "links")
    for _ in range(max_rounds):
        if _settled(links):
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        links = materialise(_star(_star(links, True), False), "links")
    raise RuntimeError(f"links still move after {max_rounds} rounds")
