"""Connected components of a table of links, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import cut_lineage


def _state(links: DataFrame) -> tuple[int, int]:
    found = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return found.n, int(found.s or 0)


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``; the component is its least node.

    In a round every node first ties its larger neighbours to the least one it sees, then
    its smaller ones and itself. Minima are combined before they are shuffled and then joined,
    so a node with many links is no group of its own. The rounds, about as many as the
    logarithm of the longest chain, end when nothing changes.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = cut_lineage(links.filter(F.col("a") != F.col("b")).distinct())
    before = _state(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Stored, so that the join deals out both sides anew and can split a node with many links.
        least = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        larger = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = cut_lineage(larger.distinct())
        least = cut_lineage(larger.groupBy("a").agg(F.min("b").alias("m")))
        smaller = larger.join(least, "a")
        tied = smaller.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        links = cut_lineage(tied.filter(F.col("a") != F.col("b")).distinct())
        after = _state(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
