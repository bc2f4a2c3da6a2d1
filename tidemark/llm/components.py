"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.shared import settled


def _nearest(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links with both sides exchanged when they meet the smallest neighbour of ``a``, so that a hub's links can be split."""
    return links, settled(links.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("low")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b): root is the smallest node that can be reached.

    Large-star and small-star rounds alternate until nothing changes; the links of a node never meet in one place but for
    their minimum, which Spark combines before the exchange. Links may repeat, run either way or loop; without any,
    the result is empty. Each round's links are written to the checkpoint folder.
    """
    a, b = F.col("a"), F.col("b")
    star = settled(links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    seen = None
    while True:
        both, low = _nearest(star.union(star.select(b.alias("a"), a.alias("b"))))
        low = low.select("hub", F.least("hub", "low").alias("low"))
        large = both.join(low, both.a == low.hub).where(b > a).select(b.alias("a"), F.col("low").alias("b")).distinct()
        large = settled(large)
        _, low = _nearest(large)
        small = large.join(low, large.a == low.hub).where(b != F.col("low")).select(b.alias("a"), F.col("low").alias("b"))
        star = settled(small.union(low.select(F.col("hub").alias("a"), F.col("low").alias("b"))).distinct())
        now = star.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return star.select(a.alias("node"), b.alias("root")).union(star.select(b, b).distinct())
