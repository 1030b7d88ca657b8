"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged, unstaged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (columns a, b); root is the component's smallest node.

    Every round is two aggregates and two joins over the edge table, written to the shared folder; nothing
    but a count and a checksum reaches the driver. Rounds grow with the logarithm of the longest path, and end when nothing
    changes; a round's tables are deleted once the next one stands.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = staged(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), "small-star-minima")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = staged(small.union(least).distinct(), "small-star")
        for done in (now, large, least):
            unstaged(done)
        now = after
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            roots = now.select(F.col("b").alias("a"), "b").distinct()
            return now.union(roots).toDF("node", "root")
        mark = seen
