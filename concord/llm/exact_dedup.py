"""Exact deduplication with a heavy-hitter split.

A frequent-items sketch (the mergeable Misra-Gries family, ``approx_top_k``) finds digests that may be
frequent. Their exact counts and winners are verified by an aggregate that only those digests enter, and the
at most ``heavy_limit`` verified rows are broadcast, so rows of large groups of copies get their answer on the
map side and never meet in one task. All other digests are shuffled once; each of their groups is
smaller than about 1/heavy_limit of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import staged, text_or_empty

HEAVY_LIMIT = 1000
TRACKED = 10_000


def exact_duplicates(docs: DataFrame, heavy_limit: int = HEAVY_LIMIT, tracked: int = TRACKED) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null and empty texts are equal. The largest doc_id of a group stays; a null doc_id stays only in a group
    without other ids. Rows that repeat a doc_id with the same text all count in group_size and share
    ``kept``. Other columns of ``docs`` are ignored; an empty table gives an empty result. Texts of any length are
    digested whole.
    """
    digests = staged(docs.select("doc_id", F.sha2(text_or_empty(), 256).alias("text_sha256")), "exact-digests")
    sketch = digests.select(F.expr(f"explode(approx_top_k(text_sha256, {heavy_limit}, {tracked}))").alias("t"))
    frequent = sketch.select(F.col("t.item").alias("text_sha256"))
    # at most heavy_limit rows: the sketch returns no more
    winners = (
        digests.join(F.broadcast(frequent), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    winners = staged(winners, "exact-winners")
    marked = digests.join(F.broadcast(winners), "text_sha256", "left")
    heavy = marked.where("group_size is not null")
    group = Window.partitionBy("text_sha256")
    light = (
        marked.where("group_size is null")
        .select("doc_id", "text_sha256")
        .withColumn("keep_id", F.max("doc_id").over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    columns = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"]
    return heavy.select(*columns).unionByName(light.select(*columns))
