"""Records of several systems that describe one entity: edges, clusters, resolution and deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components


def identity_edges(records: DataFrame, key: str, fields: dict[str, Column]) -> DataFrame:
    """(a, b): each record and the smallest record with the same value of an identity field.

    A star per value instead of all pairs; nulls never match. The smallest key comes from an aggregate, so a
    common value costs one row per task in the shuffle.
    """
    out = None
    for value in fields.values():
        valued = records.select(F.col(key).alias("b"), value.alias("v")).where("v is not null")
        centre = valued.groupBy("v").agg(F.min("b").alias("a"))
        star = valued.join(centre, "v").where("a <> b").select("a", "b")
        out = star if out is None else out.unionByName(star)
    return out.distinct()


def clusters(edges: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """(key, cluster_id): the smallest record that edges reach; only records with an edge take part in the search."""
    found = components(edges).withColumnRenamed("node", "__node")
    met = records.select(key).distinct().join(found, F.col(key) == F.col("__node"), "left")
    return met.select(key, F.coalesce("root", key).alias("cluster_id"))


def coalesce_by(value: Column, priority: Column) -> Column:
    """The value of the best-ranked source that has one."""
    return F.min_by(value, F.when(value.isNotNull(), priority))


def last_modified(value: Column, at: Column) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), at))


def collected(value: Column) -> Column:
    return F.array_sort(F.collect_set(value))


def delta(resolved: DataFrame, base: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, _action, fields): insert, delete, update or noop between resolved and base records."""
    old = base.select(F.col(key), *[F.col(f).alias(f"__{f}") for f in fields], F.lit(True).alias("__old"))
    both = resolved.select(key, *fields, F.lit(True).alias("__new")).join(old, key, "full_outer")
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f).eqNullSafe(F.col(f"__{f}"))
    action = F.when(F.col("__old").isNull(), "insert").when(F.col("__new").isNull(), "delete").when(same, "noop").otherwise("update")
    return both.select(key, action.alias("_action"), *fields)
