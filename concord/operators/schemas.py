"""Schemas as data: differences, observed fields, drift and additive migration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jmespath import kind_of, known


def _columns(spark: SparkSession, schema: T.StructType, as_name: str) -> DataFrame:
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema], f"name string, {as_name} string")


def diff(spark: SparkSession, old: T.StructType, new: T.StructType) -> DataFrame:
    """(name, change): fields added, removed and retyped."""
    both = _columns(spark, old, "was").join(_columns(spark, new, "now"), "name", "full_outer")
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "retyped")
    return both.select("name", change.alias("change")).where("change is not null")


def observed(df: DataFrame, payload: str) -> DataFrame:
    """Distinct top-level fields of a JSON column."""
    return df.select(F.explode(F.json_object_keys(payload)).alias("field")).distinct()


def observed_types(df: DataFrame, payload: str) -> DataFrame:
    """(field, type) of the top-level fields of a JSON column: number, string, boolean, array or object; mixed if records disagree, null if
    a field never has a value. One aggregate over all records."""
    entries = df.select(F.explode(F.try_variant_get(F.try_parse_json(payload), "$", "map<string,variant>")).alias("field", "value"))
    kinds = entries.groupBy("field").agg(F.min(kind_of(known(F.col("value")))).alias("least"), F.max(kind_of(known(F.col("value")))).alias("most"))
    return kinds.select("field", F.when(F.col("least") == F.col("most"), F.col("least")).when(F.col("least").isNotNull(), "mixed").alias("type"))


def diff_types(old: DataFrame, new: DataFrame) -> DataFrame:
    """(field, change, was, now) between two ``observed_types``: added, removed and retyped fields; a type that was never seen retypes nothing."""
    both = old.select("field", F.col("type").alias("was"), F.lit(True).alias("__old")).join(new.select("field", F.col("type").alias("now"), F.lit(True).alias("__new")), "field", "full_outer")
    change = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").when(F.col("was") != F.col("now"), "retyped")
    return both.select("field", change.alias("change"), "was", "now").where("change is not null")


def drift(spark: SparkSession, fields: DataFrame, known: list[str]) -> DataFrame:
    """(field, drift): new fields, and known ones that no record has any more."""
    before = spark.createDataFrame([(k,) for k in known], "field string")
    return fields.exceptAll(before).withColumn("drift", F.lit("new")).union(before.exceptAll(fields).withColumn("drift", F.lit("orphan")))


def bumped(version: int, drifted: DataFrame) -> DataFrame:
    """(_schema_version): one more if there are new fields."""
    return drifted.agg((F.lit(version) + (F.count_if(F.col("drift") == "new") > 0).cast("int")).alias("_schema_version"))


def migrate(df: DataFrame, wanted: T.StructType, prune: bool = False) -> DataFrame:
    """Add missing fields as null texts; drop others only if asked; never retype."""
    there = df.columns
    df = df.withColumns({f.name: F.lit(None).cast("string") for f in wanted if f.name not in there})
    return df.select(*wanted.names) if prune else df
