"""Quality rules: each gives the reason why a record fails, or null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import records as R


def required(field: str) -> Column:
    return F.when(F.col(field).isNull() | (F.col(field).cast("string") == ""), F.lit(f"required:{field}"))


def pattern(field: str, regex: str) -> Column:
    return F.when(~R.full_match(F.col(field).cast("string"), regex), F.lit(f"regex:{field}"))


def min_length(field: str, n: int) -> Column:
    return F.when(F.length(F.col(field).cast("string")) < n, F.lit(f"min_length:{field}"))


def max_length(field: str, n: int) -> Column:
    return F.when(F.length(F.col(field).cast("string")) > n, F.lit(f"max_length:{field}"))


def allowed_values(field: str, values: list) -> Column:
    return F.when(~F.col(field).isin(values), F.lit(f"allowed_values:{field}"))


def unique(field: str, arrival: list[str]) -> Column:
    """Every occurrence after the first, by arrival; nulls are equal to each other.

    A value's rows meet in one sort; for a value that may hold a large part of the table, ``mark_repeats`` is meant.
    """
    return F.when(F.row_number().over(Window.partitionBy(field).orderBy(*arrival)) > 1, F.lit(f"unique:{field}"))


def mark_repeats(df: DataFrame, field: str, arrival: str, mark: str) -> DataFrame:
    """As ``unique`` over a distinct arrival number: the first of each value is found by an aggregate, so hot values don't meet in a sort."""
    first = df.groupBy(F.col(field).alias("__value")).agg(F.min(arrival).alias("__first"))
    met = df.join(first, F.col(field).eqNullSafe(F.col("__value")))
    return met.withColumn(mark, F.when(F.col(arrival) > F.col("__first"), F.lit(f"unique:{field}"))).drop("__value", "__first")


def check(df: DataFrame, rules: list[Column]) -> DataFrame:
    """``df`` with ``violations``, the reasons of all rules that fail."""
    return df.withColumn("violations", F.filter(F.array(*rules), lambda v: v.isNotNull()))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that pass every rule, and those that don't."""
    return checked.where(F.size("violations") == 0).drop("violations"), checked.where(F.size("violations") > 0)


def dead_letters(rejected: DataFrame, key: str, raw: Column, run_id: str, at: str) -> DataFrame:
    return rejected.select(
        F.col(key).cast("string").alias("external_id"),
        raw.alias("raw"),
        F.array_join("violations", "; ").alias("error_message"),
        F.lit("data_error").alias("error_class"),
        F.lit(at).alias("failed_at"),
        F.lit(run_id).alias("sync_run_id"),
        F.lit(0).alias("requeue_count"),
    )


def payload_errors(schema: dict[str, str], required_fields: list[str], extra_allowed: bool, payload: Column) -> Column:
    """Reasons why a JSON payload does not fit: missing fields, wrong types (a boolean counts as integer), other fields."""
    value = F.try_parse_json(payload)
    fits = {
        "string": ["STRING"],
        "integer": ["BIGINT", "BOOLEAN"],
        "number": ["BIGINT", "DOUBLE", "BOOLEAN"],
        "boolean": ["BOOLEAN"],
    }
    out = [F.when(F.get_json_object(payload, f"$.{f}").isNull(), F.lit(f"required:{f}")) for f in required_fields]
    for name, kind in schema.items():
        found = F.schema_of_variant(F.try_variant_get(value, f"$.{name}", "variant"))
        found = F.regexp_replace(found, r"^DECIMAL.*", "DOUBLE")
        out.append(F.when(found.isNotNull() & (found != "VOID") & ~found.isin(fits[kind]), F.lit(f"type:{name}")))
    if not extra_allowed:
        others = F.array_except(F.json_object_keys(payload), F.array(*[F.lit(n) for n in schema]))
        out.append(F.when(F.size(others) > 0, F.concat(F.lit("additional:"), F.array_join(F.array_sort(others), ","))))
    return F.filter(F.array(*out), lambda v: v.isNotNull())
