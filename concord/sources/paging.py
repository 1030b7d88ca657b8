"""Scans in pages, windows and selections, as filters that reach the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jmespath


def cursor_window(df: DataFrame, cursor: str, after: str, span: str, now: str) -> DataFrame:
    """Rows after the watermark, up to a span later or now, whichever is earlier."""
    kind = "timestamp_ntz" if dict(df.dtypes)[cursor] == "timestamp_ntz" else "timestamp"
    end = F.least(F.expr(f"{kind} '{after}' + interval {span}"), F.expr(f"{kind} '{now}'"))
    return df.where((F.col(cursor) > F.expr(f"{kind} '{after}'")) & (F.col(cursor) <= end))


def offset_page(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """One page; for whole scans use key ranges (``keyset_page`` or a partitioned read), since offsets re-read what they skip."""
    return df.orderBy(*order).offset(offset).limit(limit)


def numbered_page(df: DataFrame, order: list[str], page: int, size: int) -> DataFrame:
    return offset_page(df, order, (page - 1) * size, size)


def keyset_page(df: DataFrame, key: str, after, limit: int) -> DataFrame:
    return df.where(F.col(key) > F.lit(after)).orderBy(key).limit(limit)


def properties(df: DataFrame, wanted: str | list[str]) -> DataFrame:
    """Columns named by a list, a comma list or a JSON array."""
    if isinstance(wanted, str):
        wanted = [w.strip(' "') for w in wanted.strip("[]").split(",")]
    return df.select(*wanted)


def select_records(payload: Column, expression: str) -> Column:
    """The records that a JMESPath expression finds in a page: objects as JSON, strings as they are.

    Null gives none, and anything but an array is a list of one.
    """
    def listed(found: Column) -> Column:
        each = F.transform(jmespath.items(found), lambda e: jmespath.text(jmespath.known(e)))
        return F.when(found.isNull(), F.array().cast("array<string>")).otherwise(F.coalesce(each, F.array(jmespath.text(found))))

    return jmespath._let(jmespath.search(payload, expression), listed)


def with_details(stubs: DataFrame, ref: str, details: DataFrame, key: str) -> DataFrame:
    """Stubs with their detail records; stubs without one are dropped."""
    return stubs.join(details, stubs[ref] == details[key])


def linked_ids(parents: DataFrame, field: str) -> DataFrame:
    return parents.select(F.explode(field).alias("child_id")).distinct()
