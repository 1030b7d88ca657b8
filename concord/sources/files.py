"""Readers of exported files and record streams, on Spark's own sources.

Text formats give one ``record`` column of JSON objects or values as text; bad lines are left out and can be counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.records import dot_path


def _checked(lines: Column) -> Column:
    """The trimmed line if it is one JSON value, else null (also if an object repeats a key)."""
    text = F.regexp_replace(lines, r"^\s+|\s+$", "")
    # parsers stop behind the first value; whatever follows it breaks one of these frames
    framed, listed = F.concat(F.lit('{"a":'), text, F.lit(',"z":0}')), F.concat(F.lit("["), text, F.lit(",0]"))
    whole = F.try_parse_json(framed).isNotNull() & (F.size(F.json_object_keys(framed)) == 2) & F.try_parse_json(listed).isNotNull()
    return F.when(whole, text)


def json_lines(lines: DataFrame) -> DataFrame:
    """(record) for each line of ``value`` that is JSON; blank and bad lines are skipped. Works on streams too.

    Read ``lines`` with ``spark.read.text`` or ``spark.readStream.text``.
    """
    return lines.select(_checked(F.col("value")).alias("record")).where("record is not null")


def bad_lines(lines: DataFrame) -> DataFrame:
    """(blank, bad): how many lines ``json_lines`` skips."""
    blank = F.trim(F.regexp_replace("value", r"\s", "")) == ""
    return lines.agg(F.count_if(blank).alias("blank"), F.count_if(~blank & _checked(F.col("value")).isNull()).alias("bad"))


def event_lines(events: DataFrame) -> DataFrame:
    """(record) for each ``data: `` line of server-sent events, whose lines are in ``value``; other lines and bad data are skipped.

    Works on streams. An event's end needs no look-ahead, as each data line is a record of its own.
    """
    data = F.when(F.col("value").startswith("data: "), F.substring("value", 7, 2**31 - 1))
    return events.select(_checked(data).alias("record")).where("record is not null")


def json_array(files: DataFrame, selector: str | None = None) -> DataFrame:
    """(record) for each object in the array that a whole file (``value``) is, or holds under a dotted path.

    Elements that are no objects, and files without such an array, give nothing. Read ``files`` with ``wholetext``: one file is
    one row, so exports should come as many files.
    """
    text = F.col("value") if selector is None else dot_path(F.col("value"), selector)
    items = files.select(F.explode(F.from_json(text, "array<variant>")).alias("item"))
    return items.where(F.schema_of_variant("item").startswith("OBJECT")).select(F.to_json("item").alias("record"))


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """All columns of CSV files with a header row, as texts; empty and missing fields are empty texts, quoted ones may hold line breaks."""
    rows = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    return rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns])


def xml_rows(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """The elements named ``tag``: child texts by name, attributes as ``@name``, namespaces left out, all as texts; no text: empty."""
    rows = spark.read.options(rowTag=tag, attributePrefix="@", ignoreNamespace=True, inferSchema=False, nullValue="\u0000").xml(path)
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns])


def as_records(rows: DataFrame) -> DataFrame:
    """Rows as (record): one JSON object of all columns that have a value."""
    return rows.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("record"))
