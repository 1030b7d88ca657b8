"""Queries of file and stream readers: tables are written as exports and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources import files, staging
from .registry import query, table


def _folder(spark, name):
    return f"{staging.checkpoint_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _event_lines(spark, d):
    """Each event's props as a line; every fifth is broken, every seventh blank, every eleventh has blanks around it."""
    k = F.col("event_id")
    line = F.when(k % 5 == 0, F.concat("props", F.lit("]"))).when(k % 7 == 0, "  ").when(k % 11 == 0, F.concat(F.lit("  "), "props", F.lit(" \t"))).otherwise(F.col("props"))
    path = _folder(spark, "lines")
    table(spark, d, "events").select(line.alias("value")).write.text(path)
    return spark.read.text(path)


@query("SELECT props AS record, count(*) AS n FROM events WHERE event_id % 5 <> 0 AND event_id % 7 <> 0 GROUP BY 1")
def read_json_lines(spark, d):
    return files.json_lines(_event_lines(spark, d)).groupBy("record").agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (WHERE event_id % 7 = 0 AND event_id % 5 <> 0) AS blank, count(*) FILTER (WHERE event_id % 5 = 0) AS bad FROM events")
def read_bad_lines(spark, d):
    return files.bad_lines(_event_lines(spark, d))


@query("SELECT '{\"id\":' || event_id || '}' AS record FROM events WHERE event_id % 3 <> 0")
def read_event_stream(spark, d):
    """Server-sent events: comments, other fields and bad data are left out."""
    k = F.col("event_id").cast("string")
    data = F.when(F.col("event_id") % 3 == 0, F.lit("data: {bad")).otherwise(F.concat(F.lit('data: {"id":'), k, F.lit("}")))
    path = _folder(spark, "events")
    table(spark, d, "events").select(F.concat(F.lit(": ping\nevent: change\nid: "), k, F.lit("\n"), data, F.lit("\n")).alias("value")).write.text(path)
    return files.event_lines(spark.read.text(path))


@query("SELECT '{\"id\":' || n_nationkey || ',\"name\":\"' || n_name || '\"}' AS record FROM nation")
def read_json_array(spark, d):
    """Files that hold an array of objects, two levels down, with items that are none."""
    record = F.concat(F.lit('{"id":'), F.col("n_nationkey").cast("string"), F.lit(',"name":"'), "n_name", F.lit('"}'))
    rows = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.collect_list(record), ",\n ").alias("items"))
    path = _folder(spark, "arrays")
    rows.repartition(5).select(F.concat(F.lit('{"result": {"items": [7, null, "x", '), "items", F.lit("]}}")).alias("value")).where("items is not null").write.text(path)
    whole = spark.read.text(path, wholetext=True)
    return files.json_array(whole, "result.items")


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name || ', \"x\"' || chr(10) || 'y' AS c_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS segment FROM customer")
def read_csv(spark, d):
    """Quotes, commas, line breaks and empty fields come back as they were; everything is text."""
    c = table(spark, d, "customer")
    rows = c.select("c_custkey", F.concat("c_name", F.lit(', "x"\ny')).alias("c_name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("").alias("segment"))
    path = _folder(spark, "csv")
    rows.write.options(header=True, escape='"', emptyValue="").csv(path)
    return files.csv_rows(spark, path)


@query("SELECT '{\"@id\":\"' || n_nationkey || '\",\"name\":\"' || n_name || ' & co\",\"region\":\"' || n_regionkey || '\"}' AS record FROM nation")
def read_xml(spark, d):
    """Elements with an attribute, a name space and escaped text."""
    n = table(spark, d, "nation")
    item = F.concat(F.lit('<nation id="'), F.col("n_nationkey").cast("string"), F.lit('"><x:name>'), "n_name", F.lit(" &amp; co</x:name><region>"), F.col("n_regionkey").cast("string"), F.lit("</region></nation>"))
    path = _folder(spark, "xml")
    page = n.agg(F.array_join(F.collect_list(item), "\n").alias("items"))  # 25 nations in one document
    page.select(F.concat(F.lit('<all xmlns:x="urn:x">'), "items", F.lit("</all>")).alias("value")).write.text(path)
    return files.as_records(files.xml_rows(spark, path, "nation"))
