"""Queries of scans and paging."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import jmespath
from ..functions import records as R
from ..operators import runs
from ..sources import pages, paging, staging
from .registry import query, table
from .state import INPUT, current


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate > timestamp '1997-01-01 00:00:00'")
def incremental_scan(spark, d):
    return table(spark, d, "orders").where("o_orderdate > timestamp_ntz '1997-01-01 00:00:00'").select("o_orderkey", "o_orderstatus")


@query("SELECT event_id, event_type FROM events WHERE ts > timestamp '2024-01-05 00:00:00' AND ts <= least(timestamp '2024-01-05 00:00:00' + interval 3 day, timestamp '2024-02-01 00:00:00')")
def cursor_window(spark, d):
    return paging.cursor_window(table(spark, d, "events"), "ts", "2024-01-05 00:00:00", "3 days", "2024-02-01 00:00:00").select("event_id", "event_type")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def page_offset(spark, d):
    return paging.offset_page(table(spark, d, "orders"), ["o_orderkey"], 100, 50).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 40 OFFSET 80")
def page_number(spark, d):
    return paging.numbered_page(table(spark, d, "orders"), ["o_orderkey"], 3, 40).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 200 ORDER BY o_orderkey LIMIT 30")
def page_keyset(spark, d):
    return paging.keyset_page(table(spark, d, "orders"), "o_orderkey", 200, 30).select("o_orderkey", "o_custkey")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def property_select(spark, d):
    return paging.properties(table(spark, d, "customer"), "c_custkey,c_name,c_mktsegment")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE json_extract(props, '$.k') IS NOT NULL")
def record_selector(spark, d):
    """The records of a response page (here a one-field object, so the scalar becomes a list of one)."""
    pages = table(spark, d, "events").select("event_id", "props")
    return pages.select("event_id", F.explode(paging.select_records(F.col("props"), "k")).alias("k"))


@query("""WITH items AS (SELECT o_custkey // 10 AS page, o_orderkey, o_orderstatus, o_totalprice, row_number() OVER (PARTITION BY o_custkey // 10 ORDER BY o_orderkey) AS nr FROM orders)
SELECT page, o_orderkey::VARCHAR || ':' || o_orderstatus AS key, o_orderstatus AS status FROM items WHERE o_totalprice > 1000 AND nr > 1""")
def record_search(spark, d):
    """Records of pages by an expression with a slice, a filter and members, and their keys by expressions over each record."""
    item = F.struct(F.col("o_orderkey").alias("id"), F.struct(F.col("o_orderstatus").alias("state"), F.col("o_totalprice").alias("total")).alias("info"))
    listed = table(spark, d, "orders").groupBy(F.expr("o_custkey div 10").alias("page")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    body = F.to_json(F.struct(F.struct("items").alias("data")))
    records = listed.select("page", F.explode(paging.select_records(body, "data.items[1:] | [?info.total > `1000`].{id: id, state: info.state}")).alias("r"))
    key = R.composite_key(jmespath.search_text(F.col("r"), "id"), jmespath.search_text(F.col("r"), "state || 'none'"))
    return records.select("page", key.alias("key"), jmespath.search_text(F.col("r"), "state").alias("status"))


@query("SELECT o_orderkey AS id, c_name, c_nationkey FROM orders JOIN customer ON c_custkey = o_custkey")
def id_list_detail(spark, d):
    stubs = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    return paging.with_details(stubs, "o_custkey", table(spark, d, "customer"), "c_custkey").select("id", "c_name", "c_nationkey")


@query("SELECT DISTINCT l_partkey AS child_id, p_name, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey")
def linked_objects(spark, d):
    """Distinct children named in the parents' list field, with their records."""
    parents = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("children"))
    ids = paging.linked_ids(parents, "children")
    return paging.with_details(ids, "child_id", table(spark, d, "part"), "p_partkey").select("child_id", "p_name", "p_brand")


@query("SELECT n_nationkey * 100 + i AS id, n_name || '-' || i AS name, strftime(timestamp '2024-01-01 00:00:00' + to_days(i::INTEGER), '%Y-%m-%d') AS created FROM nation, range(5) t(i)")
def seed_expand(spark, d):
    made = table(spark, d, "nation").select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("i"))
    return made.select(
        (F.col("n_nationkey").cast("long") * 100 + F.col("i")).alias("id"),
        F.concat_ws("-", "n_name", "i").alias("name"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")), "yyyy-MM-dd").alias("created"),
    )


@query(INPUT + """SELECT external_id, CASE WHEN external_id = '7' THEN 'fetched' ELSE data END AS data,
  CASE WHEN external_id = '7' THEN sha256('fetched') ELSE _raw_hash END AS _raw_hash, external_id <> '7' AND _deleted AS _deleted
  FROM (SELECT * EXCLUDE (here) FROM cur UNION ALL SELECT '7', '', '', false WHERE '7' NOT IN (SELECT external_id FROM cur))""")
def single_record_sync(spark, d):
    """The snapshot after record 7 was fetched alone and record 8 was not found."""
    found = table(spark, d, "customer").where("c_custkey in (7, 8)").where("c_custkey <> 8")
    fetched = found.select(F.col("c_custkey").cast("string").alias("external_id"), F.lit("fetched").alias("data"), F.sha2(F.lit("fetched"), 256).alias("_raw_hash"))
    return runs.point_sync(current(spark, d), fetched)


@query("SELECT c_custkey, c_name FROM customer")
def property_list(spark, d):
    """The same selection named by a JSON array."""
    return paging.properties(table(spark, d, "customer"), '["c_custkey", "c_name"]')


def _exported(spark, d, name, order, size):
    """A folder of pages of a table; the source that reads it is registered."""
    path = f"{staging.checkpoint_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    pages.register(spark)
    pages.export_pages(table(spark, d, name), path, order, size)
    return path


def _listing(spark, path, style, schema, **options):
    return spark.read.format("concord_pages").schema(schema).options(style=style, path=path, **options).load()


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey > 100 AND o_orderstatus = 'O'")
def page_source_scan(spark, d):
    """Orders read back from pages in parallel; the watermark and the status go into the requests, only four fields are asked for."""
    path = _exported(spark, d, "orders", ["o_orderkey"], 500)
    found = _listing(spark, path, "offset", "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double", pageSize=500, cursor="o_orderkey", filters="o_orderstatus")
    return found.where("o_orderkey > 100 and o_orderstatus = 'O'")


@query("SELECT c_custkey, c_name FROM customer")
def token_scan(spark, d):
    """Customers page after page, each named by the one before."""
    return _listing(spark, _exported(spark, d, "customer", ["c_custkey"], 100), "cursor", "c_custkey long, c_name string")


@query("SELECT p_partkey, p_name, p_size FROM part WHERE p_partkey > 50")
def link_scan(spark, d):
    path = _exported(spark, d, "part", ["p_partkey"], 150)
    return _listing(spark, path, "link", "p_partkey long, p_name string, p_size int", cursor="p_partkey").where("p_partkey > 50")


@query("SELECT s_suppkey, s_name FROM supplier")
def snapshot_scan(spark, d):
    """Suppliers of the first listing, though the folder gets all of them a second time before they are read."""
    path = _exported(spark, d, "supplier", ["s_suppkey"], 20)
    pinned = _listing(spark, path, "page", "s_suppkey long, s_name string", pageSize=20, snapshot=1)
    pages.export_pages(table(spark, d, "supplier"), path, ["s_suppkey"], 20)
    return pinned
