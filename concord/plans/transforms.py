"""Queries of record transforms and quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import records as R
from ..operators import quality, transform
from .registry import NOW, query, table

SEG = "('BUILDING', 'MACHINERY')"


def customer_payload(spark, d):
    """Customers as flat columns and as a JSON payload, built from the same text in both engines."""
    c = table(spark, d, "customer")
    text = F.concat(F.lit('{"name":"'), "c_name", F.lit('","id":'), F.col("c_custkey").cast("string"), F.lit(',"geo":{"nation":'), F.col("c_nationkey").cast("string"), F.lit('},"seg":"'), "c_mktsegment", F.lit('"}'))
    return c.withColumn("raw", text)


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def field_exclude(spark, d):
    return transform.exclude_fields(table(spark, d, "customer"), ["c_acct*", "c_mkt?egment"])


@query("""SELECT c_custkey, '{"name":"' || c_name || '","geo":{"nation":' || c_nationkey || ',"deep":{"n":1.50}},"list":[{"secret":1}]}' AS raw FROM customer""")
def field_exclude_payload(spark, d):
    """Fields of a payload go at every depth of objects, lists are not entered."""
    geo = F.concat(F.lit('{"secret":{"a":[1,{"b":2}]}, "nation":'), F.col("c_nationkey").cast("string"), F.lit(', "deep":{"c_x":"}", "n":1.50, "secret":"x"}}'))
    raw = F.concat(F.lit('{"c_acct":-1, "name":"'), "c_name", F.lit('", "geo":'), geo, F.lit(', "list":[{"secret":1}], "secret":null}'))
    return table(spark, d, "customer").select("c_custkey", transform.exclude_in_payload(raw, ["secret", "c_*"]).alias("raw"))


@query("""SELECT c_custkey::BIGINT AS id, c_name AS label, c_nationkey::BIGINT AS nation, 'none' AS phone,
  '{"seg":"' || c_mktsegment || '"}' AS rest FROM customer""")
def field_map(spark, d):
    fields = [transform.Field("id", "id", "int"), transform.Field("label", "name"), transform.Field("nation", "geo.nation", "int"), transform.Field("phone", "phone", "str", "none")]
    return transform.map_fields(customer_payload(spark, d), "raw", fields, strict=False)


@query("""SELECT c_name AS label, '{"id":' || c_custkey || ',"geo":{"nation":' || c_nationkey || '},"seg":"' || c_mktsegment || '"}' AS rest FROM customer""")
def field_map_rest(spark, d):
    """What is not mapped stays as it is: numbers, objects and texts."""
    return transform.map_fields(customer_payload(spark, d), "raw", [transform.Field("label", "name")], strict=False)


@query("SELECT c_custkey::BIGINT AS id, c_name AS label FROM customer")
def field_map_strict(spark, d):
    return transform.map_fields(customer_payload(spark, d), "raw", [transform.Field("id", "id", "int"), transform.Field("label", "name")])


@query("SELECT c_custkey, c_nationkey::VARCHAR AS nation, NULL::VARCHAR AS absent FROM customer")
def dot_path(spark, d):
    return customer_payload(spark, d).select("c_custkey", R.dot_path(F.col("raw"), "geo.nation").alias("nation"), R.dot_path(F.col("raw"), "geo.city.name").alias("absent"))


@query("""SELECT event_id, coalesce(try_cast(event_type AS BIGINT), -1) AS as_int, coalesce(try_cast(user_id::VARCHAR AS BIGINT), -1) AS user_int,
  coalesce(try_cast(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS k, event_type <> '' AS truthy FROM events""")
def cast_default(spark, d):
    e = table(spark, d, "events")
    return e.select(
        "event_id",
        R.cast_or_default(F.col("event_type"), "int", -1).alias("as_int"),
        R.cast_or_default(F.col("user_id").cast("string"), "int", -1).alias("user_int"),
        R.cast_or_default(R.dot_path(F.col("props"), "k"), "float", 0.0).alias("k"),
        R.cast_or_default(F.col("event_type"), "bool").alias("truthy"),
    )


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS from_iso, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS from_offset, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS from_rfc,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS from_seconds, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS from_millis, 'on ' || event_id AS unreadable FROM events""")
def ts_normalize(spark, d):
    """All forms name the same instant; a text without an offset is in UTC."""
    ntz = F.col("ts")
    epoch = F.unix_seconds(F.to_timestamp(F.concat(F.substring(ntz.cast("string"), 1, 19), F.lit("Z"))))
    later = F.substring((ntz + F.expr("interval 2 hours")).cast("string"), 1, 19)
    rfc = F.concat(F.date_format(ntz, "E, d MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    return table(spark, d, "events").select(
        "event_id",
        R.normalize_timestamp(F.substring(ntz.cast("string"), 1, 19), "iso8601").alias("from_iso"),
        R.normalize_timestamp(F.concat(later, F.lit("+02:00"))).alias("from_offset"),
        R.normalize_timestamp(rfc, "rfc2822").alias("from_rfc"),
        R.normalize_timestamp(epoch.cast("string")).alias("from_seconds"),
        R.normalize_timestamp((epoch * 1000).cast("string"), "unix_millis").alias("from_millis"),
        R.normalize_timestamp(F.concat(F.lit("on "), "event_id")).alias("unreadable"),
    )


@query("SELECT c_custkey, '[REDACTED]' AS c_name, c_mktsegment FROM customer")
def pii_redact(spark, d):
    return transform.redact(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), ["c_name", "phone"])


@query("SELECT o_orderkey::VARCHAR AS external_id FROM orders")
def pk_single(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("external_id"))


@query("SELECT l_orderkey, l_orderkey || ':' || l_linenumber AS external_id, CASE WHEN l_linenumber <> 1 THEN l_orderkey || ':' || l_linenumber END AS with_null FROM lineitem")
def pk_composite(spark, d):
    li = table(spark, d, "lineitem")
    line = F.when(F.col("l_linenumber") != 1, F.col("l_linenumber"))
    return li.select("l_orderkey", R.composite_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("external_id"), R.composite_key(F.col("l_orderkey"), line).alias("with_null"))


@query("SELECT c_custkey, c_nationkey || '/' || c_name AS external_id FROM customer")
def pk_expression(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.format_string("%s/%s", "c_nationkey", "c_name").alias("external_id"))


@query("""SELECT c_custkey, sha256('{"geo":{"nation":' || c_nationkey || '},"id":' || c_custkey || ',"name":"' || c_name || '","seg":"' || c_mktsegment || '"}') AS raw_hash FROM customer""")
def content_hash(spark, d):
    return customer_payload(spark, d).select("c_custkey", R.content_hash(F.col("raw")).alias("raw_hash"))


@query("""SELECT o_orderkey, sha256('{"cust":' || o_custkey || ',"status":"' || o_orderstatus || '"}') AS row_hash FROM orders""")
def row_hash(spark, d):
    return table(spark, d, "orders").select("o_orderkey", R.row_hash({"status": F.col("o_orderstatus"), "cust": F.col("o_custkey"), "_action": F.lit("update")}).alias("row_hash"))


@query("SELECT o_orderkey, sha256('erp:orders:' || o_orderkey || ':' || sha256(o_orderstatus)) AS idempotency_key FROM orders")
def idempotency_key(spark, d):
    return table(spark, d, "orders").select("o_orderkey", R.idempotency_key("erp", "orders", F.col("o_orderkey"), F.sha2("o_orderstatus", 256)).alias("idempotency_key"))


@query("""SELECT o_orderkey, '{"run":"run-1","at":"2024-02-01 00:00:00","path":"/orders","watermark":null,"page":' || (o_orderkey // 100) || '}' AS _lineage FROM orders""")
def lineage_stamp(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return transform.stamp_lineage(o, "run-1", NOW, "/orders", None, F.floor(F.col("o_orderkey") / 100).cast("long"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '{}' ELSE o_orderstatus END AS data FROM orders")
def payload_extract(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("data"))
    return transform.payload_of(o)


@query("""SELECT c_custkey, '{"n":' || c_custkey || ',"o":{"x":true},"ref":"c' || c_nationkey || '"}' AS payload FROM customer""")
def external_ref(spark, d):
    payload = F.concat(F.lit('{"ref":"old","n":'), F.col("c_custkey").cast("string"), F.lit(',"o":{"x":true}}'))
    made = transform.add_reference(payload, "ref", F.concat(F.lit("c"), F.col("c_nationkey")))
    return table(spark, d, "customer").select("c_custkey", made.alias("payload"))


@query("SELECT c_custkey, c_name AS dashed, c_nationkey::VARCHAR AS spaced FROM customer")
def dot_path_names(spark, d):
    """Names with dashes, blanks and dollars, and indexes."""
    payload = F.concat(F.lit('{"first-name":[{"$v":"'), "c_name", F.lit('"}],"a b":{"c d":'), F.col("c_nationkey").cast("string"), F.lit("}}"))
    return table(spark, d, "customer").select("c_custkey", R.dot_path(payload, "first-name[0].$v").alias("dashed"), R.dot_path(payload, "a b.c d").alias("spaced"))


@query("""SELECT p_partkey, CASE WHEN levenshtein(p_type, p_brand) < 3 THEN 'auto_link' WHEN levenshtein(p_type, p_brand) > 9 THEN 'queue_for_review' ELSE 'undecided' END AS names,
  CASE WHEN p_partkey % 3 = 0 THEN 'auto_link' WHEN p_partkey % 3 = 1 THEN 'undecided' END AS shifted FROM part""")
def name_rule(spark, d):
    tail = F.when(F.col("p_partkey") % 3 == 0, "xy").when(F.col("p_partkey") % 3 == 1, "wxyz")
    return table(spark, d, "part").select("p_partkey", R.name_rule(F.col("p_type"), F.col("p_brand"), 3, 9).alias("names"), R.name_rule(F.col("p_name"), F.concat("p_name", tail)).alias("shifted"))


@query("SELECT c_name AS display, c_mktsegment AS segment FROM customer")
def wb_field_map(spark, d):
    return transform.map_fields(customer_payload(spark, d), "raw", [transform.Field("display", "name"), transform.Field("segment", "seg")])


@query("SELECT c_custkey AS id, c_name AS name FROM customer")
def response_rename(spark, d):
    return transform.rename_fields(table(spark, d, "customer").select("c_custkey", "c_name"), {"c_custkey": "id", "c_name": "name"})


@query("SELECT o_orderkey, '/orders/' || o_orderkey || '/lines' AS path FROM orders")
def path_interpolate(spark, d):
    return table(spark, d, "orders").select("o_orderkey", transform.interpolate("/orders/${external_id}/lines", external_id=F.col("o_orderkey")).alias("path"))


@query("SELECT c_custkey, c_name FROM customer")
def meta_strip(spark, d):
    return transform.strip_meta(table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_name").alias("__seen")))


@query("SELECT n_nationkey AS attempt, least(2.0 * pow(2.0, n_nationkey), 3600.0)::DOUBLE AS delay FROM nation")
def backoff_curve(spark, d):
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("attempt"), R.back_off(F.col("n_nationkey"), 2.0, 2.0, 3600.0).alias("delay"))


# quality rules

QUALITY = """WITH e AS (SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN event_type END AS kind, user_id, value FROM events)"""


def dented_events(spark, d):
    """Events of which some have no type."""
    e = table(spark, d, "events")
    return e.select("event_id", F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("kind"), "user_id", "value")


def failing(spark, d, rule):
    return dented_events(spark, d).select("event_id", rule.alias("reason")).where("reason is not null")


@query(QUALITY + "SELECT event_id, 'required:kind' AS reason FROM e WHERE kind IS NULL OR kind = ''")
def q_required(spark, d):
    return failing(spark, d, quality.required("kind"))


@query(QUALITY + "SELECT event_id, 'unique:user_id' AS reason FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM e) WHERE n > 1")
def q_unique(spark, d):
    return quality.mark_repeats(dented_events(spark, d).select("event_id", "user_id"), "user_id", "event_id", "reason").where("reason is not null").select("event_id", "reason")


@query(QUALITY + "SELECT event_id, 'regex:kind' AS reason FROM e WHERE NOT regexp_full_match(kind, '[a-l].*')")
def q_regex(spark, d):
    return failing(spark, d, quality.pattern("kind", "[a-l].*"))


@query(QUALITY + "SELECT event_id, 'min_length:kind' AS reason FROM e WHERE length(kind) < 6")
def q_min_length(spark, d):
    return failing(spark, d, quality.min_length("kind", 6))


@query(QUALITY + "SELECT event_id, 'max_length:kind' AS reason FROM e WHERE length(kind) > 5")
def q_max_length(spark, d):
    return failing(spark, d, quality.max_length("kind", 5))


@query(QUALITY + "SELECT event_id, 'allowed_values:kind' AS reason FROM e WHERE kind NOT IN ('click', 'view')")
def q_allowed(spark, d):
    return failing(spark, d, quality.allowed_values("kind", ["click", "view"]))


RULES = [quality.required, quality.min_length]
CHECKED = (
    QUALITY
    + """, r AS (SELECT event_id, kind,
  CASE WHEN kind IS NULL OR kind = '' THEN 'required:kind' END AS a,
  CASE WHEN length(kind) < 6 THEN 'min_length:kind' END AS b,
  CASE WHEN kind NOT IN ('click', 'view') THEN 'allowed_values:kind' END AS c FROM e)"""
)


def checked_events(spark, d):
    rules = [quality.required("kind"), quality.min_length("kind", 6), quality.allowed_values("kind", ["click", "view"])]
    return quality.check(dented_events(spark, d), rules)


@query(CHECKED + "SELECT event_id, concat_ws(';', a, b, c) AS violations FROM r WHERE coalesce(a, b, c) IS NOT NULL")
def q_violations(spark, d):
    _, bad = quality.split(checked_events(spark, d))
    return bad.select("event_id", F.array_join("violations", ";").alias("violations"))


@query(CHECKED + "SELECT v AS rule, count(*) AS n FROM (SELECT a AS v FROM r UNION ALL SELECT b FROM r UNION ALL SELECT c FROM r) WHERE v IS NOT NULL GROUP BY v")
def violations_by_rule(spark, d):
    return checked_events(spark, d).select(F.explode("violations").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


@query("SELECT event_id, 'missing primary key' AS error_message, 'data_error' AS error_class FROM events WHERE event_id % 13 = 0")
def missing_pk(spark, d):
    e = table(spark, d, "events").withColumn("key", F.when(F.col("event_id") % 13 != 0, F.col("event_id")))
    return e.where("key is null").select("event_id", F.lit("missing primary key").alias("error_message"), F.lit("data_error").alias("error_class"))


@query(CHECKED + """SELECT event_id::VARCHAR AS external_id, coalesce(kind, '') AS raw, concat_ws('; ', a, b, c) AS error_message, 'data_error' AS error_class,
  '2024-02-01 00:00:00' AS failed_at, 'run-1' AS sync_run_id, 0 AS requeue_count FROM r WHERE coalesce(a, b, c) IS NOT NULL""")
def dead_letter_rows(spark, d):
    _, bad = quality.split(checked_events(spark, d))
    return quality.dead_letters(bad, "event_id", F.coalesce("kind", F.lit("")), "run-1", NOW)


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'required:name' ELSE '' END AS missing FROM customer")
def required_fields(spark, d):
    payload = F.when(F.col("c_custkey") % 4 == 0, F.lit('{"x":1}')).otherwise(F.concat(F.lit('{"name":"'), "c_name", F.lit('"}')))
    return table(spark, d, "customer").select("c_custkey", F.array_join(quality.payload_errors({}, ["name"], True, payload), ",").alias("missing"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'required:name' WHEN 1 THEN 'type:id' WHEN 2 THEN 'additional:zip' ELSE '' END AS errors FROM customer""")
def payload_schema(spark, d):
    ident = F.col("c_custkey").cast("string")
    payload = (
        F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit('{"id":'), ident, F.lit("}")))
        .when(F.col("c_custkey") % 4 == 1, F.concat(F.lit('{"id":"'), ident, F.lit('","name":"a"}')))
        .when(F.col("c_custkey") % 4 == 2, F.concat(F.lit('{"id":'), ident, F.lit(',"name":"a","zip":1}')))
        .otherwise(F.concat(F.lit('{"id":true,"name":"a"}')))
    )
    errors = quality.payload_errors({"id": "integer", "name": "string"}, ["id", "name"], False, payload)
    return table(spark, d, "customer").select("c_custkey", F.array_join(errors, ",").alias("errors"))
