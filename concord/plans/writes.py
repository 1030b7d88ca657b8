"""Queries of the write planner."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hooks, merge, writeback
from .registry import NOW, query, table

# Orders as desired state; last-written and remote differ from it by arithmetic on the key.
DELTA = """WITH delta AS (
  SELECT o_orderkey AS external_id, 'c' || o_custkey AS cluster_id, o_orderstatus AS status, o_orderpriority AS priority,
         CASE o_orderkey % 6 WHEN 0 THEN 'noop' WHEN 1 THEN 'insert' WHEN 2 THEN 'update' WHEN 3 THEN 'delete' WHEN 4 THEN 'upsert' ELSE 'archive' END AS _action,
         CASE WHEN o_orderkey % 10 = 0 THEN 'processed' ELSE 'pending' END AS _status FROM orders)
"""
WAY = """WITH w AS (
  SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS priority,
    CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE o_orderstatus END AS lw_status, o_orderpriority AS lw_priority,
    CASE WHEN o_orderkey % 4 = 0 THEN 'y' WHEN o_orderkey % 3 = 0 THEN 'x' ELSE o_orderstatus END AS r_status,
    CASE WHEN o_orderkey % 5 = 0 THEN 'z' ELSE o_orderpriority END AS r_priority,
    CASE WHEN o_orderkey % 8 = 0 THEN 'y' ELSE o_orderstatus END AS b_status FROM orders
), s AS (SELECT *, (r_status = b_status AND r_priority = priority) OR (r_status = lw_status AND r_priority = lw_priority) AS safe FROM w)
"""


def delta(spark, d):
    o = table(spark, d, "orders")
    names = ["noop", "insert", "update", "delete", "upsert", "archive"]
    return o.select(
        F.col("o_orderkey").alias("external_id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("cluster_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("o_orderkey") % 6).cast("int") + 1).alias("_action"),
        F.when(F.col("o_orderkey") % 10 == 0, "processed").otherwise("pending").alias("_status"),
    )


def sides(spark, d):
    """Desired payload, last-written, remote and base as maps, put together by joins on the key."""
    o = table(spark, d, "orders")
    k, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    both = lambda s, p: F.create_map(F.lit("status"), s, F.lit("priority"), p)
    lw = F.when(k % 3 == 0, "x").otherwise(status)
    desired = o.select(k.alias("id"), both(status, priority).alias("payload"), both(F.when(k % 8 == 0, "y").otherwise(status), priority).alias("base"))
    written = o.select(k.alias("id"), both(lw, priority).alias("last_written"))
    remote = o.select(k.alias("id"), both(F.when(k % 4 == 0, "y").otherwise(lw), F.when(k % 5 == 0, "z").otherwise(priority)).alias("remote"))
    return desired.join(written, "id", "left").join(remote, "id", "left")


@query(DELTA + "SELECT external_id, cluster_id, _action FROM delta WHERE _action <> 'noop' AND _status = 'pending'")
def delta_fetch(spark, d):
    return writeback.pending(delta(spark, d), ["external_id"]).select("external_id", "cluster_id", "_action")


@query(DELTA + """, r AS (SELECT external_id, cluster_id, sum(length(priority)) OVER w AS running_bytes, row_number() OVER w AS n FROM delta
  WINDOW w AS (PARTITION BY cluster_id ORDER BY external_id ROWS UNBOUNDED PRECEDING))
SELECT external_id, cluster_id, running_bytes::BIGINT AS running_bytes FROM r WHERE running_bytes <= 40 OR n = 1""")
def batch_bytes(spark, d):
    rows = writeback.byte_budget(delta(spark, d), F.octet_length("priority"), "external_id", 40, ["cluster_id"])
    return rows.select("external_id", "cluster_id", "running_bytes")


@query(DELTA + """, bounds AS (SELECT unnest([20, (SELECT count(*) FROM delta WHERE _action = 'delete')]) AS most)
SELECT most, external_id, _action FROM delta, bounds WHERE _action <> 'delete' OR (SELECT count(*) FROM delta WHERE _action = 'delete') <= most""")
def delete_guard(spark, d):
    """A bound that the deletes exceed, and one that they just reach."""
    rows = delta(spark, d)
    n = rows.where("_action = 'delete'").count()
    kept = [writeback.guard_deletes(rows, most).select(F.lit(most).cast("long").alias("most"), "external_id", "_action") for most in (20, n)]
    return kept[0].unionByName(kept[1])


@query(DELTA + "SELECT external_id, _action FROM delta WHERE NOT (external_id % 4 = 0)")
def audit_dedup(spark, d):
    rows = delta(spark, d)
    minutes = F.when(F.col("external_id") % 4 == 0, 30).otherwise(90)
    now = F.lit(NOW).cast("timestamp")
    audit = rows.select("external_id", "_action", F.when(F.col("external_id") % 2 == 0, "ok").otherwise("error").alias("status"), (now - F.make_dt_interval(mins=minutes)).alias("processed_at"))
    return writeback.without_done(rows, audit, now).select("external_id", "_action")


@query(DELTA + "SELECT external_id FROM delta WHERE _action = 'archive' AND external_id % 7 <> 0")
def archive_guard(spark, d):
    rows = delta(spark, d)
    return writeback.archivable(rows, rows.where("external_id % 7 = 0")).select("external_id")


@query("SELECT o_orderkey FROM orders WHERE coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END, timestamp '1996-01-01') < timestamp '2024-02-01 00:00:00' - interval 9500 day")
def stale_rows(spark, d):
    at = F.coalesce(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate")), F.expr("timestamp_ntz '1996-01-01'"))
    return table(spark, d, "orders").where(at < F.expr(f"timestamp_ntz '{NOW}' - interval 9500 days")).select("o_orderkey")


@query("SELECT o_custkey AS external_id, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS rows FROM orders GROUP BY 1")
def group_by_id(spark, d):
    rows = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("external_id")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("keys"))
    return rows.select("external_id", F.array_join(F.transform("keys", lambda k: k.cast("string")), ",").alias("rows"))


# Orders in 23 groups, each numbered from 0; a row follows rows a half and a third as far. Group 7 has a cycle, group 9 rows have none.
ORDERED = """WITH RECURSIVE r AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 23 <> 9 THEN o_orderkey % 23 END AS g, o_orderkey // 23 AS i FROM orders),
p AS (SELECT id, g, (i // 3) * 23 + g AS parent FROM r UNION SELECT id, g, CASE WHEN g = 7 AND i = 0 THEN 2 * 23 + 7 ELSE (i // 2) * 23 + g END FROM r),
e AS (SELECT id, g, parent FROM p WHERE g IS NOT NULL AND parent <> id AND parent IN (SELECT id FROM r)),
t AS (SELECT id, 0 AS level FROM r WHERE g IS NOT NULL AND g <> 7 AND id NOT IN (SELECT id FROM e) UNION SELECT e.id, t.level + 1 FROM e JOIN t ON e.parent = t.id)
SELECT r.id, g, max(level)::INTEGER AS write_level, coalesce(g = 7, false) AS cycle FROM r LEFT JOIN t USING (id) GROUP BY ALL"""


@query(ORDERED)
def row_dependencies(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    g = F.when(F.col("id") % 23 != 9, F.col("id") % 23)
    rows = o.withColumn("g", g).withColumn("i", F.expr("id div 23"))
    second = F.when((F.col("g") == 7) & (F.col("i") == 0), F.lit(53)).otherwise(F.expr("(i div 2) * 23 + g"))
    rows = rows.withColumns({"first": F.expr("(i div 3) * 23 + g"), "second": second})
    return writeback.write_order(rows, "id", "g", ["first", "second"]).select("id", "g", "write_level", "cycle")


@query(WAY + "SELECT id, safe FROM s")
def three_way(spark, d):
    return writeback.three_way(sides(spark, d)).select("id", "safe")


RESOLUTIONS = ["last_writer_wins", "skip_and_warn", "dead_letter", "server_wins", "re_ingest_and_recompute", "merge_fields"]


@query(WAY + """SELECT id, resolution, CASE WHEN safe OR resolution IN ('last_writer_wins', 'merge_fields') THEN 'write' WHEN resolution = 'dead_letter' THEN 'fail'
  WHEN resolution = 're_ingest_and_recompute' THEN 'resync' ELSE 'skip' END AS step, NOT safe AS conflict
  FROM s, (VALUES ('last_writer_wins'), ('skip_and_warn'), ('dead_letter'), ('server_wins'), ('re_ingest_and_recompute'), ('merge_fields')) r(resolution)""")
def conflict_resolution(spark, d):
    checked = writeback.three_way(sides(spark, d)).withColumn("resolution", F.explode(F.array(*[F.lit(r) for r in RESOLUTIONS])))
    return writeback.resolve(checked, F.col("resolution")).select("id", "resolution", "step", "conflict")


@query(WAY + "SELECT id, r_status <> lw_status OR r_priority <> lw_priority AS skipped FROM s")
def server_wins(spark, d):
    differs = F.size(writeback.conflicting_fields(F.col("payload"), F.col("last_written"), F.col("remote"))) > 0
    return sides(spark, d).select("id", differs.alias("skipped"))


@query(WAY + """SELECT id, CASE WHEN r_status <> lw_status OR r_priority <> lw_priority THEN 'priority,status' ELSE '' END AS conflicted,
  CASE WHEN r_status <> lw_status OR r_priority <> lw_priority THEN r_status ELSE status END AS status,
  CASE WHEN r_status <> lw_status OR r_priority <> lw_priority THEN r_priority ELSE priority END AS priority FROM s""")
def merge_fields(spark, d):
    rows = writeback.merge_fields(sides(spark, d), [["status", "priority"]])
    return rows.select("id", F.array_join("conflicted", ",").alias("conflicted"), F.col("merged.status").alias("status"), F.col("merged.priority").alias("priority"))


@query(WAY + """SELECT id, concat_ws(',', CASE WHEN priority <> r_priority THEN 'priority' END, CASE WHEN status <> r_status THEN 'status' END) AS changed
  FROM s WHERE priority <> r_priority OR status <> r_status""")
def diff_fields(spark, d):
    rows = sides(spark, d).withColumn("diff", writeback.changed_fields(F.col("payload"), F.col("remote")))
    return rows.where(F.size("diff") > 0).select("id", F.array_join(F.array_sort(F.map_keys("diff")), ",").alias("changed"))


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'note' ELSE '' END AS added, CASE WHEN o_orderkey % 3 = 0 THEN 'old' ELSE '' END AS removed,
  CASE WHEN o_orderkey % 5 = 0 THEN 'status' ELSE '' END AS changed FROM orders""")
def field_diff(spark, d):
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    one = F.create_map(F.lit("status"), status)
    none = F.create_map().cast("map<string,string>")
    old = F.map_concat(one, F.when(k % 3 == 0, F.create_map(F.lit("old"), status)).otherwise(none))
    new = F.map_concat(F.create_map(F.lit("status"), F.when(k % 5 == 0, "changed").otherwise(status)), F.when(k % 2 == 0, F.create_map(F.lit("note"), status)).otherwise(none))
    rows = table(spark, d, "orders").select(k.alias("id"), old.alias("old"), new.alias("new"))
    return rows.select("id", *[F.array_join(c, ",").alias(n) for n, c in writeback.field_diff(F.col("old"), F.col("new")).items()])


@query(WAY + """SELECT id, concat_ws(',', CASE WHEN priority <> r_priority THEN 'priority' END, CASE WHEN status <> r_status THEN 'status' END) AS mismatched
  FROM s WHERE priority <> r_priority OR status <> r_status""")
def post_verify(spark, d):
    rows = sides(spark, d).withColumn("m", writeback.mismatches(F.col("payload"), F.col("remote")))
    return rows.where(F.size("m") > 0).select("id", F.array_join("m", ",").alias("mismatched"))


@query("""SELECT o_orderkey AS external_id, o_orderkey % 9 = 0 OR o_orderkey % 5 <> 0 AS success, CASE WHEN o_orderkey % 9 <> 0 AND o_orderkey % 5 = 0 THEN 'rejected' END AS error FROM orders""")
def batch_response(spark, d):
    """Responses by id over a batch; a row without a response succeeded."""
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("external_id"))
    batches = rows.where("external_id % 9 <> 0").groupBy(F.expr("external_id div 50").alias("batch"))
    answers = batches.agg(F.collect_list(F.struct(F.col("external_id").alias("id"), (F.col("external_id") % 5 != 0).alias("ok"))).alias("items"))
    each = answers.select(F.explode("items").alias("i")).select(F.col("i.id").alias("external_id"), "i.ok")
    return writeback.answered(rows, each)


@query(DELTA + "SELECT external_id, CASE WHEN external_id % 12 = 4 THEN 'PATCH' ELSE 'POST' END AS method FROM delta WHERE _action = 'upsert'")
def upsert_route(spark, d):
    rows = delta(spark, d)
    return writeback.upsert_methods(rows, rows.where("external_id % 12 = 4"))


OPERATIONS = {"insert": ("POST", "/orders"), "update": ("PATCH", "/orders/${external_id}"), "delete": ("DELETE", "/orders/${external_id}"), "upsert": ("PUT", "/orders/${external_id}")}
PLAN = DELTA + """, plan AS (SELECT external_id, _action,
  CASE _action WHEN 'insert' THEN 'POST' WHEN 'update' THEN 'PATCH' WHEN 'delete' THEN 'DELETE' WHEN 'upsert' THEN 'PUT' END AS method,
  CASE WHEN _action = 'insert' THEN '/orders' WHEN _action IN ('update', 'delete', 'upsert') THEN '/orders/' || external_id END AS path,
  CASE WHEN _action IN ('insert', 'update', 'delete', 'upsert') THEN 'write' ELSE 'skip' END AS step FROM delta)
"""


def planned(spark, d):
    return writeback.plan(delta(spark, d), OPERATIONS, "external_id").select("external_id", "_action", "method", "path", "step")


@query(PLAN + "SELECT * FROM plan")
def writeback_plan(spark, d):
    return planned(spark, d)


@query(PLAN + "SELECT external_id, method, path, 'shadow' AS mode FROM plan WHERE step = 'write'")
def shadow_log(spark, d):
    return planned(spark, d).where("step = 'write'").select("external_id", "method", "path", F.lit("shadow").alias("mode"))


@query(PLAN + "SELECT external_id, _action, CASE step WHEN 'write' THEN 'ok' ELSE 'skipped' END AS status, 'run-1' AS run_id FROM plan WHERE external_id % 4 <> 0")
def audit_rows(spark, d):
    rows = planned(spark, d).select("external_id", "_action", F.when(F.col("step") == "write", "ok").otherwise("skipped").alias("status"), F.lit("run-1").alias("run_id"))
    again = rows.union(rows.where("external_id % 10 = 1"))
    return writeback.audited(again, rows.where("external_id % 4 = 0")).select("external_id", "_action", "status", "run_id")


@query("SELECT l_orderkey AS external_id, count(*) AS failures FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 HAVING count(*) >= 3")
def auto_dead_letter(spark, d):
    returned = table(spark, d, "lineitem").where("l_returnflag = 'R'")
    return writeback.failing(returned.withColumnRenamed("l_orderkey", "external_id"), "external_id")


@query("""SELECT coalesce(n.o_orderkey, o.o_orderkey) AS external_id, CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_orderpriority ELSE o.o_orderstatus END AS data
  FROM (SELECT * FROM orders WHERE o_orderstatus <> 'O' OR o_totalprice < 200000) o FULL OUTER JOIN (SELECT * FROM orders WHERE o_orderstatus = 'O') n ON o.o_orderkey = n.o_orderkey""")
def desired_upsert(spark, d):
    o = table(spark, d, "orders")
    old = o.where("o_orderstatus <> 'O' or o_totalprice < 200000").select(F.col("o_orderkey").alias("external_id"), F.col("o_orderstatus").alias("data"))
    new = o.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("external_id"), F.col("o_orderpriority").alias("data"))
    return merge.keyed_merge(old, new, ["external_id"])


@query("SELECT o_orderkey AS external_id, CASE WHEN o_orderkey % 2 = 0 THEN 'processed' WHEN o_orderkey % 3 = 0 THEN 'failed' ELSE 'skipped' END AS _status FROM orders")
def desired_status(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("external_id"))
    return writeback.statuses(rows, rows.where("external_id % 2 = 0"), rows.where("external_id % 3 = 0"))


@query("""SELECT coalesce(n.o_orderkey, o.o_orderkey) AS external_id, coalesce(CASE WHEN n.o_orderkey % 4 = 0 THEN 'n' || n.o_custkey END, 'o' || o.o_custkey) AS cluster_id,
  CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_orderpriority ELSE o.o_orderstatus END AS _written
  FROM (SELECT * FROM orders WHERE o_orderstatus <> 'O' OR o_totalprice < 200000) o FULL OUTER JOIN (SELECT * FROM orders WHERE o_orderstatus = 'O') n ON o.o_orderkey = n.o_orderkey""")
def lwstate_merge(spark, d):
    o = table(spark, d, "orders")
    old = o.where("o_orderstatus <> 'O' or o_totalprice < 200000").select(F.col("o_orderkey").alias("external_id"), F.concat(F.lit("o"), F.col("o_custkey").cast("string")).alias("cluster_id"), F.col("o_orderstatus").alias("_written"))
    new = o.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("external_id"), F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("n"), F.col("o_custkey").cast("string"))).alias("cluster_id"), F.col("o_orderpriority").alias("_written"))
    return merge.keyed_merge(old, new, ["external_id"], keep_old_if_null=["cluster_id"])


@query("SELECT o_orderkey AS external_id, 'c' || o_custkey AS cluster_id, CASE WHEN o_orderkey % 6 <> 5 THEN o_orderkey::VARCHAR END AS target_external_id FROM orders")
def identity_map_extract(spark, d):
    """The target's id from the first of five response fields that has one; some responses have none, some two."""
    k = F.col("o_orderkey").cast("string")
    names = ["id", "order_id", "crm_id", "externalId", "external_id"]
    texts = [F.concat(F.lit('{"note":1,"id":null,"' + n + '":'), k, F.lit(',"external_id":"other"}' if n != "external_id" else "}")) for n in names]
    response = F.element_at(F.array(*texts, F.lit('{"status":"ok"}')), (F.col("o_orderkey") % 6).cast("int") + 1)
    rows = table(spark, d, "orders").withColumn("r", F.regexp_replace(response, '"id":null,"id"', '"id"'))
    return rows.select(F.col("o_orderkey").alias("external_id"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("cluster_id"), writeback.assigned_id(F.col("r"), "crm", "order").alias("target_external_id"))


@query("SELECT o_orderkey, upper(o_orderpriority) AS priority, length(o_orderpriority) AS size FROM orders WHERE o_orderstatus <> 'P'")
def hook_filter(spark, d):
    rules = hooks.Hooks(
        transform=lambda df: df.withColumn("priority", F.upper("o_orderpriority")),
        keep=lambda df: F.when(F.col("o_orderstatus") != "P", True),
        enrich=lambda df: df.withColumn("size", F.length("priority").cast("long")),
    )
    return hooks.apply_hooks(table(spark, d, "orders"), rules).select("o_orderkey", "priority", "size")


@query(WAY + """, b AS (SELECT *, CASE WHEN id % 4 = 0 AND id % 8 <> 0 THEN b_status || 'c' WHEN id % 4 = 1 OR id % 8 = 0 THEN b_status WHEN id % 4 = 2 THEN b_status || 'u' END AS base_status FROM w)
SELECT id, base_status, coalesce(r_status = base_status AND r_priority = priority, false) OR (r_status = lw_status AND r_priority = lw_priority) AS safe FROM b""")
def three_way_base(spark, d):
    """The check with bases that stand in a column, in the data, in another column, or nowhere; an empty one counts as absent."""
    rows, k = sides(spark, d), F.col("id")
    text = lambda mark: F.to_json(F.create_map(F.lit("status"), F.concat(F.col("base.status"), F.lit(mark)), F.lit("priority"), F.col("base.priority")))
    base = F.when(k % 8 == 0, "{}").when(k % 4 == 0, text("c"))
    data = F.concat(F.lit('{"status":1,"_base":'), F.when((k % 4 == 1) | (k % 8 == 0), text("")).otherwise("[]"), F.lit("}"))
    found = rows.withColumn("base", writeback.base_lookup(base, data, F.when(k % 4 != 3, text("u"))))
    return writeback.three_way(found).select("id", F.col("base.status").alias("base_status"), "safe")


ASKED = PLAN + """, asked AS (SELECT p.external_id, p._action, p.method, p.step, CASE WHEN p.step = 'write' THEN 'https://host/v1' || p.path END AS url,
  CASE WHEN p._action = 'update' AND p.external_id % 3 <> 0 THEN 'W/"' || p.external_id || '"' END AS if_match,
  CASE WHEN p.step = 'write' AND p._action <> 'delete' THEN '{"status":"' || d.status || '"}' END AS body FROM plan p JOIN delta d USING (external_id))
"""


def asked(spark, d):
    k = F.col("external_id")
    rows = delta(spark, d).withColumn("payload", F.concat(F.lit('{"status":"'), "status", F.lit('"}'))).withColumn("etag", F.when(k % 3 != 0, F.concat(F.lit('W/"'), k.cast("string"), F.lit('"'))))
    return writeback.requests(writeback.plan(rows.withColumn("key", F.concat(F.lit("k"), k.cast("string"))), OPERATIONS, "external_id"), "https://host/v1/", "payload", "etag", "key")


@query(ASKED + """SELECT external_id, method, url, if_match, body, CASE WHEN step = 'write' THEN '{"Idempotency-Key":"k' || external_id || '"' ||
  CASE WHEN if_match IS NOT NULL THEN ',"If-Match":"W/\\"' || external_id || '\\""' ELSE '' END || '}' END AS headers FROM asked""")
def writeback_requests(spark, d):
    """Requests with conditional headers, idempotency keys and bodies."""
    return asked(spark, d).select("external_id", "method", "url", "if_match", "body", "headers")


@query(ASKED + "SELECT external_id, _action AS action, method, url, body, false AS conflict_detected FROM asked WHERE step = 'write'")
def writeback_dry_run(spark, d):
    return writeback.dry_run(asked(spark, d)).drop("headers")


@query(ASKED + """SELECT external_id, CASE WHEN step <> 'write' OR external_id % 7 = 1 THEN 'skipped' WHEN external_id % 7 IN (2, 3) THEN 'failed' ELSE 'ok' END AS outcome,
  step = 'write' AND external_id % 7 = 1 AS conflict FROM asked""")
def writeback_outcomes(spark, d):
    """412 is a conflict and a skip, 500 and no answer are failures."""
    rows = asked(spark, d)
    k = F.col("external_id") % 7
    responses = rows.where(k != 3).select("external_id", F.when(k == 1, 412).when(k == 2, 500).when(k == 4, 204).otherwise(200).alias("status"))
    return writeback.outcomes(rows, responses).select("external_id", "outcome", "conflict")


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'note' ELSE '' END AS added, CASE WHEN o_orderkey % 3 = 0 THEN 'old' ELSE '' END AS removed,
  CASE WHEN o_orderkey % 5 = 0 THEN '{"status":{"from":"' || o_orderstatus || '","to":"changed"}}' ELSE '{}' END AS changed FROM orders""")
def field_diff_values(spark, d):
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    none = F.create_map().cast("map<string,string>")
    old = F.map_concat(F.create_map(F.lit("status"), status), F.when(k % 3 == 0, F.create_map(F.lit("old"), status)).otherwise(none))
    new = F.map_concat(F.create_map(F.lit("status"), F.when(k % 5 == 0, "changed").otherwise(status)), F.when(k % 2 == 0, F.create_map(F.lit("note"), status)).otherwise(none))
    rows = table(spark, d, "orders").select(k.alias("id"), old.alias("old"), new.alias("new"))
    diff = rows.select("id", writeback.field_diff_values(F.col("old"), F.col("new")).alias("d"))
    return diff.select("id", F.array_join("d.added", ",").alias("added"), F.array_join("d.removed", ",").alias("removed"), F.to_json("d.changed").alias("changed"))


@query("""WITH r AS (SELECT *, CASE o_orderkey % 5 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate + interval 1 day WHEN 2 THEN o_orderdate + interval 2 day WHEN 3 THEN o_orderdate + interval 3 day END AS t FROM orders),
b AS (SELECT o_custkey AS batch, count(*) AS n, arg_min({'t': t}, o_orderkey).t AS t FROM r GROUP BY 1)
SELECT batch, n AS rows_in_batch, epoch(timestamp '2024-02-01 00:00:00' - t)::DOUBLE AS oldest_age_secs, coalesce(epoch(timestamp '2024-02-01 00:00:00' - t) > 820000000, false) AS stale FROM b""")
def stale_batches(spark, d):
    """The age of each customer's first order by the first of four times that it has."""
    k, at = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    times = {c: F.when(k % 5 == i, at + F.make_dt_interval(days=F.lit(i))) for i, c in enumerate(writeback.QUEUED)}
    rows = table(spark, d, "orders").withColumns(times).withColumnRenamed("o_custkey", "batch")
    return writeback.stale_batches(rows, ["batch"], "o_orderkey", F.lit(NOW).cast("timestamp"), 820_000_000)
