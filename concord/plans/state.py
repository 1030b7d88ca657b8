"""Queries of merges, tombstones, watermarks and guards."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import merge, runs
from ..sources import snapshots, staging
from .registry import query, table

# The same inputs for both engines: customers as they come in (those in debt do not), and a snapshot that lacks some of them, differs
# in others and has tombstones. Every customer is on one side at least. Some payloads have no hash on either side.
INPUT = """WITH incoming AS (
  SELECT c_custkey::VARCHAR AS external_id, c_mktsegment || ':' || c_nationkey AS data,
         CASE WHEN c_custkey % 17 <> 0 THEN sha256(c_mktsegment || ':' || c_nationkey) END AS _raw_hash, true AS here
  FROM customer WHERE c_acctbal >= 0
), cur AS (
  SELECT c_custkey::VARCHAR AS external_id,
         CASE WHEN c_custkey % 9 = 0 THEN '{}' ELSE c_mktsegment || ':' || (c_nationkey + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END) END AS data,
         CASE WHEN c_custkey % 19 <> 0 AND c_custkey % 34 <> 0 THEN sha256(c_mktsegment || ':' || (c_nationkey + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END)) END AS _raw_hash,
         c_custkey % 9 = 0 AS _deleted, true AS here
  FROM customer WHERE c_acctbal < 0 OR c_mktsegment <> 'MACHINERY'
), classified AS (
  SELECT i.external_id, CASE WHEN c.here IS NULL THEN 'insert' WHEN c._deleted THEN 'resurrect'
         WHEN c._raw_hash IS DISTINCT FROM i._raw_hash THEN 'update' ELSE 'noop' END AS action, i.data, i._raw_hash
  FROM incoming i LEFT JOIN cur c USING (external_id)
), live AS (SELECT external_id FROM cur WHERE NOT _deleted)
"""


def incoming(spark, d):
    text = F.concat_ws(":", "c_mktsegment", "c_nationkey")
    return table(spark, d, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").cast("string").alias("external_id"), text.alias("data"), F.when(F.col("c_custkey") % 17 != 0, F.sha2(text, 256)).alias("_raw_hash"))


def current(spark, d):
    text = F.concat_ws(":", "c_mktsegment", F.col("c_nationkey") + F.when(F.col("c_custkey") % 5 == 0, 1).otherwise(0))
    gone, hashed = F.col("c_custkey") % 9 == 0, (F.col("c_custkey") % 19 != 0) & (F.col("c_custkey") % 34 != 0)
    rows = table(spark, d, "customer").where("c_acctbal < 0 or c_mktsegment <> 'MACHINERY'")
    return rows.select(F.col("c_custkey").cast("string").alias("external_id"), F.when(gone, "{}").otherwise(text).alias("data"), F.when(hashed, F.sha2(text, 256)).alias("_raw_hash"), gone.alias("_deleted"))


def classified(spark, d):
    return merge.classify(incoming(spark, d), current(spark, d))


@query(INPUT + "SELECT * FROM classified")
def upsert_classify(spark, d):
    return classified(spark, d)


APPLIED = """SELECT external_id, CASE WHEN i.here THEN i.data ELSE c.data END AS data,
  CASE WHEN i.here THEN i._raw_hash ELSE c._raw_hash END AS _raw_hash, CASE WHEN i.here THEN false ELSE c._deleted END AS _deleted
  FROM cur c FULL OUTER JOIN incoming i USING (external_id)"""


@query(INPUT + APPLIED)
def upsert_apply(spark, d):
    return merge.apply(incoming(spark, d), current(spark, d))


@query("""SELECT c_custkey::VARCHAR AS external_id, c_name AS name, NULL::VARCHAR AS seg FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT c_custkey::VARCHAR, NULL, c_mktsegment FROM customer WHERE c_custkey % 2 = 1""")
def bulk_upsert(spark, d):
    """Records with different columns in one batch: their union, missing values null."""
    c = table(spark, d, "customer").withColumn("external_id", F.col("c_custkey").cast("string"))
    even = c.where("c_custkey % 2 = 0").select("external_id", F.col("c_name").alias("name"))
    odd = c.where("c_custkey % 2 = 1").select("external_id", F.col("c_mktsegment").alias("seg"))
    return even.unionByName(odd, allowMissingColumns=True)


@query(INPUT + "SELECT external_id, data, _raw_hash, 'run-1' AS _sync_run_id FROM classified WHERE action <> 'noop'")
def history_append(spark, d):
    return merge.history(classified(spark, d), "run-1")


@query(INPUT + "SELECT external_id, c.data, c._raw_hash FROM cur c WHERE NOT _deleted AND external_id NOT IN (SELECT external_id FROM incoming)")
def tombstones(spark, d):
    return merge.missing(current(spark, d), incoming(spark, d)).select("external_id", "data", "_raw_hash")


@query(INPUT + """SELECT count(*) AS n_live, count(*) FILTER (WHERE i.external_id IS NULL) AS n_missing,
  round(count(*) FILTER (WHERE i.external_id IS NULL) / count(*), 4) AS ratio, count(*) FILTER (WHERE i.external_id IS NULL) / count(*) > 0.5 AS aborted
  FROM live l LEFT JOIN incoming i USING (external_id)""")
def tombstone_guard(spark, d):
    """Ids may be seen more than once, as a record may be on several pages."""
    return merge.deletion_guard(current(spark, d), incoming(spark, d).union(incoming(spark, d)))


# Change records: several per customer, deletes among them, in the order of ``seq``. The first of a batch counts.
CHANGES = INPUT + """, ch AS (
  SELECT o_custkey::VARCHAR AS external_id, o_orderkey AS seq, CASE WHEN o_orderkey % 6 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS op, o_orderstatus AS data FROM orders
), one AS (SELECT * FROM ch JOIN (SELECT external_id, min(seq) AS seq FROM ch GROUP BY 1) USING (external_id, seq))
"""


def change_batch(spark, d):
    o = table(spark, d, "orders")
    changes = o.select(
        F.col("o_custkey").cast("string").alias("external_id"),
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderkey") % 6 == 0, "DELETE").otherwise("UPSERT").alias("op"),
        F.col("o_orderstatus").alias("data"),
        F.sha2("o_orderstatus", 256).alias("_raw_hash"),
    )
    return merge.change_batch(changes, current(spark, d), "seq", "run-1")


@query(CHANGES + """SELECT external_id, CASE o.op WHEN 'UPSERT' THEN o.data WHEN 'DELETE' THEN '{}' ELSE c.data END AS data,
  CASE WHEN o.op = 'UPSERT' THEN sha256(o.data) ELSE c._raw_hash END AS _raw_hash, CASE o.op WHEN 'UPSERT' THEN false WHEN 'DELETE' THEN true ELSE c._deleted END AS _deleted
  FROM cur c FULL OUTER JOIN one o USING (external_id) WHERE c.here OR o.op = 'UPSERT'""")
def cdc_apply(spark, d):
    return change_batch(spark, d)["state"]


@query(CHANGES + """SELECT external_id, o.data, sha256(o.data) AS _raw_hash, 'run-1' AS _sync_run_id FROM one o LEFT JOIN cur c USING (external_id)
  WHERE op = 'UPSERT' AND (c.here IS NULL OR c._deleted OR c._raw_hash IS DISTINCT FROM sha256(o.data))""")
def cdc_history(spark, d):
    return change_batch(spark, d)["history"]


@query("SELECT max(o_orderkey) AS watermark FROM orders")
def cdc_watermark(spark, d):
    return change_batch(spark, d)["watermark"]


@query("""WITH e AS (SELECT event_id, event_type, 0 AS copy FROM events UNION ALL SELECT event_id, event_type || '-again', 1 FROM events WHERE event_id % 10 = 0)
SELECT event_id, event_type FROM e WHERE copy = 0""")
def intra_sync_dedup(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", F.lit(0).alias("arrival"))
    again = e.where("event_id % 10 = 0").select("event_id", F.concat("event_type", F.lit("-again")), F.lit(1))
    return merge.first_per_key(e.union(again), "event_id", "arrival", ["event_type"])


@query(INPUT + """SELECT count(*) AS fetched, count(*) FILTER (WHERE action = 'insert') AS inserted, count(*) FILTER (WHERE action = 'update') AS updated,
  count(*) FILTER (WHERE action = 'resurrect') AS resurrected, count(*) FILTER (WHERE action = 'noop') AS unchanged FROM classified""")
def sync_counters(spark, d):
    return merge.counters(classified(spark, d))


@query(INPUT + """SELECT count(*) AS fetched, count(*) FILTER (WHERE action = 'insert') AS inserted, count(*) FILTER (WHERE action = 'update') AS updated,
  count(*) FILTER (WHERE action = 'resurrect') AS resurrected, 0::BIGINT AS deleted, count(*) FILTER (WHERE action = 'noop') AS unchanged FROM classified""")
def observed_counters(spark, d):
    """The counters of a merge, taken while a bucketed snapshot is written."""
    held = snapshots.Snapshot(spark, f"snapshot_{uuid.uuid4().hex}", 8, 4)
    held.create(current(spark, d))
    counters = held.merge(incoming(spark, d))
    spark.sql(f"DROP TABLE {held.name}")
    return spark.createDataFrame([tuple(counters.values())], ", ".join(f"{k} long" for k in counters))


@query(CHANGES + """SELECT external_id, CASE o.op WHEN 'UPSERT' THEN o.data WHEN 'DELETE' THEN '{}' ELSE c.data END AS data,
  CASE WHEN o.op = 'UPSERT' THEN sha256(o.data) ELSE c._raw_hash END AS _raw_hash, CASE o.op WHEN 'UPSERT' THEN false WHEN 'DELETE' THEN true ELSE c._deleted END AS _deleted,
  CASE WHEN o.op IS NULL THEN NULL WHEN o.op = 'DELETE' THEN CASE WHEN c._deleted THEN 'noop' ELSE 'delete' END WHEN c.here IS NULL THEN 'insert'
    WHEN c._deleted THEN 'resurrect' WHEN c._raw_hash IS DISTINCT FROM sha256(o.data) THEN 'update' ELSE 'noop' END AS action
  FROM cur c FULL OUTER JOIN one o USING (external_id) WHERE c.here OR o.op = 'UPSERT'""")
def bucketed_merge(spark, d):
    """Changes of orders merged into a bucketed snapshot, with the action of each."""
    held = snapshots.Snapshot(spark, f"snapshot_{uuid.uuid4().hex}", 8, 4)
    held.create(current(spark, d))
    o = table(spark, d, "orders")
    changes = o.select(F.col("o_custkey").cast("string").alias("external_id"), F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 6 == 0, "DELETE").otherwise("UPSERT").alias("op"), F.col("o_orderstatus").alias("data"), F.sha2("o_orderstatus", 256).alias("_raw_hash"))
    out = staging.staged(held.merged(merge.first_per_key(changes, "external_id", "seq", ["op", "data", "_raw_hash"])), "merged")
    spark.sql(f"DROP TABLE {held.name}")
    return out


@query("SELECT event_type AS datatype, max(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS watermark_value FROM events GROUP BY 1")
def watermark_max(spark, d):
    e = table(spark, d, "events")
    return e.groupBy(F.col("event_type").alias("datatype")).agg(F.max(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("watermark_value"))


@query("""SELECT user_id % 5 AS connector, max(event_id) AS run_id, max(event_id) % 17 AS page_number FROM events WHERE event_type <> 'purchase' GROUP BY 1""")
def checkpoint_resume(spark, d):
    """The newest checkpoint of each connector whose run has not ended."""
    e = table(spark, d, "events").withColumn("connector", F.col("user_id") % 5)
    saved = e.select("connector", F.col("event_id").alias("run_id"), (F.col("event_id") % 17).alias("page_number"))
    status = F.when(F.col("event_type") != "purchase", "running").otherwise("completed")
    return runs.resumable(saved, e.select(F.col("event_id").alias("run_id"), status.alias("status")), ["connector"])


@query("""WITH runs AS (SELECT user_id % 5 AS connector, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY ALL),
p AS (SELECT *, lag(n) OVER (PARTITION BY connector ORDER BY day) AS before FROM runs)
SELECT connector, strftime(day, '%Y-%m-%d') AS day, n, before, round((before - n) / before, 4) AS shrink, (before - n) / before > 0.3 AS alarmed FROM p WHERE before IS NOT NULL""")
def drift_guard(spark, d):
    """Runs with their shrink against the run before."""
    e = table(spark, d, "events")
    counted = e.groupBy((F.col("user_id") % 5).alias("connector"), F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day")).agg(F.count("*").alias("n"))
    return runs.shrunk(counted, ["connector"], "day", "n", 0.3).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(INPUT + """, sample AS (SELECT * FROM incoming JOIN (SELECT external_id, _raw_hash AS stored FROM cur WHERE NOT _deleted) USING (external_id) ORDER BY md5(external_id), external_id LIMIT 100)
SELECT count(*) AS sampled, count(*) FILTER (WHERE stored IS DISTINCT FROM _raw_hash) AS drifted, round(count(*) FILTER (WHERE stored IS DISTINCT FROM _raw_hash) / count(*), 4) AS share FROM sample""")
def reconcile_drift(spark, d):
    """Content drift over a sample of at most 100 live records, in hash order: a sampling operator."""
    stored = current(spark, d).where("not _deleted").select("external_id", F.col("_raw_hash").alias("stored"))
    sample = incoming(spark, d).join(stored, "external_id").orderBy(F.md5("external_id"), "external_id").limit(100)
    return runs.drift_share(sample, "stored", "_raw_hash")


@query(INPUT + "SELECT count(*) AS n FROM live")
def live_count(spark, d):
    return current(spark, d).where("not _deleted").agg(F.count("*").alias("n"))


@query(INPUT + "SELECT external_id FROM live")
def live_ids(spark, d):
    return current(spark, d).where("not _deleted").select("external_id")
