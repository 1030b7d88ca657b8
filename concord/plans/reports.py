"""Operational reports, maintenance and schema queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import records as R
from ..operators import commands as control_commands
from ..operators import hooks, merge, schemas
from ..operators import runs as runlog
from .registry import NOW, query, table
from .state import INPUT, current

# Sync runs, audit and dead letters read from events: one run per event.
RUNS = """WITH runs AS (SELECT event_id AS id, 'c' || (user_id % 5) AS connector, event_type AS datatype,
  CASE WHEN event_type = 'click' THEN 'failed' ELSE 'completed' END AS status, ts AS started_at, ts + interval 5 minute AS finished_at,
  (event_id % 17)::BIGINT AS inserted, (event_id % 5)::BIGINT AS updated FROM events)
"""
TIME = "strftime(started_at, '%Y-%m-%d %H:%M:%S')"
RANK = "row_number() OVER (PARTITION BY connector, datatype ORDER BY started_at DESC, id DESC)"


def runs(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string")).alias("connector"),
        F.col("event_type").alias("datatype"),
        F.when(F.col("event_type") == "click", "failed").otherwise("completed").alias("status"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.expr("interval 5 minutes")).alias("finished_at"),
        (F.col("event_id") % 17).alias("inserted"),
        (F.col("event_id") % 5).alias("updated"),
    )


def text(column: str, name: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name)


def ago(span: str):
    return F.lit(NOW).cast("timestamp") - F.expr(f"interval {span}")


PAIR = ["connector", "datatype"]


def newest_runs(spark, d, n=1):
    """The n newest runs of each pair; n is a small constant, so an ordered window limit is pushed into the sort."""
    return merge.newest(runs(spark, d), PAIR, [F.desc("started_at"), F.desc("id")], n)


@query(RUNS + f"SELECT id, connector, datatype, status FROM (SELECT *, {RANK} AS n FROM runs) WHERE n = 1")
def latest_run_per_pair(spark, d):
    last = runs(spark, d).groupBy(*PAIR).agg(F.max_by(F.struct("id", "status"), F.struct("started_at", "id")).alias("r"))
    return last.select("r.id", *PAIR, "r.status")


@query(RUNS + "SELECT connector, datatype, coalesce(sum(inserted + updated), 0)::BIGINT AS records FROM runs WHERE started_at > timestamp '2024-01-30 00:00:00' - interval 24 hour GROUP BY ALL")
def records_24h(spark, d):
    recent = runs(spark, d).where("started_at > timestamp '2024-01-30 00:00:00' - interval 24 hours")
    return recent.groupBy(*PAIR).agg(F.coalesce(F.sum(F.col("inserted") + F.col("updated")), F.lit(0)).alias("records"))


@query(RUNS + "SELECT DISTINCT connector, datatype FROM runs")
def distinct_pairs(spark, d):
    return runs(spark, d).select(*PAIR).distinct()


@query(RUNS + "SELECT count(DISTINCT connector) AS n FROM runs")
def connector_count(spark, d):
    return runs(spark, d).agg(F.count_distinct("connector").alias("n"))


SCORE = RUNS + f""", s AS (SELECT connector, datatype, round(avg(CASE WHEN status = 'completed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS score
  FROM (SELECT *, {RANK} AS n FROM runs) WHERE n <= 10 GROUP BY ALL UNION ALL SELECT 'c9', 'never-run', 1.0::DOUBLE)"""


def scores(spark, d):
    """All pairs of connectors and datatypes that have run, and one that has not."""
    r = runs(spark, d)
    return runlog.health_scores(r, r.select(*PAIR).union(spark.createDataFrame([("c9", "never-run")], "connector string, datatype string")))


@query(SCORE + "SELECT * FROM s")
def health_score(spark, d):
    return scores(spark, d)


@query(SCORE + "SELECT count(*) FILTER (WHERE score >= 0.8) AS healthy, count(*) FILTER (WHERE score >= 0.5 AND score < 0.8) AS degraded, count(*) FILTER (WHERE score < 0.5) AS unhealthy FROM s")
def health_brackets(spark, d):
    s = F.col("score")
    return scores(spark, d).agg(F.count_if(s >= 0.8).alias("healthy"), F.count_if((s >= 0.5) & (s < 0.8)).alias("degraded"), F.count_if(s < 0.5).alias("unhealthy"))


@query(RUNS + f"SELECT id, connector, datatype, {TIME} AS started FROM runs WHERE connector = 'c1' AND status = 'completed' ORDER BY started_at DESC, id DESC LIMIT 100")
def sync_runs_filtered(spark, d):
    found = runs(spark, d)
    for condition in ("connector = 'c1'", "status = 'completed'"):
        found = found.where(condition)
    return found.orderBy(F.desc("started_at"), F.desc("id")).limit(100).select("id", *PAIR, text("started_at", "started"))


@query(RUNS + f"SELECT id, connector, {TIME} AS failed FROM runs WHERE status = 'failed' ORDER BY started_at DESC, id DESC LIMIT 50")
def dead_letter_recent(spark, d):
    return runs(spark, d).where("status = 'failed'").orderBy(F.desc("started_at"), F.desc("id")).limit(50).select("id", "connector", text("started_at", "failed"))


@query(RUNS + f"SELECT id, connector, datatype, status, {TIME} AS processed FROM runs ORDER BY started_at DESC, id DESC LIMIT 100")
def audit_recent(spark, d):
    return runs(spark, d).orderBy(F.desc("started_at"), F.desc("id")).limit(100).select("id", *PAIR, "status", text("started_at", "processed"))


@query("SELECT o_orderkey AS external_id, 'c' || o_custkey AS cluster_id, strftime(o_orderdate, '%Y-%m-%d') AS updated FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100")
def identity_map_list(spark, d):
    o = table(spark, d, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(100)
    return o.select(F.col("o_orderkey").alias("external_id"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("cluster_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated"))


@query("""SELECT 'current' AS kind, o_orderkey AS version, o_orderstatus AS data FROM orders WHERE o_custkey = 10 AND o_orderkey = (SELECT max(o_orderkey) FROM orders WHERE o_custkey = 10)
UNION ALL SELECT 'history', o_orderkey, o_orderstatus FROM orders WHERE o_custkey = 10""")
def record_lineage(spark, d):
    past = table(spark, d, "orders").where("o_custkey = 10").select(F.lit("history").alias("kind"), F.col("o_orderkey").alias("version"), F.col("o_orderstatus").alias("data"))
    now = past.orderBy(F.desc("version")).limit(1).withColumn("kind", F.lit("current"))
    return now.unionByName(past)


@query("SELECT event_id, event_type AS command FROM events WHERE event_type <> 'view' AND user_id % 2 = 0 ORDER BY ts, event_id LIMIT 20")
def control_pending(spark, d):
    e = table(spark, d, "events").where("event_type <> 'view' and user_id % 2 = 0")
    return e.orderBy("ts", "event_id").limit(20).select("event_id", F.col("event_type").alias("command"))


@query("SELECT event_id, event_type AS command, CASE WHEN user_id % 2 = 0 THEN 'done' ELSE 'failed' END AS status FROM events ORDER BY ts DESC, event_id DESC LIMIT 30")
def control_history(spark, d):
    e = table(spark, d, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(30)
    return e.select("event_id", F.col("event_type").alias("command"), F.when(F.col("user_id") % 2 == 0, "done").otherwise("failed").alias("status"))


@query("SELECT event_id, event_type FROM events WHERE ts >= timestamp '2024-01-10 00:00:00' ORDER BY ts DESC, event_id DESC LIMIT 40")
def webhook_log_recent(spark, d):
    e = table(spark, d, "events").where("ts >= timestamp_ntz '2024-01-10 00:00:00'")
    return e.orderBy(F.desc("ts"), F.desc("event_id")).limit(40).select("event_id", "event_type")


@query(RUNS + f"SELECT id, status, {TIME} AS started FROM runs WHERE connector = 'c2' AND datatype = 'view' ORDER BY started_at DESC, id DESC LIMIT 1")
def datatype_status(spark, d):
    one = runs(spark, d).where("connector = 'c2' and datatype = 'view'").orderBy(F.desc("started_at"), F.desc("id")).limit(1)
    return one.select("id", "status", text("started_at", "started"))


@query(RUNS + "SELECT connector, strftime(max(finished_at), '%Y-%m-%d %H:%M:%S') AS reported FROM runs GROUP BY 1 HAVING max(finished_at) > timestamp '2024-01-30 00:00:00' - interval 3 hour")
def alive_instances(spark, d):
    last = runs(spark, d).groupBy("connector").agg(F.max("finished_at").alias("at"))
    return last.where("at > timestamp '2024-01-30 00:00:00' - interval 3 hours").select("connector", text("at", "reported"))


@query(RUNS + """SELECT n_name AS datatype, strftime(l.at, '%Y-%m-%d %H:%M:%S') AS finished, l.at IS NULL OR epoch(timestamp '2024-02-01 00:00:00' - l.at) > 172800 AS violated
FROM (SELECT DISTINCT datatype AS n_name FROM runs UNION ALL SELECT 'never-run') p LEFT JOIN (SELECT datatype, max(finished_at) AS at FROM runs WHERE status = 'completed' GROUP BY 1) l ON l.datatype = p.n_name""")
def sla_status(spark, d):
    r = runs(spark, d)
    wanted = r.select("datatype").distinct().union(spark.createDataFrame([("never-run",)], "datatype string"))
    return runlog.late(wanted, r, ["datatype"], F.lit(NOW).cast("timestamp"), "48 hours").select("datatype", text("at", "finished"), "violated")


@query(RUNS + "SELECT connector, count(*) AS failures FROM runs WHERE status = 'failed' GROUP BY 1")
def failure_count(spark, d):
    return runs(spark, d).where("status = 'failed'").groupBy("connector").agg(F.count("*").alias("failures"))


@query("SELECT user_id, count(*) AS n FROM events WHERE ts > timestamp '2024-01-29 12:00:00' - interval 1 hour GROUP BY 1")
def resync_count(spark, d):
    return table(spark, d, "events").where("ts > timestamp_ntz '2024-01-29 12:00:00' - interval 1 hour").groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT c_custkey FROM customer WHERE c_mktsegment LIKE 'B%' OR regexp_full_match(c_name, '.*[13]')")
def glob_filter(spark, d):
    c = table(spark, d, "customer")
    return c.where(R.matches_glob(F.col("c_mktsegment"), "B*") | R.matches_glob(F.col("c_name"), "*[13]")).select("c_custkey")


@query("""SELECT coalesce(n.k, o.k) AS k, coalesce(n.score, o.score) AS score FROM (SELECT c_custkey AS k, 'old' || c_name AS score FROM customer WHERE c_acctbal < 6000) o
FULL OUTER JOIN (SELECT c_custkey AS k, 'new' || c_name AS score FROM customer WHERE c_acctbal >= 2000) n ON o.k = n.k""")
def heartbeat_merge(spark, d):
    c = table(spark, d, "customer")
    part = lambda which, mark: c.where(which).select(F.col("c_custkey").alias("k"), F.concat(F.lit(mark), "c_name").alias("score"))
    return merge.keyed_merge(part("c_acctbal < 6000", "old"), part("c_acctbal >= 2000", "new"), ["k"])


@query("""SELECT coalesce(n.k, o.k) AS k, CASE WHEN n.k IS NOT NULL THEN 'unhealthy' ELSE 'healthy' END AS status, coalesce(o.since, n.since) AS marked_unhealthy_at
FROM (SELECT c_custkey AS k, CASE WHEN c_mktsegment = 'BUILDING' THEN '2024-01-01' END AS since FROM customer WHERE c_acctbal < 6000) o
FULL OUTER JOIN (SELECT c_custkey AS k, '2024-02-01' AS since FROM customer WHERE c_acctbal >= 2000) n ON o.k = n.k""")
def health_merge(spark, d):
    c = table(spark, d, "customer").withColumn("k", F.col("c_custkey"))
    old = c.where("c_acctbal < 6000").select("k", F.lit("healthy").alias("status"), F.when(F.col("c_mktsegment") == "BUILDING", "2024-01-01").alias("marked_unhealthy_at"))
    new = c.where("c_acctbal >= 2000").select("k", F.lit("unhealthy").alias("status"), F.lit("2024-02-01").alias("marked_unhealthy_at"))
    return merge.keyed_merge(old, new, ["k"], keep_first=["marked_unhealthy_at"])


# maintenance


@query(RUNS + "SELECT id FROM runs WHERE NOT (CASE WHEN datatype = 'view' THEN started_at < timestamp '2024-02-01 00:00:00' - interval 7 day WHEN datatype = 'click' THEN started_at < timestamp '2024-02-01 00:00:00' - interval 14 day AND status = 'completed' ELSE false END)")
def housekeeping_keep(spark, d):
    """What a retention purge leaves: rules by class, and only finished rows of some."""
    old = F.when(F.col("datatype") == "view", F.col("started_at") < ago("7 days")).when(F.col("datatype") == "click", (F.col("started_at") < ago("14 days")) & (F.col("status") == "completed"))
    return runs(spark, d).where(~F.coalesce(old, F.lit(False))).select("id")


KEPT = """WITH o AS (SELECT o_orderkey AS id, ['sync_run', 'dead_letter', 'history', 'webhook_route_seq', 'writeback_result', 'writeback_dead_letter', 'desired_state'][o_orderkey % 7 + 1] AS kind,
  [90, 30, 365, 7, 1, 30, 90][o_orderkey % 7 + 1] AS days,
  CASE WHEN o_orderkey % 5 <> 0 THEN timestamp '2024-02-01 00:00:00' - to_hours((o_orderkey * 13 % 12000)::INTEGER) END AS at_ FROM orders)
SELECT id, kind FROM o WHERE at_ IS NULL OR at_ >= timestamp '2024-02-01 00:00:00' - to_days(days::INTEGER)"""


@query(KEPT)
def retention(spark, d):
    """Seven classes of rows, each with its time and window; results of writes have a window of no day, and stay for one."""
    k = F.col("o_orderkey")
    kinds = list(runlog.AGES_BY)
    at = F.when(k % 5 != 0, F.lit(NOW).cast("timestamp") - F.make_dt_interval(hours=(k * 13 % 12000).cast("int")))
    rows = table(spark, d, "orders").select(k.alias("id"), F.element_at(F.array(*[F.lit(n) for n in kinds]), (k % 7).cast("int") + 1).alias("kind"), at.alias("at"))
    left = None
    for kind in kinds:
        own = rows.where(F.col("kind") == kind).withColumnRenamed("at", runlog.AGES_BY[kind])
        kept = runlog.retained(own, kind, F.lit(NOW).cast("timestamp"), runlog.RETENTION | {"writeback_result": 0}).select("id", "kind")
        left = kept if left is None else left.unionByName(kept)
    return left


COMMANDS = """WITH names AS (SELECT ['force_full_sync', 'pause_connector', 'resume_connector', 'requeue_dead_letter', 'gdpr-purge', 'dance'] AS n),
c AS (SELECT event_id AS id, 'c' || user_id % 5 AS connector, CASE WHEN event_id % 3 <> 0 THEN event_type END AS datatype, n[event_id % 6 + 1] AS command,
  CASE WHEN event_id % 4 = 0 THEN 'done' ELSE 'pending' END AS status, ts AS issued_at, '{"external_id":"' || user_id || '"}' AS payload,
  CASE event_id % 5 WHEN 0 THEN 'writer' WHEN 1 THEN 'reader' END AS target_tool FROM events, names),
taken AS (SELECT * FROM c WHERE status = 'pending' AND (target_tool IS NULL OR target_tool = 'reader') ORDER BY issued_at, id LIMIT 20),
pairs AS (SELECT DISTINCT 'c' || user_id % 5 AS connector, event_type AS datatype FROM events)
"""


def control(spark, d):
    """Commands of all kinds, one of them unknown, for two tools or any."""
    k = F.col("event_id")
    names = F.array(*[F.lit(n) for n in ("force_full_sync", "pause_connector", "resume_connector", "requeue_dead_letter", "gdpr-purge", "dance")])
    made = table(spark, d, "events").select(
        k.alias("id"), F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string")).alias("connector"), F.when(k % 3 != 0, F.col("event_type")).alias("datatype"),
        F.element_at(names, (k % 6).cast("int") + 1).alias("command"), F.when(k % 4 == 0, "done").otherwise("pending").alias("status"), F.col("ts").alias("issued_at"),
        F.concat(F.lit('{"external_id":"'), F.col("user_id").cast("string"), F.lit('"}')).alias("payload"), F.when(k % 5 == 0, "writer").when(k % 5 == 1, "reader").alias("target_tool"))
    return made, control_commands.due(made, "reader")


def _pairs(spark, d):
    return table(spark, d, "events").select(F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string")).alias("connector"), F.col("event_type").alias("datatype")).distinct()


@query(COMMANDS + """SELECT id, CASE WHEN id IN (SELECT id FROM taken) THEN CASE WHEN command = 'dance' THEN 'failed' ELSE 'completed' END ELSE status END AS status,
  CASE WHEN command = 'dance' AND id IN (SELECT id FROM taken) THEN 'Unknown command: dance' END AS error FROM c""")
def control_dispatch(spark, d):
    made, taken = control(spark, d)
    return control_commands.dispatched(made, taken).select("id", "status", "error")


@query(COMMANDS + "SELECT * FROM pairs p WHERE NOT EXISTS (SELECT * FROM taken t WHERE t.command = 'force_full_sync' AND t.connector = p.connector AND (t.datatype IS NULL OR t.datatype = p.datatype))")
def control_resets(spark, d):
    return control_commands.reset_watermarks(_pairs(spark, d), control(spark, d)[1])


@query(COMMANDS + """SELECT connector, datatype, coalesce((SELECT arg_max(t.command, (t.issued_at, t.id)) FROM taken t WHERE t.command IN ('pause_connector', 'resume_connector')
  AND t.connector = p.connector AND (t.datatype IS NULL OR t.datatype = p.datatype)) = 'pause_connector', false) AS paused FROM pairs p""")
def control_pauses(spark, d):
    state = _pairs(spark, d).withColumn("paused", F.lit(False))
    return control_commands.pauses(state, control(spark, d)[1])


@query(COMMANDS + """, l AS (SELECT event_id AS id, 'c' || user_id % 5 AS connector, event_type AS datatype, event_id % 6 AS requeue_count FROM events),
r AS (SELECT *, requeue_count < 3 AND EXISTS (SELECT * FROM taken t WHERE t.command = 'requeue_dead_letter' AND t.connector = l.connector AND (t.datatype IS NULL OR t.datatype = l.datatype)) AS requeued FROM l)
SELECT id, requeue_count + requeued::INT AS requeue_count, requeued FROM r""")
def control_requeues(spark, d):
    e = table(spark, d, "events")
    found = e.select(F.col("event_id").alias("id"), F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string")).alias("connector"), F.col("event_type").alias("datatype"), (F.col("event_id") % 6).alias("requeue_count"))
    return control_commands.requeued(found, control(spark, d)[1]).select("id", "requeue_count", "requeued")


@query(COMMANDS + """SELECT c_custkey::VARCHAR AS external_id, CASE WHEN g.x IS NOT NULL THEN '{}' ELSE c_name END AS data, g.x IS NOT NULL AS _deleted
FROM customer LEFT JOIN (SELECT DISTINCT json_extract_string(payload, '$.external_id') AS x FROM taken WHERE command = 'gdpr-purge') g ON g.x = c_custkey::VARCHAR""")
def control_purges(spark, d):
    held = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("external_id"), F.col("c_name").alias("data"), F.sha2("c_name", 256).alias("_raw_hash"), F.lit(False).alias("_deleted"))
    return control_commands.purged(held, control(spark, d)[1]).drop("_raw_hash")


@query("SELECT c_custkey, CASE WHEN c_custkey % 10 = 3 THEN '{}' ELSE c_name END AS data, c_custkey % 10 = 3 AS _deleted FROM customer")
def privacy_purge(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("data"), F.col("c_name").alias("_raw_hash"), F.lit(False).alias("_deleted"))
    rows = rows.withColumnRenamed("c_custkey", "external_id")
    gone = rows.where("external_id % 10 = 3")
    return merge.tombstone(rows, gone).select(F.col("external_id").alias("c_custkey"), "data", "_deleted")


@query("SELECT event_id FROM events WHERE event_id % 6 < 3 AND event_id % 4 <> 0 ORDER BY ts, event_id LIMIT 100")
def dl_replayable(spark, d):
    letters = table(spark, d, "events").select("event_id", "ts", (F.col("event_id") % 6).alias("requeue_count"), F.when(F.col("event_id") % 4 == 0, F.col("ts")).alias("requeued_at"))
    return letters.where("requeue_count < 3 and requeued_at is null").orderBy("ts", "event_id").limit(100).select("event_id")


# Dead letters of users' records; those without a record can't be requeued.
LETTERS = "WITH l AS (SELECT 1152921504606846976 + event_id AS id, CASE WHEN event_id % 4 <> 0 THEN user_id::VARCHAR END AS external_id, props AS raw, event_id % 6 AS requeue_count FROM events)"


def letters(spark, d):
    e = table(spark, d, "events")
    return e.select((F.lit(1 << 60) + F.col("event_id")).alias("id"), F.when(F.col("event_id") % 4 != 0, F.col("user_id").cast("string")).alias("external_id"), F.col("props").alias("raw"), (F.col("event_id") % 6).alias("requeue_count"))


@query(LETTERS + "SELECT id, requeue_count + CASE WHEN requeue_count < 3 AND external_id IS NOT NULL THEN 1 ELSE 0 END AS requeue_count FROM l")
def dl_requeue(spark, d):
    return hooks.requeue(letters(spark, d), current(spark, d))[1].select("id", "requeue_count")


@query(INPUT + ", " + LETTERS.removeprefix("WITH ") + """, n AS (SELECT external_id, max_by(raw, id) AS data FROM l WHERE requeue_count < 3 AND external_id IS NOT NULL GROUP BY 1)
SELECT external_id, coalesce(n.data, c.data) AS data, CASE WHEN n.data IS NOT NULL THEN sha256(replace(n.data, ' ', '')) ELSE c._raw_hash END AS _raw_hash, n.data IS NULL AND c._deleted AS _deleted
FROM cur c FULL OUTER JOIN n USING (external_id)""")
def dl_requeue_apply(spark, d):
    """The snapshot with the newest eligible dead letter of each record."""
    return hooks.requeue(letters(spark, d), current(spark, d))[0]


class _Never(hooks.DefaultPolicy):
    def should_dead_letter(self, rows):
        return F.col("attempt_count") >= 2

    def should_replay(self, rows):
        return F.lit(False)


ODD = """WITH f AS (SELECT o_orderkey AS external_id, 'c' || (o_orderkey % 3) AS connector, o_orderkey % 5 AS requeue_count, o_orderkey % 4 AS attempt_count FROM orders)"""


def failures(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(k.alias("external_id"), F.concat(F.lit("c"), (k % 3).cast("string")).alias("connector"), (k % 5).alias("requeue_count"), (k % 4).alias("attempt_count"))


@query(ODD + """SELECT external_id, CASE WHEN connector <> 'c1' AND requeue_count < 3 THEN 'pending' ELSE 'failed' END AS _status,
  requeue_count + CASE WHEN connector <> 'c1' AND requeue_count < 3 THEN 1 ELSE 0 END AS requeue_count FROM f""")
def wb_dl_replay(spark, d):
    return hooks.replayed(failures(spark, d), {"c1": _Never()}).select("external_id", "_status", "requeue_count")


@query(ODD + "SELECT external_id, connector FROM f WHERE connector <> 'c1' OR attempt_count >= 2")
def dl_policy(spark, d):
    return hooks.dead_lettered(failures(spark, d), {"c1": _Never()}).select("external_id", "connector")


def _repair(record):
    """Drops records with an even k, fails on multiples of 5, and wraps the others."""
    if record["k"] % 2 == 0:
        return None
    if record["k"] % 5 == 0:
        raise ValueError(record)
    return {"k": record["k"] + 1, "fixed": True}


REPAIRED = LETTERS + """, r AS (SELECT *, (raw::JSON->>'k')::BIGINT AS k FROM l), o AS (SELECT *, CASE WHEN k % 2 = 0 THEN 'dropped' WHEN k % 5 = 0 THEN 'failed' ELSE 'upserted' END AS outcome FROM r)
"""


@query(REPAIRED + "SELECT CASE WHEN id % 97 <> 0 THEN id END AS id, outcome, requeue_count + CASE WHEN outcome = 'failed' THEN 0 ELSE 1 END AS requeue_count FROM o")
def dl_transform(spark, d):
    """Letters of which some have no number."""
    some = letters(spark, d).withColumn("id", F.when(F.col("id") % 97 != 0, F.col("id")))
    return hooks.reprocessed(some, _repair)[1].select("id", "outcome", "requeue_count")


@query(REPAIRED + """SELECT coalesce(external_id, id::VARCHAR) AS external_id, '{"k":' || (k + 1) || ',"fixed":true}' AS data, 'dl_reprocessed' AS _raw_hash FROM o WHERE outcome = 'upserted'""")
def dl_transform_upserts(spark, d):
    return hooks.reprocessed(letters(spark, d), _repair)[0]


@query("SELECT 'r' || n_regionkey AS connector, n_name AS datatype, 'w' || n_nationkey AS value FROM nation WHERE n_regionkey <> 1 AND NOT (n_regionkey = 2 AND n_name = 'CHINA')")
def watermark_reset(spark, d):
    """Watermarks left after clearing one connector and one datatype of another."""
    n = table(spark, d, "nation")
    marks = n.select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("connector"), F.col("n_name").alias("datatype"), F.concat(F.lit("w"), F.col("n_nationkey").cast("string")).alias("value"))
    return runlog.clear_watermarks(runlog.clear_watermarks(marks, "r1"), "r2", "CHINA", frozenset({("r2", "INDIA")}))


@query("""SELECT event_id AS run_id, event_type AS datatype, CASE WHEN event_id % 3 = 0 THEN 'running' WHEN event_id % 3 = 1 THEN 'completed' ELSE 'failed' END AS status,
  CASE WHEN event_id % 3 <> 0 THEN event_id * 2 ELSE 0 END AS fetched, CASE WHEN event_id % 3 <> 0 THEN 'w' || event_id END AS watermark_after FROM events""")
def sync_run_log(spark, d):
    """Runs that start, and two thirds of them that end; results of unknown runs, and second ones, change nothing."""
    e = table(spark, d, "events")
    new = e.select(F.col("event_id").alias("run_id"), F.lit("c").alias("connector"), F.col("event_type").alias("datatype"), F.col("ts").alias("started_at"), F.lit(None).cast("string").alias("watermark_before"))
    log = runlog.started(new.limit(0), new)

    def results(k, status, shift=0):
        part = e.where(F.col("event_id") % 3 == k)
        done = [F.lit(status).alias("status"), F.col("ts").alias("finished_at"), F.concat(F.lit("w"), F.col("event_id").cast("string")).alias("watermark_after")]
        return part.select((F.col("event_id") + shift).alias("run_id"), *done, *[(F.col("event_id") * 2).alias(c) for c in runlog.COUNTERS])

    late = results(1, "failed").withColumn("finished_at", F.col("finished_at") + F.expr("interval 1 hour"))  # a second result of the same runs
    log = runlog.finished(log, results(1, "completed").union(results(2, "failed")).union(late))
    log = runlog.finished(log, results(1, "failed").union(results(2, "completed", -1_000_000_000)))
    return log.select("run_id", "datatype", "status", "fetched", "watermark_after")


@query("""WITH o AS (SELECT column_name AS name FROM (DESCRIBE customer)), n(name) AS (VALUES ('c_custkey'), ('c_nationkey'), ('c_name'), ('c_phone'))
SELECT coalesce(o.name, n.name) AS name, CASE WHEN o.name IS NULL THEN 'added' WHEN n.name IS NULL THEN 'removed' ELSE 'retyped' END AS change
FROM o FULL OUTER JOIN n ON o.name = n.name WHERE o.name IS NULL OR n.name IS NULL OR o.name = 'c_name'""")
def schema_diff(spark, d):
    old = table(spark, d, "customer")
    new = old.select("c_custkey", "c_nationkey", F.length("c_name").alias("c_name"), F.lit("x").alias("c_phone"))
    return schemas.diff(spark, old.schema, new.schema)


@query("""WITH o AS (SELECT '{"id":' || c_custkey || ',"name":"' || c_name || '","acct":' || c_acctbal || ',"seg":"' || c_mktsegment || '"}' AS j FROM customer),
n AS (SELECT '{"id":"' || c_custkey || '","name":' || CASE WHEN c_acctbal < 0 THEN '1' ELSE '"' || c_name || '"' END || ',"acct":' || c_acctbal || ',"phone":{"n":' || c_nationkey || '},"seg":null}' AS j FROM customer),
e AS (SELECT side, name, CASE json_type(j, '$.' || name) WHEN 'VARCHAR' THEN 'string' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN NULL ELSE 'number' END AS kind
  FROM (SELECT 'o' AS side, j, unnest(json_keys(j)) AS name FROM o UNION ALL SELECT 'n', j, unnest(json_keys(j)) FROM n)),
t AS (SELECT side, name, CASE WHEN count(DISTINCT kind) > 1 THEN 'mixed' ELSE max(kind) END AS type FROM e GROUP BY ALL)
SELECT coalesce(a.name, b.name) AS field, CASE WHEN a.name IS NULL THEN 'added' WHEN b.name IS NULL THEN 'removed' ELSE 'retyped' END AS change, a.type AS was, b.type AS now
FROM (FROM t WHERE side = 'o') a FULL OUTER JOIN (FROM t WHERE side = 'n') b ON a.name = b.name WHERE a.name IS NULL OR b.name IS NULL OR a.type <> b.type""")
def schema_diff_observed(spark, d):
    """Fields that appear, or change their type, between two states of all records."""
    c = table(spark, d, "customer")
    k, acct = F.col("c_custkey").cast("string"), F.col("c_acctbal").cast("string")
    old = F.concat(F.lit('{"id":'), k, F.lit(',"name":"'), "c_name", F.lit('","acct":'), acct, F.lit(',"seg":"'), "c_mktsegment", F.lit('"}'))
    name = F.when(F.col("c_acctbal") < 0, F.lit("1")).otherwise(F.concat(F.lit('"'), "c_name", F.lit('"')))
    new = F.concat(F.lit('{"id":"'), k, F.lit('","name":'), name, F.lit(',"acct":'), acct, F.lit(',"phone":{"n":'), F.col("c_nationkey").cast("string"), F.lit('},"seg":null}'))
    states = [schemas.observed_types(c.select(state.alias("j")), "j") for state in (old, new)]
    return schemas.diff_types(*states)


FIELDS = "WITH f AS (SELECT DISTINCT unnest(json_keys(props)) AS field FROM events), k(field) AS (VALUES ('old')) "


@query(FIELDS + "SELECT field, 'new' AS drift FROM f WHERE field NOT IN (FROM k) UNION ALL SELECT field, 'orphan' FROM k WHERE field NOT IN (FROM f)")
def schema_drift(spark, d):
    return schemas.drift(spark, schemas.observed(table(spark, d, "events"), "props"), ["old"])


@query(FIELDS + "SELECT 'old' AS known, 4 + CASE WHEN EXISTS (SELECT * FROM f WHERE field <> 'old') THEN 1 ELSE 0 END AS _schema_version UNION ALL SELECT 'k', 4 + CASE WHEN EXISTS (SELECT * FROM f WHERE field <> 'k') THEN 1 ELSE 0 END")
def schema_bump(spark, d):
    """Versions after a batch, for a schema that knows its fields and one that does not."""
    seen = schemas.observed(table(spark, d, "events"), "props")
    made = [schemas.bumped(4, schemas.drift(spark, seen, [known])).select(F.lit(known).alias("known"), "_schema_version") for known in ("old", "k")]
    return made[0].union(made[1])


@query("SELECT c_custkey, c_name, NULL::VARCHAR AS c_phone FROM customer")
def schema_prune(spark, d):
    """Wanted columns only: missing ones come as nulls, orphans go."""
    wanted = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()), T.StructField("c_phone", T.StringType())])
    return schemas.migrate(table(spark, d, "customer"), wanted, prune=True)


@query("SELECT DISTINCT unnest(json_keys(props)) AS field FROM events")
def observed_fields(spark, d):
    return schemas.observed(table(spark, d, "events"), "props")
