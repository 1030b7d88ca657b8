"""Queries of event rules in batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import records as R
from ..operators import events as ev
from ..operators import merge, writeback
from .registry import query, table

SEQ = "WITH e AS (SELECT event_id, user_id, ts, event_type, (event_id * 7919) % 1009 AS seq FROM events)"


def events(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.withColumn("seq", (F.col("event_id") * 7919) % 1009)


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN 'clicks' WHEN starts_with(event_type, 'p') THEN 'money' WHEN event_type LIKE '%o%' THEN 'other' END AS datatype FROM events")
def event_route(spark, d):
    routes = [("equals", "click", "clicks"), ("prefix", "p", "money"), ("glob", "*o*", "other")]
    return ev.route(table(spark, d, "events"), "event_type", routes).select("event_id", "datatype")


@query("""WITH r AS (SELECT 'prefix' AS kind, substr(p_name, 1, 4 + p_partkey % 9) AS text, p_brand AS datatype, p_partkey AS place FROM part
  UNION ALL SELECT 'equals', p_name, p_type, 10 * p_partkey FROM part WHERE p_partkey % 3 = 0),
m AS (SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON p_partkey = l_partkey), v AS (SELECT DISTINCT p_name FROM m),
b AS (SELECT v.p_name, min((place, datatype)) AS best FROM v JOIN r ON CASE kind WHEN 'equals' THEN v.p_name = text ELSE starts_with(v.p_name, text) END GROUP BY 1)
SELECT l_orderkey, l_linenumber, best[2] AS datatype FROM m LEFT JOIN b USING (p_name)""")
def event_route_table(spark, d):
    """Lines sent on by a table of routes over the names of their parts: prefixes of several lengths and whole names."""
    p = table(spark, d, "part")
    prefixes = p.select(F.lit("prefix").alias("kind"), F.expr("substr(p_name, 1, int(4 + p_partkey % 9))").alias("text"), F.col("p_brand").alias("datatype"), F.col("p_partkey").alias("place"))
    whole = p.where("p_partkey % 3 = 0").select(F.lit("equals"), "p_name", "p_type", F.col("p_partkey") * 10)
    lines = table(spark, d, "lineitem").join(p, F.col("p_partkey") == F.col("l_partkey")).select("l_orderkey", "l_linenumber", "p_name")
    return ev.routed(lines, "p_name", prefixes.union(whole)).select("l_orderkey", "l_linenumber", "datatype")


@query("SELECT event_id, event_type FROM events")
def event_dedup(spark, d):
    """A tenth of the events come again, later and with another type: the first one counts."""
    e = table(spark, d, "events").select("event_id", "event_type", F.lit(0).alias("arrival"))
    again = e.where("event_id % 10 = 0").select("event_id", F.lit("again").alias("event_type"), F.lit(1).alias("arrival"))
    return merge.first_per_key(again.union(e), "event_id", "arrival", ["event_type"])


@query(SEQ + "SELECT event_id, coalesce(seq <= max(seq) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stale FROM e")
def stale_events(spark, d):
    return ev.stale(events(spark, d), "user_id", "event_id", "seq").select("event_id", "stale")


@query("""WITH s AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq, event_id FROM events), k AS (SELECT user_id, seq, lag(seq) OVER (PARTITION BY user_id ORDER BY seq) AS b FROM s WHERE event_id % 4 <> 0)
SELECT user_id, b + 1 AS gap_from, seq - 1 AS gap_to FROM k WHERE seq - b > 1""")
def sequence_gaps(spark, d):
    from pyspark.sql import Window

    numbered = table(spark, d, "events").withColumn("seq", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long"))
    return ev.gaps(numbered.where("event_id % 4 <> 0"), "user_id", "seq")


@query("SELECT event_id FROM (SELECT event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n IS NULL OR n - ts >= interval 6 hour")
def debounce(spark, d):
    return ev.debounce(events(spark, d), "user_id", "ts", "event_id", "6 hours").select("event_id")


RECENT = "SELECT event_id, count(*) OVER (PARTITION BY {key} ORDER BY epoch_us(ts) RANGE BETWEEN {us} PRECEDING AND CURRENT ROW) AS n FROM events"


@query(f"SELECT event_id, n, n > 2 AS limited FROM ({RECENT.format(key='user_id', us=86_400_000_000)})")
def rate_window(spark, d):
    n = ev.recent_count("user_id", F.col("ts"), 86_400)
    return events(spark, d).select("event_id", n.alias("n")).withColumn("limited", F.col("n") > 2)


@query(f"SELECT event_id, greatest(0, 5 - n) AS budget_left FROM ({RECENT.format(key='user_id, event_type', us=259_200_000_000)})")
def retry_budget(spark, d):
    keyed = events(spark, d).withColumn("pair", F.concat_ws(":", "user_id", "event_type"))
    return keyed.select("event_id", F.greatest(F.lit(0).cast("long"), 5 - ev.recent_count("pair", F.col("ts"), 259_200)).alias("budget_left"))


# Each user's events in order, with a number; a recursion walks them. Users have large keys, and some share none.
WALK = """WITH RECURSIVE u AS (SELECT * REPLACE (CASE WHEN user_id % 50 <> 0 THEN 1152921504606846976 + user_id END AS user_id) FROM events),
e AS (SELECT event_id, user_id, epoch_us(ts) AS us, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nr FROM u),
"""
CAPPED = WALK + """w AS (SELECT user_id, nr, event_id, us AS opened, 1 AS used, true AS admitted FROM e WHERE nr = 1
  UNION ALL SELECT e.user_id, e.nr, e.event_id, CASE WHEN e.us - opened >= {us} THEN e.us ELSE opened END,
    CASE WHEN e.us - opened >= {us} THEN 1 WHEN used < {most} THEN used + 1 ELSE used END, e.us - opened >= {us} OR used < {most}
  FROM w JOIN e ON e.user_id IS NOT DISTINCT FROM w.user_id AND e.nr = w.nr + 1)
"""


def _by_user(spark, d):
    known = F.when(F.col("user_id") % 50 != 0, F.lit(1 << 60) + F.col("user_id"))
    return events(spark, d).withColumn("user_id", known).withColumn("us", F.unix_micros("ts"))


@query(CAPPED.format(us=86_400_000_000, most=2) + "SELECT event_id, user_id, admitted FROM w")
def reingest_cap(spark, d):
    """At most two a day, in a window that a record's first signal opens."""
    return ev.capped(_by_user(spark, d), "user_id", "us", "event_id", 2, 86_400).select("event_id", "user_id", "admitted")


@query("""WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, user_id) AS nr FROM events WHERE event_type = 'purchase'),
""" + CAPPED.removeprefix(WALK).format(us=3_600_000_000, most=1) + "SELECT user_id AS external_id, 'resync_record' AS command, count(*) FILTER (WHERE admitted) AS n, count(*) AS asked FROM w GROUP BY 1")
def resync_commands(spark, d):
    """Commands for conflicts whose resolution is to read again, per record."""
    decided = events(spark, d).select(F.col("user_id").alias("external_id"), F.when(F.col("event_type") == "purchase", "resync").otherwise("write").alias("step"), F.col("ts").alias("at"))
    told = writeback.resync_commands(decided, 1)
    return told.groupBy("external_id", "command").agg(F.count_if("admitted").alias("n"), F.count("*").alias("asked"))


@query(WALK + """w AS (SELECT user_id, nr, event_id, 'closed' AS found, 'closed' AS mode, CASE WHEN event_type <> 'purchase' THEN 1 ELSE 0 END AS fails, 0::BIGINT AS opened, 86400::DOUBLE AS wait FROM e WHERE nr = 1
  UNION ALL SELECT user_id, nr, event_id, found,
    CASE WHEN found = 'open' THEN 'open' WHEN NOT bad THEN 'closed' WHEN found = 'half_open' OR fails + 1 >= 2 THEN 'open' ELSE 'closed' END,
    CASE WHEN found = 'open' THEN fails WHEN NOT bad THEN 0 ELSE fails + 1 END,
    CASE WHEN found <> 'open' AND bad AND (found = 'half_open' OR fails + 1 >= 2) THEN us ELSE opened END,
    CASE WHEN found = 'open' THEN wait WHEN NOT bad THEN 86400 WHEN found = 'half_open' THEN least(wait * 2, 604800) ELSE wait END
  FROM (SELECT e.*, fails, opened, wait, event_type <> 'purchase' AS bad, CASE WHEN mode = 'open' AND us - opened >= wait * 1000000 THEN 'half_open' ELSE mode END AS found
        FROM w JOIN e ON e.user_id IS NOT DISTINCT FROM w.user_id AND e.nr = w.nr + 1))
SELECT event_id, user_id, found AS breaker FROM w""")
def breaker_state(spark, d):
    """Two failures in a row open it for a day, a failed probe for twice as long, up to a week."""
    timed = _by_user(spark, d).withColumn("failed", F.col("event_type") != "purchase")
    return ev.breaker(timed, "user_id", "us", "event_id", "failed", 2, 86_400.0, 2.0, 604_800.0).select("event_id", "user_id", "breaker")


@query("""SELECT DISTINCT event_type AS datatype, CASE WHEN event_id % 50 = 0 THEN 'full_sync' ELSE 'single_record' END AS action, CASE WHEN event_id % 50 <> 0 THEN user_id::VARCHAR END AS external_id FROM events""")
def notification_follow_up(spark, d):
    body = F.when(F.col("event_id") % 50 == 0, F.lit("{}")).otherwise(F.concat(F.lit('{"id":'), F.col("user_id").cast("string"), F.lit("}")))
    return ev.follow_ups(table(spark, d, "events").withColumn("body", body), "event_type", F.col("body"))


@query("""WITH w AS (SELECT user_id, count(*) AS n, max(date_diff('second', ts, timestamp '2024-06-01 00:00:00')) AS age FROM events GROUP BY 1)
SELECT sum(n)::BIGINT AS total_buffered_events, count(*) AS entities_with_buffered_events, max(age) AS max_buffer_age_secs FROM w""")
def buffer_stats(spark, d):
    return ev.buffer_stats(events(spark, d), "user_id", F.date_trunc("second", "ts"), F.lit("2024-06-01 00:00:00").cast("timestamp"))


@query("""SELECT event_id, event_id % 5 NOT IN (1, 2) AND event_id % 700 <= 300 AS valid FROM events""")
def signature_check(spark, d):
    """Signed bodies of which some are tampered with, unsigned or too old."""
    k, body = F.col("event_id"), F.col("props")
    sent = F.lit(1_700_000_000) + k % 700
    good = R.hmac_sha256("secret", F.concat(sent.cast("string"), F.lit("."), body))
    signature = F.when(k % 5 == 0, F.concat(F.lit("sha256="), good)).when(k % 5 == 1, F.md5(body)).when(k % 5 == 3, F.concat(F.lit("v1="), good)).when(k % 5 == 4, good)
    return table(spark, d, "events").select("event_id", R.signature_valid("secret", body, signature, sent_at=sent, now=F.timestamp_seconds(F.lit(1_700_000_000))).alias("valid"))


@query(r"""SELECT event_id, sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode(props)))) AS signature FROM events""".format(outer=bytes(k ^ 0x5C for k in b"secret".ljust(64, b"\0")).hex(), inner=bytes(k ^ 0x36 for k in b"secret".ljust(64, b"\0")).hex()))
def body_signature(spark, d):
    return table(spark, d, "events").select("event_id", R.hmac_sha256("secret", F.col("props")).alias("signature"))


@query("SELECT event_id, sha256(props) AS payload_hash, CASE WHEN event_type = 'purchase' THEN 'upsert' ELSE 'ignore' END AS action, 'processed' AS status FROM events")
def webhook_log(spark, d):
    action = F.when(F.col("event_type") == "purchase", "upsert").otherwise("ignore")
    return table(spark, d, "events").select("event_id", F.sha2("props", 256).alias("payload_hash"), action.alias("action"), F.lit("processed").alias("status"))
