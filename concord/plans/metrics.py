"""Queries of metrics and alerts over runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics
from .registry import query, table

BOUNDS = [5.0, 25.0, 50.0, 100.0]
HISTOGRAM = """WITH b(le) AS (VALUES (5.0::DOUBLE), (25.0), (50.0), (100.0), ('infinity'::DOUBLE)),
h AS (SELECT event_type, le, count(*) FILTER (WHERE value <= le) AS n FROM events, b WHERE value IS NOT NULL GROUP BY ALL)
"""


def _buckets(spark, d):
    return metrics.histogram(table(spark, d, "events"), F.col("value"), BOUNDS, ["event_type"])


@query(HISTOGRAM + "SELECT event_type, le, n FROM h")
def metric_histogram(spark, d):
    return _buckets(spark, d)


@query(HISTOGRAM + """, s AS (SELECT *, coalesce(lag(le) OVER w, 0) AS lo, coalesce(lag(n) OVER w, 0) AS b, 0.9 * max(n) OVER (PARTITION BY event_type) AS r FROM h WINDOW w AS (PARTITION BY event_type ORDER BY le)),
f AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY le) AS nr FROM s WHERE n >= r)
SELECT event_type, round(CASE WHEN le = 'infinity' THEN lo ELSE lo + (le - lo) * (r - b) / (n - b) END, 6) AS quantile FROM f WHERE nr = 1""")
def metric_quantile(spark, d):
    return metrics.quantile(_buckets(spark, d), 0.9, ["event_type"]).withColumn("quantile", F.round("quantile", 6))


# A counter per event type that starts again at every hundredth event.
SAMPLES = """WITH s AS (SELECT event_type, ts, event_id % 100 AS counter FROM events), g AS (
  SELECT *, lag(counter) OVER (PARTITION BY event_type ORDER BY ts) AS b FROM s)
"""


@query(SAMPLES + """SELECT event_type, sum(CASE WHEN b IS NULL THEN 0 WHEN counter < b THEN counter ELSE counter - b END)::BIGINT AS increase,
  round(sum(CASE WHEN b IS NULL THEN 0 WHEN counter < b THEN counter ELSE counter - b END) * 1e6 / nullif(max(epoch_us(ts)) - min(epoch_us(ts)), 0), 6) AS rate FROM g GROUP BY 1""")
def metric_rate(spark, d):
    s = table(spark, d, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 100).alias("counter"))
    return metrics.increase(s, ["event_type"], "ts", "counter").withColumn("rate", F.round("rate", 6))


@query("""WITH m AS (SELECT user_id % 40 AS connector, ts, value FROM events), l AS (
  SELECT connector, 'high' AS alert, 'critical' AS severity, 0 AS hold, value > 40 AS breach, ts FROM m UNION ALL
  SELECT connector, 'low', 'warning', 3600, coalesce(value < 30, false), ts FROM m),
c AS (SELECT *, max(ts) FILTER (WHERE NOT coalesce(breach, false)) OVER (PARTITION BY connector, alert) AS calm, max(ts) OVER (PARTITION BY connector, alert) AS now FROM l)
SELECT alert, severity, connector, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS since FROM c WHERE breach AND (calm IS NULL OR ts > calm)
GROUP BY alert, severity, connector, hold, now HAVING date_diff('second', min(ts), now) >= hold""")
def metric_alerts(spark, d):
    """Two rules over one metric of forty connectors: above 40 at once, below 30 for an hour."""
    e = table(spark, d, "events")
    samples = e.select((F.col("user_id") % 40).alias("connector"), F.lit("depth").alias("metric"), F.col("ts").cast("timestamp").alias("ts"), "value")
    rules = [metrics.Alert("high", "depth", 40.0, severity="critical"), metrics.Alert("low", "depth", 30.0, above=False, hold_seconds=3600)]
    return metrics.alerts(samples, rules, ["connector"], "ts").withColumn("since", F.date_format("since", "yyyy-MM-dd HH:mm:ss"))


@query("""WITH s AS (SELECT event_type, epoch_us(ts) AS us, event_id % 100 AS n, lag(epoch_us(ts)) OVER w AS before, lag(event_id % 100) OVER w AS was FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id % 100)),
t AS (SELECT unnest(range((SELECT min(us) // 10800000000 FROM s), (SELECT max(us) // 10800000000 + 4 FROM s))) AS k)
SELECT event_type, strftime(make_timestamp(k * 10800000000), '%Y-%m-%d %H:%M:%S') AS step, count(*) AS samples,
  coalesce(sum(CASE WHEN n < was THEN n ELSE n - was END) FILTER (WHERE before > k * 10800000000 - 21600000000), 0)::BIGINT AS increase,
  round(coalesce(sum(CASE WHEN n < was THEN n ELSE n - was END) FILTER (WHERE before > k * 10800000000 - 21600000000), 0) * 1e6 / nullif(max(us) - min(us), 0), 6) AS rate
FROM s JOIN t ON us <= k * 10800000000 AND us > k * 10800000000 - 21600000000 GROUP BY ALL""")
def metric_range(spark, d):
    """Growth and rate every three hours over the last six."""
    s = table(spark, d, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 100).alias("counter"))
    found = metrics.over_time(s, ["event_type"], "ts", "counter", 10_800, 21_600)
    return found.select("event_type", F.date_format("step", "yyyy-MM-dd HH:mm:ss").alias("step"), "samples", "increase", F.round("rate", 6).alias("rate"))


@query("SELECT event_type, user_id % 5 AS shard, sum(event_id % 7)::BIGINT AS total FROM events GROUP BY ALL")
def metric_counters(spark, d):
    e = table(spark, d, "events").select("event_type", (F.col("user_id") % 5).alias("shard"), (F.col("event_id") % 7).alias("n"))
    return metrics.counters(e, ["event_type", "shard"], "n")


@query("SELECT user_id, arg_max(value, (ts, value)) AS value, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS set_at FROM events WHERE value IS NOT NULL GROUP BY 1")
def metric_gauges(spark, d):
    found = metrics.gauges(table(spark, d, "events").select("user_id", "ts", "value"), ["user_id"], "ts", "value")
    return found.select("user_id", "value", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("set_at"))
