"""Metrics as frames: histograms, quantiles, rates and alerts over samples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(samples: DataFrame, value: Column, bounds: list[float], labels: list[str]) -> DataFrame:
    """(labels, le, n) with cumulative counts for each bound and infinity; nulls are left out. One aggregate, then as many rows as bounds."""
    edges = [*bounds, float("inf")]
    counts = samples.where(value.isNotNull()).groupBy(*labels).agg(*[F.count_if(value <= b).alias(f"__{i}") for i, b in enumerate(edges)])
    listed = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(f"__{i}").alias("n")) for i, b in enumerate(edges)])
    return counts.select(*labels, F.inline(listed))


def quantile(buckets: DataFrame, q: float, labels: list[str]) -> DataFrame:
    """(labels, quantile) from cumulative buckets, linear within a bucket; beyond the last bound it is that bound, null without samples."""
    w = Window.partitionBy(*labels).orderBy("le")
    steps = buckets.select(*labels, "le", "n", F.coalesce(F.lag("le").over(w), F.lit(0.0)).alias("lo"), F.coalesce(F.lag("n").over(w), F.lit(0)).alias("before"), F.max("n").over(Window.partitionBy(*labels)).alias("total"))
    rank = F.lit(q) * F.col("total")
    inside = F.when(F.col("le") == float("inf"), F.col("lo")).otherwise(F.col("lo") + (F.col("le") - F.col("lo")) * (rank - F.col("before")) / (F.col("n") - F.col("before")))
    return steps.groupBy(*labels).agg(F.min_by(F.when(F.col("total") > 0, inside), F.when(F.col("n") >= rank, F.col("le"))).alias("quantile"))


def increase(samples: DataFrame, labels: list[str], at: str, counter: str) -> DataFrame:
    """(labels, increase, rate) of a counter over its samples; a fall is a restart from zero. rate is per second, null for one sample."""
    w = Window.partitionBy(*labels).orderBy(at)
    before = F.lag(counter).over(w)
    grown = samples.withColumn("__up", F.when(before.isNull(), 0).when(F.col(counter) < before, F.col(counter)).otherwise(F.col(counter) - before))
    span = F.unix_micros(F.max(at)) - F.unix_micros(F.min(at))
    return grown.groupBy(*labels).agg(F.sum("__up").alias("increase"), F.when(span > 0, F.sum("__up") * 1e6 / span).alias("rate"))


def over_time(samples: DataFrame, labels: list[str], at: str, counter: str, step_seconds: int, span_seconds: int) -> DataFrame:
    """(labels, step, samples, increase, rate) of a counter at every step whose span (step - span, step] holds samples.

    Steps are multiples of ``step_seconds`` since 1970. A growth counts where both its samples lie in the span; a fall is a restart from zero.
    rate is per second between the first and the last sample of the span, null for one sample. Each sample is sent to the
    span_seconds / step_seconds steps that hold it, so steps meet samples by equal keys; series that end give no more steps.
    """
    w = Window.partitionBy(*labels).orderBy(at, counter)
    micros = F.unix_micros(at)
    paired = samples.select(*labels, micros.alias("__at"), F.col(counter).alias("__now"), F.lag(micros).over(w).alias("__before"), F.lag(counter).over(w).alias("__was"))
    step, span = step_seconds * 1_000_000, span_seconds * 1_000_000
    first = F.expr(f"-((-__at - pmod(-__at, {step}L)) div {step}L)")  # the first step at or after the sample
    after = F.expr(f"-((-(__at + {span}L) - pmod(-(__at + {span}L), {step}L)) div {step}L)")  # the first one whose span is past it
    held = paired.withColumn("__step", F.explode(F.sequence(first, after - 1))).where("__step * " + str(step) + "L >= __at") if span >= step else paired.where(first < after).withColumn("__step", first)
    both = F.col("__before") > F.col("__step") * step - span
    growth = F.when(F.col("__now") < F.col("__was"), F.col("__now")).otherwise(F.col("__now") - F.col("__was"))
    width = F.max("__at") - F.min("__at")
    sums = held.groupBy(*labels, "__step").agg(F.count("*").alias("samples"), F.coalesce(F.sum(F.when(both, growth)), F.lit(0)).alias("increase"), width.alias("__width"))
    rate = F.when(F.col("__width") > 0, F.col("increase") * 1e6 / F.col("__width"))
    return sums.select(*labels, F.timestamp_micros(F.col("__step") * step).alias("step"), "samples", "increase", rate.alias("rate"))


def counters(samples: DataFrame, labels: list[str], value: str) -> DataFrame:
    """(labels, total): counters from their increments; nulls count nothing."""
    return samples.groupBy(*labels).agg(F.coalesce(F.sum(value), F.lit(0)).alias("total"))


def gauges(samples: DataFrame, labels: list[str], at: str, value: str) -> DataFrame:
    """(labels, value, at): the newest value of each gauge, the larger one of two at the same time; nulls set nothing."""
    set_ = samples.where(F.col(value).isNotNull()).groupBy(*labels).agg(F.max(F.struct(at, value)).alias("r"))
    return set_.select(*labels, F.col(f"r.{value}").alias("value"), F.col(f"r.{at}").alias("at"))


@dataclass(frozen=True)
class Alert:
    """Fires once ``metric`` has been above (or below) the threshold in all samples for ``hold_seconds``."""

    name: str
    metric: str
    threshold: float
    above: bool = True
    hold_seconds: int = 0
    severity: str = "warning"


def alerts(samples: DataFrame, rules: list[Alert], labels: list[str], at: str) -> DataFrame:
    """(alert, severity, labels, since) of alerts that fire at each series' last sample. samples: labels, metric, at, value."""
    table = samples.sparkSession.createDataFrame([(r.name, r.metric, float(r.threshold), r.above, r.hold_seconds, r.severity) for r in rules], "alert string, metric string, threshold double, above boolean, hold int, severity string")
    met = samples.join(F.broadcast(table), "metric")  # one row per rule
    breach = F.when(F.col("above"), F.col("value") > F.col("threshold")).otherwise(F.col("value") < F.col("threshold"))
    keys = ["alert", "severity", *labels]
    marked = met.withColumn("__breach", F.coalesce(breach, F.lit(False)))
    calm = marked.groupBy(*keys).agg(F.max(F.when(~F.col("__breach"), F.col(at))).alias("calm"))
    joined = marked.join(calm.withColumnsRenamed({k: f"__{k}" for k in keys}), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    broken = F.col("__breach") & (F.col("calm").isNull() | (F.col(at) > F.col("calm")))
    last = joined.groupBy(*keys, "hold").agg(F.max(at).alias("now"), F.min(F.when(broken, F.col(at))).alias("since"))
    firing = last.where(F.col("since").isNotNull() & (F.unix_seconds("now") - F.unix_seconds("since") >= F.col("hold")))
    return firing.select(*keys, "since")
