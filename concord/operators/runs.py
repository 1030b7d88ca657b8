"""The log of sync runs and the watermarks they leave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import merge

COUNTERS = ["fetched", "inserted", "updated", "deleted", "errored"]


def started(runs: DataFrame, new: DataFrame) -> DataFrame:
    """The log with new runs (run_id, connector, datatype, started_at, watermark_before) as running, their counters zero."""
    rows = new.select("run_id", "connector", "datatype", F.lit("running").alias("status"), "started_at", "watermark_before", *[F.lit(0).cast("long").alias(c) for c in COUNTERS])
    return runs.unionByName(rows, allowMissingColumns=True)


def finished(runs: DataFrame, results: DataFrame) -> DataFrame:
    """The log with the results (run_id, status, finished_at, watermark_after and counters) of runs that ended.

    Only runs that are still running take a result, and of several results of one run the earliest counts; a result of an unknown run
    is ignored.
    """
    taken = ["status", "finished_at", "watermark_after", *COUNTERS]
    named = results.groupBy("run_id").agg(F.min_by(F.struct(*taken), F.struct("finished_at", *taken)).alias("__end"))
    ends = F.col("__end").isNotNull() & (F.col("status") == "running")
    made = {c: F.when(ends, F.col(f"__end.{c}")).otherwise(F.col(c) if c in runs.columns else F.lit(None)) for c in taken}
    return runs.join(named, "run_id", "left").withColumns(made).drop("__end")


def clear_watermarks(marks: DataFrame, connector: str, datatype: str | None = None, delta_only: frozenset[tuple[str, str]] = frozenset()) -> DataFrame:
    """The watermarks (connector, datatype, ...) without those of a connector, or of one datatype of it.

    A single datatype that only ever gives deltas is refused: without full snapshots a reset would lose data.
    """
    if datatype is not None and (connector, datatype) in delta_only:
        raise ValueError(f"{connector}/{datatype} gives only deltas: its watermark can't be reset")
    hit = F.col("connector") == connector
    return marks.where(~(hit if datatype is None else hit & (F.col("datatype") == datatype)))


def point_sync(current: DataFrame, fetched: DataFrame) -> DataFrame:
    """The snapshot after a single record was fetched; none found (an empty ``fetched``) changes nothing."""
    return merge.apply(fetched, current)


RETENTION = {"sync_run": 90, "dead_letter": 30, "history": 365, "webhook_route_seq": 7, "writeback_result": 30, "writeback_dead_letter": 30, "desired_state": 90}
#: The time by which each class ages, and whether rows of it are kept for a day whatever its window, or only go once they have that time.
AGES_BY = {"sync_run": "finished_at", "dead_letter": "failed_at", "history": "_ingested_at", "webhook_route_seq": "updated_at", "writeback_result": "processed_at", "writeback_dead_letter": "failed_at", "desired_state": "_processed_at"}


def retained(rows: DataFrame, kind: str, now: Column, days: dict[str, int] = RETENTION) -> DataFrame:
    """What a retention purge leaves of a table of one class: rows younger than its window, and rows without the time it ages by.

    So runs that have not finished and desired rows that are not processed stay. Results of writes stay for a day at least, as a run that
    starts again finds out from them what is written already.
    """
    if kind not in AGES_BY:
        raise ValueError(f"no class {kind!r}: {', '.join(AGES_BY)}")
    window = max(days[kind], 1) if kind == "writeback_result" else days[kind]
    return rows.where(F.coalesce(F.col(AGES_BY[kind]) >= now - F.make_dt_interval(F.lit(window)), F.lit(True)))


def health_scores(runs: DataFrame, pairs: DataFrame, window: int = 10) -> DataFrame:
    """(connector, datatype, score) of all ``pairs``: the share of completed ones of the last ``window`` runs that ended, to 4 digits.

    Newest first by finished_at, those without it last, ties by the larger id. Pairs without such a run score 1.
    """
    keys = ["connector", "datatype"]
    last = merge.newest(runs.where("status <> 'running'"), keys, [F.col("finished_at").desc_nulls_last(), F.desc("id")], window)
    found = last.groupBy(*keys).agg(F.round(F.avg((F.col("status") == "completed").cast("double")), 4).alias("score"))
    return pairs.select(*keys).distinct().join(found, keys, "left").withColumn("score", F.coalesce("score", F.lit(1.0)))


def resumable(checkpoints: DataFrame, runs: DataFrame, pair: list[str]) -> DataFrame:
    """The newest checkpoint (``pair``, run_id, ...) of each pair whose run is still running."""
    open_ = checkpoints.join(runs.where("status = 'running'").select("run_id"), "run_id", "left_semi")
    rest = [c for c in checkpoints.columns if c not in pair]
    return open_.groupBy(*pair).agg(F.max_by(F.struct(*rest), "run_id").alias("r")).select(*pair, "r.*")


def shrunk(runs: DataFrame, keys: list[str], order: str, count: str, most: float) -> DataFrame:
    """``runs`` that have a predecessor, with its count (``before``), the share by which they shrank, and ``alarmed`` above ``most``.

    A predecessor without records gives no share and no alarm.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    p = runs.withColumn("before", F.lag(count).over(w)).where("before is not null")
    share = F.when(F.col("before") > 0, (F.col("before") - F.col(count)) / F.col("before"))
    return p.withColumn("shrink", F.round(share, 4)).withColumn("alarmed", F.coalesce(share > most, F.lit(False)))


def drift_share(sample: DataFrame, stored: str, found: str) -> DataFrame:
    """(sampled, drifted, share) of records whose stored content hash is not the found one; null equals null."""
    drifted = F.count_if(~F.col(stored).eqNullSafe(F.col(found)))
    return sample.agg(F.count("*").alias("sampled"), drifted.alias("drifted"), F.when(F.count("*") > 0, F.round(drifted / F.count("*"), 4)).alias("share"))


def late(wanted: DataFrame, runs: DataFrame, keys: list[str], now: Column, most: str) -> DataFrame:
    """``wanted`` keys with the end of their last completed run and ``violated``: it ended longer ago than ``most``, or there is none."""
    last = runs.where("status = 'completed'").groupBy(*keys).agg(F.max("finished_at").alias("at"))
    over = F.col("at").isNull() | (F.col("at") < now - F.expr(f"interval {most}"))
    return wanted.join(last, keys, "left").withColumn("violated", over)
