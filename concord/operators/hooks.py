"""User code in a sync: hooks on whole frames, record functions inside tasks, and dead-letter policies."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_REQUEUES = 3


@dataclass(frozen=True)
class Hooks:
    """Run in this order: ``transform``, ``keep`` (rows for which it is true stay), ``enrich``. Each is optional."""

    transform: Callable[[DataFrame], DataFrame] | None = None
    keep: Callable[[DataFrame], Column] | None = None
    enrich: Callable[[DataFrame], DataFrame] | None = None


def apply_hooks(rows: DataFrame, hooks: Hooks) -> DataFrame:
    """``rows`` after the hooks; a filter that gives null drops the row."""
    if hooks.transform:
        rows = hooks.transform(rows)
    if hooks.keep:
        rows = rows.where(F.coalesce(hooks.keep(rows), F.lit(False)))
    return hooks.enrich(rows) if hooks.enrich else rows


def record_hook(rows: DataFrame, payload: str, function: Callable[[dict], dict | None]) -> DataFrame:
    """``rows`` with ``result`` (JSON) and ``outcome``: upserted, dropped (the function gave None) or failed (it raised).

    A payload that is no JSON object comes to the function as {"_raw": text}, a missing one as {}. Columns of ``rows`` pass through as
    they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results, outcomes = [], []
            for text in batch.column(payload).to_pylist():
                try:
                    record = json.loads(text) if text is not None else {}
                except ValueError:
                    record = {"_raw": text}
                try:
                    made = function(record if isinstance(record, dict) else {"_raw": text})
                    results.append(None if made is None else json.dumps(made, separators=(",", ":"), ensure_ascii=False))
                    outcomes.append("dropped" if made is None else "upserted")
                except Exception:  # the user's code may raise anything; the row says so
                    results.append(None)
                    outcomes.append("failed")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(results, pa.string()), pa.array(outcomes, pa.string())], names=[*batch.schema.names, "result", "outcome"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("result", T.StringType()), T.StructField("outcome", T.StringType())]))


def reprocessed(letters: DataFrame, function: Callable[[dict], dict | None]) -> tuple[DataFrame, DataFrame]:
    """Dead letters (id, external_id, raw, requeue_count) after a record function: (records to upsert, letters as they are now).

    Only failed letters keep their count.
    """
    done = record_hook(letters, "raw", function)
    upserts = done.where("outcome = 'upserted'").select(F.coalesce("external_id", F.col("id").cast("string")).alias("external_id"), F.col("result").alias("data"), F.lit("dl_reprocessed").alias("_raw_hash"))
    count = F.col("requeue_count") + F.when(F.col("outcome") == "failed", 0).otherwise(1)
    return upserts, done.withColumn("requeue_count", count).select(*letters.columns, "outcome")


class Policy(Protocol):
    """Column rules of a connector over the columns of its failures and dead letters."""

    def should_dead_letter(self, rows: DataFrame) -> Column: ...

    def should_replay(self, rows: DataFrame) -> Column: ...


class DefaultPolicy:
    """Every failure becomes a dead letter; a letter is replayed up to MOST_REQUEUES times."""

    def should_dead_letter(self, rows: DataFrame) -> Column:
        return F.lit(True)

    def should_replay(self, rows: DataFrame) -> Column:
        return F.col("requeue_count") < MOST_REQUEUES


def _by_policy(rows: DataFrame, policies: dict[str, Policy], rule: str, default: Policy) -> Column:
    chosen = getattr(default, rule)(rows)
    for connector, policy in policies.items():
        chosen = F.when(F.col("connector") == connector, getattr(policy, rule)(rows)).otherwise(chosen)
    return F.coalesce(chosen, F.lit(False))


def dead_lettered(failures: DataFrame, policies: dict[str, Policy], default: Policy = DefaultPolicy()) -> DataFrame:
    """The failures (with ``connector``) that their connector's policy sends to the dead letters."""
    return failures.where(_by_policy(failures, policies, "should_dead_letter", default))


def replayed(letters: DataFrame, policies: dict[str, Policy], default: Policy = DefaultPolicy()) -> DataFrame:
    """``letters`` (with ``connector`` and requeue_count) with ``_status`` pending and one more try where their policy allows
    a replay, failed where not."""
    again = _by_policy(letters, policies, "should_replay", default)
    return letters.withColumn("_status", F.when(again, "pending").otherwise("failed")).withColumn("requeue_count", F.col("requeue_count") + again.cast("int"))


def requeue(letters: DataFrame, current: DataFrame, most: int = MOST_REQUEUES) -> tuple[DataFrame, DataFrame]:
    """(snapshot, letters): eligible dead letters (external_id, raw, requeue_count) upserted into the snapshot and counted once more.

    Of several letters of one record the one with the largest ``id`` counts for the snapshot.
    """
    from ..functions.records import content_hash
    from . import merge

    fit = F.col("external_id").isNotNull() & (F.col("requeue_count") < most)
    newest = merge.latest_change(letters.where(fit), "external_id", "id", ["raw"])
    incoming = newest.select("external_id", F.col("raw").alias("data"), content_hash(F.col("raw")).alias("_raw_hash"))
    return merge.apply(incoming, current), letters.withColumn("requeue_count", F.col("requeue_count") + fit.cast("int"))
