"""Event rules on Structured Streaming: deduplication, newest-state, reordering, debouncing and change batches.

Each function takes a streaming DataFrame and returns one; ``apply_changes`` is the body of a ``foreachBatch`` sink.
State is kept per key by Spark, so it is partitioned, checkpointed and restored like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import merge
from ..sources.staging import staged, unstaged
from .stateful import Newest, Reorder, processed


def deduplicated(events: DataFrame, key: list[str], at: str, ttl: str = "24 hours") -> DataFrame:
    """The first event of each key; a key is forgotten ``ttl`` after its event, by event time."""
    return events.withWatermark(at, ttl).dropDuplicatesWithinWatermark(key)


def unwrapped(events: DataFrame, payload: str, schema: str) -> DataFrame:
    """One row per item where the payload is a JSON list, and one where it is a single object."""
    text = F.trim(payload)
    listed = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    return events.withColumn("item", F.explode(F.from_json(listed, f"array<{schema}>")))


def marked_deletes(events: DataFrame, payload: str, is_delete: str) -> DataFrame:
    """``events`` with ``_deleted``: true in the payloads of delete events, in place of a value that is there.

    A delete event whose payload is missing or no object has ``{"_deleted":true}`` only.
    """
    entries = F.map_filter(F.coalesce(F.try_variant_get(F.try_parse_json(payload), "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")), lambda k, _: k != "_deleted")
    marked = F.to_json(F.map_concat(entries, F.create_map(F.lit("_deleted"), F.lit(True).cast("variant"))))
    return events.withColumn(payload, F.when(F.col(is_delete), marked).otherwise(F.col(payload)))


def newest_only(events: DataFrame, key: str, order: str, at: str, late: str = "1 hour", ttl_seconds: int = 86_400) -> DataFrame:
    """``events`` without stale ones: an event whose order does not exceed all earlier ones of its key.

    ``order`` is a long (a sequence or a timestamp in microseconds). Within one batch the events of a key are
    taken by order, so only the batch's boundaries depend on arrival. By the event time ``at``, events that come more than
    ``late`` behind the newest are dropped, and a key is forgotten ``ttl_seconds`` after its last event.
    """
    timed = events.withWatermark(at, late).withColumn("__ms", F.unix_millis(at))
    return processed(timed, key, Newest(order, events.columns, 1000 * ttl_seconds), events.schema)


def reordered(events: DataFrame, key: str, sequence: str, payload: str, at: str, most: int = 100, timeout_ms: int = 30_000, start: int = 0, late: str = "1 hour", ttl_seconds: int = 86_400) -> DataFrame:
    """(key, sequence, payload) released in order of sequence, per key.

    An event that is next in turn is released with all that follow it without a gap; one behind the turn is dropped; one
    ahead waits, as one entry of the key's state. When ``most`` events wait, or ``timeout_ms`` (by the column ``at``) have passed since the first
    that waits, all that wait are released in order and the turn goes on behind the last. A timeout shows when the
    key's next event ahead comes, or when the watermark, ``late`` behind the newest event of all keys, passes it. State holds
    fewer than ``most`` events per key; a key without waiting events is forgotten ``ttl_seconds`` after its last event.
    """
    timed = events.withWatermark(at, late)
    rows = timed.select(key, F.col(sequence).cast("long").alias(sequence), F.col(payload).cast("string").alias(payload), F.unix_millis(at).alias("__ms"), at)
    schema = rows.select(key, sequence, payload).schema
    return processed(rows, key, Reorder([key, sequence, payload], most, timeout_ms, start, 1000 * ttl_seconds), schema)


def debounced(events: DataFrame, key: str, at: str, payload: str, quiet: str, late: str = "0 seconds") -> DataFrame:
    """(key, payload, first_at, last_at, n): the last payload of each run of events, once no other came for ``quiet``."""
    session = F.session_window(at, quiet)
    runs = events.withWatermark(at, late).groupBy(key, session).agg(F.max_by(payload, at).alias(payload), F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count("*").alias("n"))
    return runs.drop("session_window")


def change_sink(
    prepare: Callable[[DataFrame], tuple[DataFrame, DataFrame]], read_state: Callable[[], DataFrame], write: Callable[[dict[str, DataFrame], int], None], run_id: str, keep: str = "first"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body for change records: prepare, merge, hand over.

    ``prepare`` maps, normalises, checks and keys a batch: it gives records (external_id, seq, op, data, _raw_hash) and rejects.
    ``write`` gets the frames of ``merge.change_batch`` (state, history, watermark, rejects) and the batch's number, with which it
    can tell a repeated batch. The frames are written before ``write`` gets them, so it may replace the state in any order. For a table
    that is merged in place see ``concord.sources.snapshots.snapshot_sink``.
    """

    def body(batch: DataFrame, number: int) -> None:
        good, bad = prepare(batch)
        out = merge.change_batch(good, read_state(), "seq", f"{run_id}-{number}", keep)
        frames = out | {"rejects": out["rejects"].unionByName(bad, allowMissingColumns=True)}
        frames = {name: staged(frame, f"change-{name}") for name, frame in frames.items()}
        write(frames, number)
        for frame in frames.values():
            unstaged(frame)

    return body


def apply_changes(read_state: Callable[[], DataFrame], write_state: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body: changes (external_id, seq, op, data, _raw_hash) merged into a snapshot.

    The last change of a key in the batch counts; DELETE tombstones a known key, all else upserts. ``write_state`` gets the
    new snapshot and the batch's number, with which it can tell a repeated batch.
    """

    def body(batch: DataFrame, number: int) -> None:
        last = merge.latest_change(batch, "external_id", "seq", ["op", "data", "_raw_hash"])
        current = read_state()
        upserted = merge.apply(last.where("op <> 'DELETE'").select("external_id", "data", "_raw_hash"), current)
        write_state(merge.tombstone(upserted, last.where("op = 'DELETE'")), number)

    return body
