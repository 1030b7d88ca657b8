"""Event rules in batch form; ``concord.streaming`` has their streaming counterparts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def route(events: DataFrame, field: str, routes: list[tuple[str, str, str]]) -> DataFrame:
    """``events`` with the datatype of the first route (equals, prefix or glob) that matches, null where none does."""
    from ..functions.records import matches_glob

    value, made = F.col(field), F.lit(None).cast("string")
    for kind, text, datatype in reversed(routes):
        hit = {"equals": lambda t: value == t, "prefix": lambda t: value.startswith(t), "glob": lambda t: matches_glob(value, t)}[kind](text)
        made = F.when(hit, datatype).otherwise(made)
    return events.withColumn("datatype", made)


def routed(events: DataFrame, field: str, routes: DataFrame) -> DataFrame:
    """``events`` with the datatype of the first route that matches, null where none does; any number of routes.

    routes: (kind, text, datatype, place), where kind is equals or prefix and the least place wins, ties by datatype. Every distinct value
    meets the routes by equal keys, once whole and once for each length that prefixes have, so no pair of all values and routes is formed.
    The lengths are the only thing that reaches the driver. A null value has no route, and routes with a null are ignored.
    """
    usable = routes.where("kind in ('equals', 'prefix') and text is not null and datatype is not null and place is not null")
    best = usable.groupBy("kind", "text").agg(F.min(F.struct("place", "datatype")).alias("route"))
    lengths = sorted(r[0] for r in usable.where("kind = 'prefix'").select(F.length("text")).distinct().collect())
    value = F.col("__value")
    cuts = [F.when(F.length(value) >= n, F.struct(F.lit("prefix").alias("kind"), F.substring(value, 1, n).alias("text"))) for n in lengths]
    asked = F.array_compact(F.array(F.struct(F.lit("equals").alias("kind"), value.alias("text")), *cuts))
    values = events.select(F.col(field).alias("__value")).where("__value is not null").distinct()
    met = values.select("__value", F.inline(asked)).join(best, ["kind", "text"])
    chosen = met.groupBy("__value").agg(F.min("route").alias("__route"))
    return events.drop("datatype").join(chosen, F.col(field) == F.col("__value"), "left").withColumn("datatype", F.col("__route.datatype")).drop("__value", "__route")


def stale(events: DataFrame, key: str, order: str, sequence: str) -> DataFrame:
    """``events`` with ``stale``: the sequence does not exceed all earlier ones of the key."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return events.withColumn("stale", F.coalesce(F.col(sequence) <= F.max(sequence).over(before), F.lit(False)))


def gaps(events: DataFrame, key: str, sequence: str) -> DataFrame:
    """(key, gap_from, gap_to): sequence numbers that never came, per key."""
    w = Window.partitionBy(key).orderBy(sequence)
    last = events.select(key, sequence).distinct().withColumn("__before", F.lag(sequence).over(w))
    return last.where(F.col(sequence) - F.col("__before") > 1).select(key, (F.col("__before") + 1).alias("gap_from"), (F.col(sequence) - 1).alias("gap_to"))


def debounce(events: DataFrame, key: str, at: str, order: str, quiet: str) -> DataFrame:
    """Events that no other event of their key follows within the quiet time."""
    following = F.lead(at).over(Window.partitionBy(key).orderBy(at, order))
    return events.withColumn("__next", following).where(F.col("__next").isNull() | (F.col("__next") - F.col(at) >= F.expr(f"interval {quiet}"))).drop("__next")


def recent_count(key: str, at: Column, span_seconds: int) -> Column:
    """Events of the key in the span that ends with this one."""
    return F.count("*").over(Window.partitionBy(key).orderBy(F.unix_micros(at)).rangeBetween(-span_seconds * 1_000_000, 0))


def failures_in_a_row(key: str, order: list[str], failed: Column) -> Column:
    """Number of failures since the last success, this event included."""
    w = Window.partitionBy(key).orderBy(*order)
    island = F.sum(F.when(failed, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return island


def folded(events: DataFrame, key: str, order: list[str], inputs: list[str], result: str, begin: Callable[[], Any], step: Callable[..., tuple[Any, Any]]) -> DataFrame:
    """``events`` with a column ``result`` ("name type"): a fold over each key's events in order, one value per event.

    ``step(state, *inputs)`` gives the next state and the value. Partitions are sorted and read as a stream, and only the state of
    the key at hand is kept, so a key may have any number of events; they are folded in one task, as each step needs the last.
    Events without a key are one key. All columns pass through as they are.
    """
    made = T.StructType.fromDDL(result)
    kind = to_arrow_schema(made).field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = object(), None
        for batch in batches:
            values = []
            for k, *given in zip(*(batch.column(c).to_pylist() for c in (key, *inputs))):
                if k != last and not (k != k and last != last):  # null is one key, and so is NaN
                    last, state = k, begin()
                state, value = step(state, *given)
                values.append(value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, kind)], names=[*batch.schema.names, made[0].name])

    dealt = events.repartition(key).sortWithinPartitions(key, *order)
    return dealt.mapInArrow(run, T.StructType([*events.schema.fields, *made.fields]))


def capped(events: DataFrame, key: str, micros: str, order: str, most: int, seconds: int = 3600) -> DataFrame:
    """``events`` with ``admitted``: at most ``most`` of a key in a window that its first event opens; the first event
    ``seconds`` or more later opens the next. Refused events don't count. ``micros`` is a time in microseconds."""

    def step(state, at):
        opened, used = state
        if opened is None or at - opened >= seconds * 1_000_000:
            opened, used = at, 0
        return ((opened, used + 1), True) if used < most else ((opened, used), False)

    return folded(events, key, [micros, order], [micros], "admitted boolean", lambda: (None, 0), step)


def breaker(attempts: DataFrame, key: str, micros: str, order: str, failed: str, threshold: int = 5, recovery: float = 60.0, factor: float = 2.0, longest: float = 3600.0) -> DataFrame:
    """``attempts`` with ``breaker``: closed, half_open or open as each attempt finds it; attempts that find it open do not run.

    ``threshold`` failures in a row open it. After the recovery time the next attempt is let through as a probe: its success
    closes the breaker and resets everything, its failure opens it again for ``factor`` times as long, up to ``longest`` seconds.
    """

    def step(state, at, bad):
        mode, failures, opened, wait = state
        if mode == "open" and at - opened >= wait * 1_000_000:
            mode = "half_open"
        found = mode
        if mode == "open":
            pass
        elif not bad:
            mode, failures, opened, wait = "closed", 0, None, recovery
        elif mode == "half_open":
            mode, failures, opened, wait = "open", failures + 1, at, min(wait * factor, longest)
        else:
            failures += 1
            if failures >= threshold:
                mode, opened = "open", at
        return (mode, failures, opened, wait), found

    return folded(attempts, key, [micros, order], [micros, failed], "breaker string", lambda: ("closed", 0, None, recovery), step)


def follow_ups(notices: DataFrame, datatype: str, payload: Column, field: str = "id") -> DataFrame:
    """(datatype, action, external_id), each once: what bare notifications ask for. One with an id fetches that record, one
    without asks for a full sync."""
    from ..functions.records import dot_path

    asked = notices.select(F.col(datatype).alias("datatype"), dot_path(payload, field).alias("external_id"))
    return asked.select("datatype", F.when(F.col("external_id").isNull(), "full_sync").otherwise("single_record").alias("action"), "external_id").distinct()


def buffer_stats(waiting: DataFrame, key: str, at: Column, now: Column) -> DataFrame:
    """(total_buffered_events, entities_with_buffered_events, max_buffer_age_secs) of events that wait for their turn."""
    age = F.coalesce(F.max(F.unix_seconds(now) - F.unix_seconds(at)), F.lit(0))
    per_key = waiting.groupBy(key).agg(F.count("*").alias("n"), age.alias("age"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_buffered_events"), F.count("*").alias("entities_with_buffered_events"), F.coalesce(F.max("age"), F.lit(0)).alias("max_buffer_age_secs"))
