"""Control commands applied to the tables that they concern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import merge

MOST = 20
RESETS = ("force_full_sync", "reset-watermark")
PAUSES = {"pause_connector": True, "resume_connector": False}
# The commands that are understood.
KNOWN = (*RESETS, *PAUSES, "requeue_dead_letter", "reload-config", "reset-circuit-breaker", "resync", "trigger-writeback", "validate", "drain", "rotate-credential", "gdpr-purge")


def due(commands: DataFrame, tool: str | None = None, most: int = MOST) -> DataFrame:
    """The oldest pending commands (id, connector, datatype, command, payload, target_tool, status, issued_at), at most ``most``.

    With ``tool``, those for it or for any tool. Ties by id.
    """
    rows = commands.where("status = 'pending'")
    if tool is not None:
        rows = rows.where(F.col("target_tool").isNull() | (F.col("target_tool") == tool))
    return rows.orderBy("issued_at", "id").limit(most)


def dispatched(commands: DataFrame, taken: DataFrame) -> DataFrame:
    """``commands`` after a dispatch: taken ones are completed, or failed with an error where nobody knows the command."""
    ids = taken.select("id", F.lit(True).alias("__taken"))
    known = F.coalesce(F.col("command").isin(*KNOWN), F.lit(False))
    met = commands.drop("error").join(F.broadcast(ids), "id", "left")  # at most MOST rows
    status = F.when(F.col("__taken"), F.when(known, "completed").otherwise("failed")).otherwise(F.col("status"))
    error = F.when(F.col("__taken") & ~known, F.concat(F.lit("Unknown command: "), F.coalesce("command", F.lit("null"))))
    return met.withColumn("status", status).withColumn("error", error).drop("__taken")


def _of(taken: DataFrame, *names: str) -> DataFrame:
    columns = [F.col(c).alias(f"__{c}") for c in ("id", "connector", "datatype", "command", "payload", "issued_at")]
    return F.broadcast(taken.where(F.col("command").isin(*names)).select(*columns))


def _concerns(rows: DataFrame) -> Column:
    """A command without a datatype concerns all of its connector."""
    same = F.col("connector") == F.col("__connector")
    return same & (F.col("__datatype").isNull() | (F.col("datatype") == F.col("__datatype"))) if "datatype" in rows.columns else same


def reset_watermarks(marks: DataFrame, taken: DataFrame) -> DataFrame:
    """The watermarks (connector, datatype, ...) that no reset among the taken commands clears."""
    return marks.join(_of(taken, *RESETS), _concerns(marks), "left_anti")


def pauses(state: DataFrame, taken: DataFrame) -> DataFrame:
    """``state`` (connector, datatype, paused, one row each) after the pauses and resumptions, of which the last one counts."""
    orders = _of(taken, *PAUSES)
    last = state.join(orders, _concerns(state)).groupBy("connector", "datatype").agg(F.max_by(F.col("__command") == "pause_connector", F.struct("__issued_at", "__id")).alias("__now"))
    return state.join(last, ["connector", "datatype"], "left").withColumn("paused", F.coalesce("__now", "paused")).select(*state.columns)


def requeued(letters: DataFrame, taken: DataFrame, most: int = 3) -> DataFrame:
    """Dead letters (connector, datatype, requeue_count, ...) with ``requeued`` and one more try where a command asks for them and tries are left."""
    asked = letters.join(_of(taken, "requeue_dead_letter"), _concerns(letters), "left_semi").select("id").withColumn("__asked", F.lit(True))
    met = letters.join(asked, "id", "left")
    again = F.coalesce(F.col("__asked"), F.lit(False)) & (F.col("requeue_count") < most)
    return met.withColumn("requeued", again).withColumn("requeue_count", F.col("requeue_count") + again.cast("int")).select(*letters.columns, "requeued")


def purged(current: DataFrame, taken: DataFrame) -> DataFrame:
    """A snapshot with the records blanked that a gdpr-purge names: the field external_id of its payload."""
    gone = _of(taken, "gdpr-purge").select(F.get_json_object("__payload", "$.external_id").alias("external_id")).where("external_id is not null")
    return merge.tombstone(current, gone)
