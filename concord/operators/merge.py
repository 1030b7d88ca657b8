"""Keyed merges of incoming records into a current snapshot, with content hashes, tombstones and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATE = ["external_id", "data", "_raw_hash", "_deleted"]


def first_per_key(df: DataFrame, key: str, arrival: str, columns: list[str]) -> DataFrame:
    """The first record of each key by arrival. An aggregate, so many records of one key combine before the shuffle."""
    return df.groupBy(key).agg(F.min_by(F.struct(*columns), arrival).alias("r")).select(key, "r.*")


def classify(incoming: DataFrame, current: DataFrame) -> DataFrame:
    """(external_id, action, data, _raw_hash): insert, update, resurrect or noop for each incoming record.

    Both sides have one row per external_id and a content hash, which may be null (a payload that is missing): null
    equals null only. A tombstone whose record comes back is resurrected even if its content is as before, and gets its
    payload again.
    """
    old = current.select("external_id", F.col("_raw_hash").alias("old_hash"), F.col("_deleted").alias("was_deleted"), F.lit(True).alias("__old"))
    action = (
        F.when(F.col("__old").isNull(), "insert")
        .when(F.col("was_deleted"), "resurrect")
        .when(~F.col("old_hash").eqNullSafe(F.col("_raw_hash")), "update")
        .otherwise("noop")
    )
    return incoming.join(old, "external_id", "left").select("external_id", action.alias("action"), "data", "_raw_hash")


def apply(incoming: DataFrame, current: DataFrame) -> DataFrame:
    """The snapshot after an upsert, in one full outer join: incoming records replace theirs, all others stay."""
    new = incoming.select("external_id", F.struct(F.col("data"), F.col("_raw_hash"), F.lit(False).alias("_deleted")).alias("__new"))
    both = current.select(*STATE).join(new, "external_id", "full_outer")
    came = F.col("__new").isNotNull()
    return both.select("external_id", *[F.when(came, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) for c in STATE[1:]])


def upserted(incoming: DataFrame, current: DataFrame) -> DataFrame:
    """The snapshot after ``incoming`` with ``action``: insert, update, resurrect, noop or delete for records that came, null for others.

    One full outer join on external_id; where ``current`` is bucketed by it, only ``incoming`` is exchanged. If ``incoming`` has ``op``,
    DELETE makes a tombstone of a known record and leaves out an unknown one; a record that is a tombstone already is a noop.
    """
    gone = F.coalesce(F.col("op") == "DELETE", F.lit(False)) if "op" in incoming.columns else F.lit(False)
    new = incoming.select("external_id", F.struct("data", "_raw_hash", gone.alias("gone")).alias("__new"))
    both = current.select("external_id", F.struct(*STATE[1:]).alias("__old")).join(new, "external_id", "full_outer")
    came, known, leaves = F.col("__new").isNotNull(), F.col("__old").isNotNull(), F.coalesce("__new.gone", F.lit(False))
    action = (
        F.when(~came, F.lit(None))
        .when(leaves, F.when(F.col("__old._deleted"), "noop").otherwise("delete"))
        .when(~known, "insert")
        .when(F.col("__old._deleted"), "resurrect")
        .when(~F.col("__old._raw_hash").eqNullSafe(F.col("__new._raw_hash")), "update")
        .otherwise("noop")
    )
    made = {
        "data": F.when(leaves, "{}").when(came, F.col("__new.data")).otherwise(F.col("__old.data")),
        "_raw_hash": F.when(came & ~leaves, F.col("__new._raw_hash")).otherwise(F.col("__old._raw_hash")),
        "_deleted": F.when(came, leaves).otherwise(F.col("__old._deleted")),
    }
    return both.where(known | ~leaves).select("external_id", *[c.alias(n) for n, c in made.items()], action.alias("action"))


def action_counts() -> list[Column]:
    """Aggregates over ``action``, for ``DataFrame.observe``: the counters of a sync ride on the job that writes it."""
    names = (("inserted", "insert"), ("updated", "update"), ("resurrected", "resurrect"), ("deleted", "delete"), ("unchanged", "noop"))
    return [F.count("action").alias("fetched"), *[F.count_if(F.col("action") == a).alias(n) for n, a in names]]


def missing(current: DataFrame, seen: DataFrame) -> DataFrame:
    """Live records that a full scan did not see."""
    return current.where(~F.col("_deleted")).join(seen.select("external_id"), "external_id", "left_anti")


def deletion_guard(current: DataFrame, seen: DataFrame, most: float = 0.5) -> DataFrame:
    """(n_live, n_missing, ratio, aborted): deletions above the ratio abort, exactly the ratio passes. Ids may be seen repeatedly."""
    live = current.where(~F.col("_deleted")).select("external_id")
    marked = live.join(seen.select("external_id", F.lit(1).alias("here")).distinct(), "external_id", "left")
    counts = marked.agg(F.count("*").alias("n_live"), F.count_if(F.col("here").isNull()).alias("n_missing"))
    ratio = F.when(F.col("n_live") > 0, F.col("n_missing") / F.col("n_live")).otherwise(F.lit(0.0))
    return counts.withColumn("ratio", F.round(ratio, 4)).withColumn("aborted", ratio > most)


def tombstone(current: DataFrame, gone: DataFrame) -> DataFrame:
    """The snapshot with the payload of ``gone`` (ids may repeat) blanked; content hashes stay."""
    marks = gone.select("external_id", F.lit(True).alias("__gone")).distinct()
    met = current.join(marks, "external_id", "left")
    hit = F.coalesce("__gone", F.lit(False))
    return met.select("external_id", F.when(hit, "{}").otherwise(F.col("data")).alias("data"), "_raw_hash", (F.col("_deleted") | hit).alias("_deleted"))


def history(classified: DataFrame, run_id: str) -> DataFrame:
    return classified.where("action <> 'noop'").select("external_id", "data", "_raw_hash", F.lit(run_id).alias("_sync_run_id"))


def counters(classified: DataFrame) -> DataFrame:
    return classified.agg(
        F.count("*").alias("fetched"),
        *[F.count_if(F.col("action") == a).alias(n) for a, n in (("insert", "inserted"), ("update", "updated"), ("resurrect", "resurrected"), ("noop", "unchanged"))],
    )


def latest_change(changes: DataFrame, key: str, sequence: str, columns: list[str]) -> DataFrame:
    """The last change of each key by sequence."""
    return changes.groupBy(key).agg(F.max_by(F.struct(*columns), sequence).alias("r")).select(key, "r.*")


def change_batch(changes: DataFrame, current: DataFrame, order: str, run_id: str, keep: str = "first") -> dict[str, DataFrame]:
    """One batch of change records (external_id, op, data, _raw_hash and ``order``) against a snapshot.

    ``state`` is the snapshot after it, ``history`` what was inserted, updated or resurrected, ``rejects`` the records without a
    key, ``watermark`` one row with the greatest ``order``. Of several records of one key in the batch the first counts, or
    the last if ``keep`` says so. DELETE makes a tombstone of a known record (an unknown one is ignored), all else upserts.
    """
    keyed = changes.where("external_id is not null")
    chosen = first_per_key if keep == "first" else latest_change
    one = chosen(keyed, "external_id", order, ["op", "data", "_raw_hash"])
    upserts = one.where("not (op <=> 'DELETE')")
    known = history(classify(upserts, current), run_id)
    return {
        "state": tombstone(apply(upserts, current), one.where("op = 'DELETE'")),
        "history": known,
        "rejects": changes.where("external_id is null").withColumn("error_class", F.lit("data_error")),
        "watermark": keyed.agg(F.max(order).alias("watermark")),
    }


def keyed_merge(current: DataFrame, new: DataFrame, key: list[str], keep_old_if_null: list[str] = (), keep_first: list[str] = ()) -> DataFrame:
    """Upsert by key: new values win, but nulls of ``keep_old_if_null`` and any later value of ``keep_first`` don't."""
    value = [c for c in current.columns if c not in key]
    renamed = new.select(*key, *[F.col(c).alias(f"__{c}") for c in value], F.lit(True).alias("__new"))

    def chosen(c: str) -> Column:
        if c in keep_first:
            return F.coalesce(c, f"__{c}")
        if c in keep_old_if_null:
            return F.coalesce(f"__{c}", c)
        return F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c))

    return current.join(renamed, key, "full_outer").select(*key, *[chosen(c).alias(c) for c in value])


def newest(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The n rows of each key that come first in an order with a unique tie-break."""
    return df.withColumn("__nr", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__nr") <= n).drop("__nr")
