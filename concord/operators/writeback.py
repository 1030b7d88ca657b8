"""Planning of conflict-safe writes. A plan is a DataFrame; nothing here has an effect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.records import dot_path
from ..sources.staging import staged
from .events import capped

ACTIONS = ("insert", "update", "delete", "archive", "upsert")


def pending(delta: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """Rows with something to do, in a fixed order."""
    todo = delta.where("_action <> 'noop' and _status = 'pending'")
    return todo if limit is None else todo.orderBy(*order).limit(limit)


def byte_budget(rows: DataFrame, size: Column, order: str, budget: int, batch: list[str]) -> DataFrame:
    """The leading rows of each batch whose sizes add up to the budget, one at least."""
    w = Window.partitionBy(*batch).orderBy(order)
    running = F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("running_bytes", running).withColumn("__nr", F.row_number().over(w)).where((F.col("running_bytes") <= budget) | (F.col("__nr") == 1)).drop("__nr")


def guard_deletes(rows: DataFrame, most: int) -> DataFrame:
    """All rows, or all but the deletes if there are more than ``most``."""
    deletes = rows.agg(F.count_if(F.col("_action") == "delete").alias("__deletes"))
    return rows.join(F.broadcast(deletes)).where((F.col("__deletes") <= most) | (F.col("_action") != "delete")).drop("__deletes")


def without_done(rows: DataFrame, audit: DataFrame, now: Column, window: str = "1 hour") -> DataFrame:
    """Rows that no audit entry of the last hour reports as written."""
    done = audit.where((F.col("status") == "ok") & (F.col("processed_at") > now - F.expr(f"interval {window}"))).select("external_id", "_action")
    return rows.join(done, ["external_id", "_action"], "left_anti")


def restrict(payload: Column, fields: Column) -> Column:
    """A payload (map of texts) with the given fields only, as entries sorted by name."""
    return F.array_sort(F.map_entries(F.map_filter(payload, lambda k, _: F.array_contains(fields, k))))


def _object(text: Column) -> Column:
    """A JSON object as a map of texts; null where there is none or it is empty."""
    made = F.from_json(text, "map<string,string>")
    return F.when(F.size(made) > 0, made)


def base_lookup(base: Column, data: Column, other: Column) -> Column:
    """The base of a desired row as a map of texts: its own column, else ``_base`` inside its data, else a column ``_base``, else empty.

    All three are JSON texts; what is missing, empty or no object counts as absent.
    """
    return F.coalesce(_object(base), _object(dot_path(data, "_base")), _object(other), F.create_map().cast("map<string,string>"))


def three_way(desired: DataFrame) -> DataFrame:
    """``desired`` with ``safe``: on its payload's fields, the remote equals the base or what was last written.

    payload, base, last_written and remote are maps of texts; a missing map is an empty one.
    """
    none = F.create_map().cast("map<string,string>")
    fields = F.map_keys("payload")
    seen = {c: restrict(F.coalesce(c, none), fields) for c in ("remote", "base", "last_written")}
    return desired.withColumn("safe", (seen["remote"] == seen["base"]) | (seen["remote"] == seen["last_written"]))


def resolve(checked: DataFrame, resolution: Column) -> DataFrame:
    """What to do with each row after the three-way check: write, skip, fail or resync; and whether it is a conflict."""
    step = (
        F.when(F.col("safe"), "write")
        .when(resolution == "last_writer_wins", "write")
        .when(resolution == "merge_fields", "write")
        .when(resolution == "dead_letter", "fail")
        .when(resolution == "re_ingest_and_recompute", "resync")
        .otherwise("skip")
    )
    return checked.withColumn("step", step).withColumn("conflict", ~F.col("safe"))


def conflicting_fields(payload: Column, last_written: Column, remote: Column) -> Column:
    """Fields whose remote value exists and is not the last written one."""
    return F.array_sort(F.filter(F.map_keys(payload), lambda k: remote[k].isNotNull() & ~remote[k].eqNullSafe(last_written[k])))


def merge_fields(rows: DataFrame, groups: list[list[str]] = ()) -> DataFrame:
    """``rows`` with ``conflicted`` (coupled fields conflict together, one hop) and the ``merged`` payload.

    Conflicted fields take the remote value, all others the local one.
    """
    direct = conflicting_fields(F.col("payload"), F.col("last_written"), F.col("remote"))
    found = direct
    for g in groups:
        coupled = F.array(*[F.lit(f) for f in g])
        found = F.array_union(found, F.when(F.arrays_overlap(direct, coupled), F.array_intersect(coupled, F.map_keys("payload"))).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("conflicted", F.array_sort(found))
    return rows.withColumn("merged", F.map_from_entries(F.array_sort(F.map_entries(F.transform_values("payload", lambda k, v: F.when(F.array_contains("conflicted", k), F.col("remote")[k]).otherwise(v))))))


def changed_fields(payload: Column, known: Column) -> Column:
    """The part of a payload that differs from what is known; empty: nothing to write."""
    return F.map_filter(payload, lambda k, v: ~v.eqNullSafe(known[k]))


def field_diff(old: Column, new: Column) -> dict[str, Column]:
    """Names of fields added, removed and changed between two payloads."""
    before, after = F.map_keys(old), F.map_keys(new)
    return {
        "added": F.array_sort(F.array_except(after, before)),
        "removed": F.array_sort(F.array_except(before, after)),
        "changed": F.array_sort(F.filter(F.array_intersect(before, after), lambda k: ~old[k].eqNullSafe(new[k]))),
    }


def field_diff_values(old: Column, new: Column) -> Column:
    """(added, removed, changed): names of fields that came and went, and ``from`` and ``to`` of those that changed, by name."""
    names = field_diff(old, new)
    changed = F.map_from_arrays(names["changed"], F.transform(names["changed"], lambda k: F.struct(old[k].alias("from"), new[k].alias("to"))))
    return F.struct(names["added"].alias("added"), names["removed"].alias("removed"), changed.alias("changed"))


def mismatches(sent: Column, remote: Column) -> Column:
    """Fields that a read after the write shows with another value than was sent."""
    return F.array_sort(F.filter(F.map_keys(sent), lambda k: F.map_contains_key(remote, k) & ~remote[k].eqNullSafe(sent[k])))


def plan(rows: DataFrame, operations: dict[str, tuple[str, str]], key: str) -> DataFrame:
    """method, path and step of each row; actions without an operation, and unknown ones, are skipped."""
    method = path = F.lit(None).cast("string")
    for action, (verb, template) in operations.items():
        hit = F.col("_action") == action
        method = F.when(hit, verb).otherwise(method)
        path = F.when(hit, F.replace(F.lit(template), F.lit("${external_id}"), F.col(key).cast("string"))).otherwise(path)
    known = F.col("_action").isin(*ACTIONS)
    return rows.withColumns({"method": method, "path": path}).withColumn("step", F.when(known & F.col("method").isNotNull(), "write").otherwise("skip"))


def requests(planned: DataFrame, base_url: str, payload: str, etag: str | None = None, key: str | None = None, if_match: str = "If-Match", key_header: str = "Idempotency-Key") -> DataFrame:
    """A plan with ``url``, ``if_match``, ``headers`` and ``body`` as they would be sent; null where the step is no write.

    ``payload`` is a JSON text; deletes send none. Updates carry the tag of the version that was read in ``if_match``, so a target that
    has moved on answers 412. headers is a JSON object by name.
    """
    writes = F.col("step") == "write"
    tag = F.when(writes & (F.col("_action") == "update"), F.col(etag)) if etag else F.lit(None).cast("string")
    named = {if_match: tag, key_header: F.when(writes, F.col(key)) if key else F.lit(None).cast("string")}
    return planned.withColumns({
        "url": F.when(writes, F.concat(F.lit(base_url.rstrip("/")), F.col("path"))),
        "if_match": tag,
        "headers": F.when(writes, F.to_json(F.struct(*[value.alias(name) for name, value in sorted(named.items())]))),
        "body": F.when(writes & (F.col("_action") != "delete"), F.col(payload)),
    })


def dry_run(asked: DataFrame) -> DataFrame:
    """(external_id, action, method, url, headers, body, conflict_detected) of the writes that would be sent; nothing is."""
    conflict = F.col("conflict") if "conflict" in asked.columns else F.lit(False)
    return asked.where("step = 'write'").select("external_id", F.col("_action").alias("action"), "method", "url", "headers", "body", conflict.alias("conflict_detected"))


def outcomes(asked: DataFrame, responses: DataFrame) -> DataFrame:
    """``asked`` with ``outcome`` and ``conflict`` by the status of each response (external_id, status).

    412 means that the target has moved on: a conflict, and the write is skipped. Other statuses from 200 to 299 are ok, all else failed;
    a write without a response is failed, a row without a write skipped.
    """
    status = responses.select("external_id", F.col("status").alias("__status"))
    met = asked.drop("conflict", "outcome").join(status, "external_id", "left")
    ok = F.coalesce(F.col("__status").between(200, 299), F.lit(False))
    moved = (F.col("step") == "write") & F.coalesce(F.col("__status") == 412, F.lit(False))
    outcome = F.when((F.col("step") != "write") | moved, "skipped").when(ok, "ok").otherwise("failed")
    return met.withColumns({"outcome": outcome, "conflict": moved}).drop("__status")


def assigned_id(response: Column, connector: str, datatype: str) -> Column:
    """The id that a target gave in its response to an insert: the first candidate field with a value."""
    names = ("id", f"{datatype}_id", f"{connector}_id", "externalId", "external_id")
    return F.coalesce(*[dot_path(response, f'"{n}"') for n in names])


def archivable(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows to archive whose records (``gone``: external_id) are not gone already."""
    return rows.where("_action = 'archive'").join(gone.select("external_id"), "external_id", "left_anti")


def upsert_methods(rows: DataFrame, existing: DataFrame, update: str = "PATCH", insert: str = "POST") -> DataFrame:
    """(external_id, method) of upserts: records that exist are updated, others inserted."""
    there = existing.select("external_id", F.lit(True).alias("__exists")).distinct()
    method = F.when(F.col("__exists"), update).otherwise(insert)
    return rows.where("_action = 'upsert'").join(there, "external_id", "left").select("external_id", method.alias("method"))


def answered(rows: DataFrame, answers: DataFrame, error: str = "rejected") -> DataFrame:
    """(external_id, success, error) by the items of batch responses (external_id, ok); a row without an item succeeded."""
    ok = F.coalesce("ok", F.lit(True))
    return rows.join(answers.select("external_id", "ok"), "external_id", "left").select("external_id", ok.alias("success"), F.when(~ok, error).alias("error"))


def audited(rows: DataFrame, log: DataFrame) -> DataFrame:
    """The audit rows (external_id, _action, run_id, ...) that the log does not have yet, each once."""
    keys = ["external_id", "_action", "run_id"]
    return rows.dropDuplicates(keys).join(log.select(*keys), keys, "left_anti")


def failing(failures: DataFrame, key: str, most: int = 3) -> DataFrame:
    """(key, failures) of rows that have failed ``most`` times or more: they become dead letters."""
    return failures.groupBy(key).agg(F.count("*").alias("failures")).where(F.col("failures") >= most)


def statuses(rows: DataFrame, succeeded: DataFrame, failed: DataFrame) -> DataFrame:
    """``rows`` with ``_status``: processed, failed or skipped, by the ids that a run reports; success counts before failure."""
    good = succeeded.select("external_id", F.lit(True).alias("__good")).distinct()
    bad = failed.select("external_id", F.lit(True).alias("__bad")).distinct()
    met = rows.drop("_status").join(good, "external_id", "left").join(bad, "external_id", "left")
    return met.withColumn("_status", F.when(F.col("__good"), "processed").when(F.col("__bad"), "failed").otherwise("skipped")).drop("__good", "__bad")


QUEUED = ("_queued_at", "_ingested_at", "_created_at", "_produced_at")


def stale_batches(rows: DataFrame, batch: list[str], order: str, now: Column, most_seconds: float) -> DataFrame:
    """(batch, rows_in_batch, oldest_age_secs, stale): how old the first row of each batch is by the first of its QUEUED times.

    A batch whose first row has none of them has no age and is not stale.
    """
    at = F.coalesce(*[F.col(c) for c in QUEUED if c in rows.columns])
    first = rows.groupBy(*batch).agg(F.count("*").alias("rows_in_batch"), F.min_by(F.struct(at.alias("at")), order).alias("__first"))
    age = F.round((F.unix_micros(now) - F.unix_micros("__first.at")) / 1e6, 1)
    return first.select(*batch, "rows_in_batch", age.alias("oldest_age_secs"), F.coalesce(age > most_seconds, F.lit(False)).alias("stale"))


def resync_commands(resolved: DataFrame, most: int) -> DataFrame:
    """(external_id, command, admitted) for the rows whose step is resync: at most ``most`` per record in an hour's window.

    ``resolved`` has external_id, ``step`` and ``at``, the time of each decision; the write itself is skipped either way.
    """
    asked = resolved.where("step = 'resync'").select("external_id", F.unix_micros("at").alias("micros"))
    told = capped(asked, "external_id", "micros", "external_id", most)
    return told.select("external_id", F.lit("resync_record").alias("command"), "admitted")


def levels(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, level): rows follow all rows they depend on; level null marks rows on or behind a cycle.

    edges: (id, parent). Every round takes the edges to rows just settled out of the open ones and settles the rows that
    have none left, until none is left or none can be settled, so there are as many rounds as the longest chain has rows.
    Both tables are written to the shared folder, so a round costs what is still open. Rows are dealt by id before repeated ones are
    dropped: a task that did so over a part of a file would hold all of it.
    """
    waiting = staged(edges.select("id", "parent").repartition("id").distinct(), "open-edges")
    fresh = staged(nodes.select("id").repartition("id").join(waiting.select("id"), "id", "left_anti").distinct(), "level-0")
    settled, level = [fresh.withColumn("level", F.lit(0))], 0
    while not fresh.isEmpty():
        level += 1
        still = staged(waiting.join(fresh.select(F.col("id").alias("parent")), "parent", "left_anti").select("id", "parent"), "open-edges")
        fresh = staged(waiting.select("id").repartition("id").join(still.select("id"), "id", "left_anti").distinct(), "level")
        settled.append(fresh.withColumn("level", F.lit(level)))
        waiting = still
        if len(settled) == 32:  # a long union makes a slow plan
            settled = [staged(_united(settled), "levels")]
    return nodes.join(_united(settled), "id", "left")


def _united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_order(rows: DataFrame, key: str, group: str, parents: list[str]) -> DataFrame:
    """``rows`` with ``write_level`` and ``cycle``.

    Within a group, a row comes after the rows that its ``parents`` columns name by key (itself and rows elsewhere don't count). A
    group with a cycle is flagged as a whole and has no levels. Rows without a group have no level: they go last.
    """
    grouped = rows.where(F.col(group).isNotNull())
    node = F.struct(F.col(group).alias("g"), F.col(key).alias("k"))
    named = [grouped.where(F.col(p).isNotNull() & (F.col(p) != F.col(key))).select(node.alias("id"), F.struct(F.col(group).alias("g"), F.col(p).alias("k")).alias("parent")) for p in parents]
    nodes = grouped.select(node.alias("id")).repartition("id").distinct()
    edges = _united(named).join(nodes.withColumnRenamed("id", "parent"), "parent", "left_semi")
    found = staged(levels(edges, nodes), "write-levels")
    bad = found.where("level is null").select(F.col("id.g").alias("__bad")).distinct().withColumn("cycle", F.lit(True))
    met = rows.join(found.select(F.col("id.g").alias("__g"), F.col("id.k").alias("__k"), "level"), (F.col(group) == F.col("__g")) & (F.col(key) == F.col("__k")), "left")
    met = met.join(bad, F.col(group) == F.col("__bad"), "left")
    return met.select(*rows.columns, F.when(F.col("cycle").isNull(), F.col("level")).alias("write_level"), F.coalesce("cycle", F.lit(False)).alias("cycle"))
