"""Streaming event rules over files that arrive one per batch."""

import uuid

import pytest

from concord.streaming import events as ev


@pytest.fixture
def streamed(spark, tmp_path):
    """Run a streaming transformation over batches of rows; returns the rows it appended."""

    def run(batches, schema, transform, mode="append", triggers=None):
        folder = tmp_path / "in"
        for k, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder / f"p={k:03d}"))
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(folder))
        name = f"out_{uuid.uuid4().hex}"
        query = transform(source).writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start()
        assert query.awaitTermination(120)
        return spark.table(name)

    return run


def test_deduplicated(streamed):
    batches = [[("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:00:01")], [("a", "2024-01-01 01:00:00"), ("c", "2024-01-01 02:00:00")]]
    out = streamed(batches, "id string, t string", lambda s: ev.deduplicated(s.selectExpr("id", "cast(t as timestamp) as at"), ["id"], "at"))
    assert sorted(r.id for r in out.collect()) == ["a", "b", "c"]


def test_newest_only(streamed):
    batches = [[("k", 1), ("k", 3), ("j", 9)], [("k", 2), ("k", 3), ("k", 5)], [("j", 8), ("k", 6)]]
    timed = [[(k, n, f"2024-01-01 00:00:{second:02d}") for k, n in rows] for second, rows in enumerate(batches)]
    out = streamed(timed, "id string, seq long, t string", lambda s: ev.newest_only(s.selectExpr("id", "seq", "cast(t as timestamp) as at"), "id", "seq", "at"))
    assert sorted((r.id, r.seq) for r in out.collect()) == [("j", 9), ("k", 1), ("k", 3), ("k", 5), ("k", 6)]


def test_newest_only_forgets_keys(streamed):
    """After a day without events, and the watermark past it, a key begins anew."""
    batches = [[("k", 5, "2024-01-01 00:00:00")], [("j", 1, "2024-01-03 00:00:00")], [("j", 2, "2024-01-03 00:00:01")], [("k", 3, "2024-01-03 00:00:02"), ("j", 1, "2024-01-03 00:00:02")]]
    out = streamed(batches, "id string, seq long, t string", lambda s: ev.newest_only(s.selectExpr("id", "seq", "cast(t as timestamp) as at"), "id", "seq", "at", late="1 minute"))
    assert sorted((r.id, r.seq) for r in out.collect()) == [("j", 1), ("j", 2), ("k", 3), ("k", 5)]


def test_reordered_releases_by_the_watermark(streamed):
    """What waits is released once other keys move the time on; no event of its own key has to come."""
    batches = [[("k", 5, "f", "2024-01-01 00:00:00")], [("j", 0, "a", "2024-01-01 00:10:00")], [("j", 1, "b", "2024-01-01 00:10:01")], [("j", 2, "c", "2024-01-01 00:10:02")]]
    out = streamed(batches, "id string, seq long, p string, t string", lambda s: ev.reordered(s.selectExpr("id", "seq", "p", "cast(t as timestamp) as at"), "id", "seq", "p", "at", late="1 minute"))
    assert sorted((r.id, r.seq) for r in out.collect()) == [("j", 0), ("j", 1), ("j", 2), ("k", 5)]


def test_large_sequences_and_missing_payloads_stay_as_they_are(streamed):
    big = 2**60
    batches = [[("k", big + 3, None, 7, "2024-01-01 00:00:00"), ("k", big + 1, "a", None, "2024-01-01 00:00:00")], [("k", big + 5, "c", 8, "2024-01-01 00:00:01"), ("k", big + 4, "b", 9, "2024-01-01 00:00:01")]]
    schema = "id string, seq long, p string, other long, t string"
    made = lambda s: s.selectExpr("id", "seq", "p", "other", "cast(t as timestamp) as at")
    out = streamed(batches, schema, lambda s: ev.newest_only(made(s), "id", "seq", "at"))
    assert sorted((r.seq, r.p, r.other) for r in out.collect()) == [(big + 1, "a", None), (big + 3, None, 7), (big + 4, "b", 9), (big + 5, "c", 8)]
    out = streamed(batches, schema, lambda s: ev.reordered(made(s), "id", "seq", "p", "at", start=big + 1, most=10))
    assert [(r.seq, r.p) for r in out.collect()] == [(big + 1, "a")]


def test_each_waiting_event_is_one_state_entry(spark, streamed, tmp_path):
    batches = [[("k", n, f"p{n}", "2024-01-01 00:00:00") for n in (0, 5, 7, 9)] + [("j", 3, "x", "2024-01-01 00:00:00")]]
    schema = "id string, seq long, p string, t string"
    out = streamed(batches, schema, lambda s: ev.reordered(s.selectExpr("id", "seq", "p", "cast(t as timestamp) as at"), "id", "seq", "p", "at"))
    assert [r.seq for r in out.collect()] == [0]
    held = spark.read.format("statestore").option("path", str(next(p for p in tmp_path.iterdir() if p.name.startswith("out_")))).option("stateVarName", "held").load()
    assert sorted((r["key"][0], r["user_map_key"][0], r["user_map_value"][0]) for r in held.collect()) == [("j", 3, "x"), ("k", 5, "p5"), ("k", 7, "p7"), ("k", 9, "p9")]


def in_order(batches, streamed, **limits):
    timed = [[(k, n, p, f"2024-01-01 00:00:{second:02d}") for k, n, p in rows] for second, rows in enumerate(batches)]
    out = streamed(timed, "id string, seq long, p string, t string", lambda s: ev.reordered(s.selectExpr("id", "seq", "p", "cast(t as timestamp) as at"), "id", "seq", "p", "at", **limits))
    return [(r.seq, r.p) for r in out.collect()]


def test_reordered_releases_without_gaps(streamed):
    batches = [[("k", 0, "a"), ("k", 2, "c")], [("k", 1, "b"), ("k", 0, "late"), ("k", 2, "again")], [("k", 9, "x")]]
    assert in_order(batches, streamed) == [(0, "a"), (1, "b"), (2, "c")]


def test_reordered_flushes_when_full(streamed):
    batches = [[("k", 5, "f"), ("k", 3, "d")], [("k", 9, "j")], [("k", 4, "late"), ("k", 10, "k")]]
    assert in_order(batches, streamed, most=3) == [(3, "d"), (5, "f"), (9, "j"), (10, "k")]


def test_reordered_flushes_after_the_timeout(streamed):
    batches = [[("k", 5, "f")], [("k", 7, "h")], [("k", 8, "i")]]
    assert in_order(batches, streamed, timeout_ms=2000) == [(5, "f"), (7, "h"), (8, "i")]


def test_debounced(streamed):
    rows = [[("k", "2024-01-01 00:00:00", "a"), ("k", "2024-01-01 00:00:05", "b")], [("j", "2024-01-01 00:10:00", "z")], [("j", "2024-01-01 00:30:00", "y")]]
    out = streamed(rows, "id string, t string, p string", lambda s: ev.debounced(s.selectExpr("id", "cast(t as timestamp) as at", "p"), "id", "at", "p", "30 seconds"))
    assert sorted((r.id, r.p, r.n) for r in out.collect()) == [("j", "z", 1), ("k", "b", 2)]


def test_unwrapped_and_deletes(spark):
    rows = spark.createDataFrame([(1, '[{"a":1},{"a":2}]', False), (2, '{"a":3}', True), (3, "{}", True)], "id int, p string, gone boolean")
    assert sorted((r.id, r.item.a) for r in ev.unwrapped(rows, "p", "struct<a:int>").collect()) == [(1, 1), (1, 2), (2, 3), (3, None)]
    assert [r.p for r in ev.marked_deletes(rows, "p", "gone").orderBy("id").collect()] == ['[{"a":1},{"a":2}]', '{"a":3,"_deleted":true}', '{"_deleted":true}']
    more = spark.createDataFrame([(1, '{"_deleted":false,"a":1.50}', True), (2, None, True), (3, "[1]", True), (4, '{"_deleted":true}', False)], "id int, p string, gone boolean")
    assert [r.p for r in ev.marked_deletes(more, "p", "gone").orderBy("id").collect()] == ['{"a":1.5,"_deleted":true}', '{"_deleted":true}', '{"_deleted":true}', '{"_deleted":true}']


def test_change_batches(spark):
    schema = "external_id string, data string, _raw_hash string, _deleted boolean"
    held = {"now": spark.createDataFrame([("1", "a", "h1", False), ("2", "b", "h2", False)], schema)}
    body = ev.apply_changes(lambda: held["now"], lambda df, n: held.update(now=spark.createDataFrame(df.collect(), schema), batch=n))
    changes = [("1", 1, "UPSERT", "x", "hx"), ("1", 2, "DELETE", None, None), ("3", 1, "UPSERT", "c", "h3"), ("9", 1, "DELETE", None, None)]
    body(spark.createDataFrame(changes, "external_id string, seq long, op string, data string, _raw_hash string"), 7)
    assert sorted(tuple(r) for r in held["now"].collect()) == [("1", "{}", "h1", True), ("2", "b", "h2", False), ("3", "c", "h3", False)]
    assert held["batch"] == 7


def test_change_sink_maps_checks_and_merges(spark):
    from pyspark.sql import functions as F

    from concord.functions import records as R
    from concord.operators import transform

    schema = "external_id string, data string, _raw_hash string, _deleted boolean"
    held = {"now": spark.createDataFrame([("1", "{}", "h1", False), ("2", "b", "h2", False)], schema)}

    def prepare(batch):
        fields = [transform.Field("external_id", "id"), transform.Field("seq", "n", "int"), transform.Field("op", "op"), transform.Field("name", "v.name")]
        made = transform.map_fields(batch, "raw", fields)
        bad = F.coalesce(F.col("op") != "DELETE", F.lit(True)) & F.col("name").isNull()
        data = F.to_json(F.struct("name"))
        return made.where(~bad).withColumn("data", data).withColumn("_raw_hash", R.content_hash(data)).drop("name"), made.where(bad).select("external_id", F.lit("quality_violation").alias("error_class"))

    def write(out, number):
        held.update(now=spark.createDataFrame(out["state"].collect(), schema), batch=number, rejects=out["rejects"].count(), mark=out["watermark"].first()[0], history=[r.external_id for r in out["history"].collect()])

    rows = ['{"id":"1","n":3,"v":{"name":"a"}}', '{"id":"1","n":4,"op":"DELETE"}', '{"id":"2","n":5,"op":"DELETE"}', '{"id":"3","n":6,"v":{}}', '{"n":7,"v":{"name":"z"}}']
    ev.change_sink(prepare, lambda: held["now"], write, "run")(spark.createDataFrame([(r,) for r in rows], "raw string"), 4)
    assert sorted((r.external_id, r.data, r._deleted) for r in held["now"].collect()) == [("1", '{"name":"a"}', False), ("2", "{}", True)]
    assert (held["batch"], held["rejects"], held["mark"], held["history"]) == (4, 2, 5, ["1"])


def test_readers_work_on_streams(streamed):
    from concord.sources import files

    lines = [[('{"a":1}',), ("bad",)], [("data: 5",), ('{"a":2}',)]]
    assert sorted(r.record for r in streamed(lines, "value string", files.json_lines).collect()) == ['{"a":1}', '{"a":2}']
