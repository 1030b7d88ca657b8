"""Bucketed snapshots: plans, partitions that are written, counters and repeated batches."""

import uuid

import pytest
from pyspark.sql import functions as F

from concord.operators import merge
from concord.sources import snapshots

SCHEMA = "external_id string, data string, _raw_hash string, _deleted boolean"


@pytest.fixture
def held(spark, tmp_path, monkeypatch):
    made = snapshots.Snapshot(spark, f"snap_{uuid.uuid4().hex}", 4, 8)
    made.create(spark.range(1000).selectExpr("string(id) as external_id", "concat('d', id) as data", "concat('h', id) as _raw_hash", "id % 10 = 0 as _deleted"))
    yield made
    spark.sql(f"DROP TABLE {made.name}")


def incoming(spark, rows, schema="external_id string, data string, _raw_hash string, op string"):
    return spark.createDataFrame(rows, schema)


def test_the_snapshot_side_is_not_exchanged(spark, held):
    new = spark.range(300, 1500).selectExpr("string(id) as external_id", "'x' as data", "'y' as _raw_hash")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = held.merged(new)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("Join") :]
    assert join.count("Exchange") == 1 and "Bucketed: true" in join
    exchanged = join[join.index("Exchange") :]
    assert held.name not in exchanged.split("FileScan")[0] and "FileScan parquet spark_catalog" not in exchanged


def files(spark, held):
    return {r.path for r in spark.table(held.name).select(F.col("_metadata.file_path").alias("path")).distinct().collect()}


def test_only_touched_partitions_are_written(spark, held):
    before = files(spark, held)
    counters = held.merge(incoming(spark, [("5", "new", "n5", None), ("5000", "z", "hz", "UPSERT"), ("10", "d10", "h10", None)]))
    assert counters == {"fetched": 3, "inserted": 1, "updated": 1, "resurrected": 1, "deleted": 0, "unchanged": 0}
    after = files(spark, held)
    changed = {p.split("__part=")[1].split("/")[0] for p in before ^ after}
    assert 1 <= len(changed) <= 3 < held.parts
    rows = {r.external_id: r for r in held.read().collect()}
    assert len(rows) == 1001 and (rows["5"].data, rows["5000"].data, rows["10"]._deleted, rows["20"]._deleted, rows["6"].data) == ("new", "z", False, True, "d6")


def test_deletes_and_repeated_batches(spark, held):
    one = incoming(spark, [("3", None, None, "DELETE"), ("20", None, None, "DELETE"), ("none", None, None, "DELETE"), ("4", "d4", "h4", "UPSERT")])
    first = held.merge(one)
    assert first == {"fetched": 3, "inserted": 0, "updated": 0, "resurrected": 0, "deleted": 1, "unchanged": 2}
    state = sorted(held.read().collect())
    assert held.merge(one) == {"fetched": 3, "inserted": 0, "updated": 0, "resurrected": 0, "deleted": 0, "unchanged": 3}
    assert sorted(held.read().collect()) == state and len(state) == 1000
    assert {r.external_id: (r.data, r._raw_hash, r._deleted) for r in state}["3"] == ("{}", "h3", True)


def test_equals_the_plain_merge_and_its_counters(spark, held):
    new = spark.range(0, 2000, 3).selectExpr("string(id) as external_id", "if(id % 2 = 0, concat('d', id), 'n') as data", "if(id % 2 = 0, concat('h', id), null) as _raw_hash").persist()
    old = held.read().persist()
    wanted, counted = sorted(merge.apply(new, old).collect()), merge.counters(merge.classify(new, old)).first().asDict()
    counters = held.merge(new)
    assert sorted(held.read().collect()) == wanted
    assert {k: counters[k] for k in counted} == counted and counters["deleted"] == 0


def test_stream_batches(spark, held):
    told = []
    body = snapshots.snapshot_sink(held, lambda b: b, told=lambda n, c: told.append((n, c["updated"], c["deleted"])))
    rows = [("1", 1, "UPSERT", "a", "ha"), ("1", 2, "UPSERT", "b", "hb"), ("2", 3, "UPSERT", "c", "hc"), ("2", 4, "DELETE", None, None), (None, 5, "UPSERT", "x", "y")]
    batch = spark.createDataFrame(rows, "external_id string, seq long, op string, data string, _raw_hash string")
    body(batch, 7)
    body(batch, 7)
    found = {r.external_id: r for r in held.read().collect()}
    assert (found["1"].data, found["2"]._deleted, len(found)) == ("b", True, 1000) and told == [(7, 1, 1), (7, 0, 0)]


def test_empty_batches(spark, held):
    before = files(spark, held)
    assert held.merge(incoming(spark, []))["fetched"] == 0
    assert files(spark, held) == before
