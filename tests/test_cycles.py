"""Outbox, monitor, cycles and routes."""

import json
import os
import subprocess
import sys
import textwrap
import time
from datetime import UTC, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from concord.operators import events
from concord.sources import outbox
from concord.streaming import cycles, monitor

REQUESTS = [(f"k{i}", "PUT", f"/r/{i}", "{}", json.dumps({"n": i})) for i in range(50)]


def test_outbox_takes_and_gives(spark, tmp_path):
    outbox.register(spark)
    path = str(tmp_path / "box")
    made = spark.createDataFrame(REQUESTS, outbox.SCHEMA).repartition(5)
    assert outbox.unsent(made, path).count() == 50
    made.write.format("concord_outbox").option("path", path).mode("append").save()
    assert sorted(map(tuple, spark.read.format("concord_outbox").option("path", path).load().collect())) == sorted(REQUESTS)
    more = spark.createDataFrame([*REQUESTS[:10], ("new", "PUT", "/x", None, "ä"), ("new", "PUT", "/x", None, "ä")], outbox.SCHEMA)
    left = outbox.unsent(more, path)
    assert [tuple(r) for r in left.collect()] == [("new", "PUT", "/x", None, "ä")]
    left.write.format("concord_outbox").option("path", path).mode("append").save()
    assert spark.read.format("concord_outbox").option("path", path).load().count() == 51
    with pytest.raises(PySparkException, match="append"):
        made.write.format("concord_outbox").option("path", path).mode("overwrite").save()


def test_a_job_that_fails_leaves_nothing(spark, tmp_path):
    outbox.register(spark)
    path = str(tmp_path / "box")

    @F.udf("string")
    def breaks(k):
        if k == "k49":
            raise RuntimeError("no")
        return k

    made = spark.createDataFrame(REQUESTS, outbox.SCHEMA).repartition(4).withColumn("idempotency_key", breaks("idempotency_key"))
    with pytest.raises(PySparkException):
        made.write.format("concord_outbox").option("path", path).mode("append").save()
    assert spark.read.format("concord_outbox").option("path", path).load().count() == 0


def test_a_task_that_fails_once_leaves_no_double_row(tmp_path):
    """A session of its own, as tasks are only tried again there."""
    script = """
        import os
        from pyspark.sql import SparkSession, functions as F
        from concord.sources import outbox
        spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
        outbox.register(spark)
        flag, path = "FLAG", "BOX"

        class Failing(outbox.Files):
            def put(self, rows):
                out = super().put(rows)
                if out[1] and not os.path.exists(flag):
                    open(flag, "w").close()
                    raise RuntimeError("after the write")
                return out

        class Source(outbox.Outbox):
            name = classmethod(lambda cls: "failing")
            target = lambda self: Failing(self.options["path"])

        spark.dataSource.register(Source)
        rows = spark.range(40).selectExpr("concat('k', id) as idempotency_key", "'PUT' as method", "'/x' as path", "'' as headers", "'' as body").repartition(4)
        rows.write.format("failing").option("path", path).mode("append").save()
        found = spark.read.format("concord_outbox").option("path", path).load()
        print("ROWS", found.count(), found.distinct().count(), len(os.listdir(path + "/parts")), os.path.exists(flag))
    """.replace("FLAG", str(tmp_path / "flag")).replace("BOX", str(tmp_path / "box"))
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": os.pathsep.join([os.getcwd(), os.environ.get("PYTHONPATH", "")])})
    assert "ROWS 40 40 5 True" in done.stdout, done.stdout + done.stderr[-2000:]


def test_stream_batches_commit_once(spark, tmp_path):
    outbox.register(spark)
    source, path = str(tmp_path / "in"), str(tmp_path / "box")
    spark.createDataFrame(REQUESTS, outbox.SCHEMA).write.parquet(source)
    stream = spark.readStream.schema(outbox.SCHEMA).parquet(source).writeStream.format("concord_outbox").option("path", path).option("job", "j")
    for check in ("a", "b"):  # another checkpoint replays the batch under its number
        assert stream.option("checkpointLocation", str(tmp_path / check)).trigger(availableNow=True).start().awaitTermination(120) is not False
        assert spark.read.format("concord_outbox").option("path", path).load().count() == 50


def test_monitor_raises_and_lowers_its_flag(spark, tmp_path):
    source, check = str(tmp_path / "in"), str(tmp_path / "c")
    watch = monitor.LagMonitor(most_behind=3600.0)
    spark.streams.addListener(watch)
    told = []

    def run(at):
        spark.createDataFrame([(at,)], "t string").selectExpr("cast(t as timestamp) as at").write.mode("append").parquet(source)
        stream = spark.readStream.schema("at timestamp").parquet(source).withWatermark("at", "1 minute").groupBy(F.window("at", "1 minute")).count()
        query = stream.writeStream.queryName("watched").outputMode("update").foreachBatch(lambda df, n: told.append(df.count())).option("checkpointLocation", check).trigger(availableNow=True).start()
        before = watch.lag("watched")
        assert query.awaitTermination(120)
        for _ in range(100):
            if watch.lag("watched") is not before and watch.lag("watched").behind is not None:
                return
            time.sleep(0.1)

    try:
        run("2024-01-01 00:00:00")
        assert watch.fallback("watched") and watch.lag("watched").behind > 3600
        run(datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S"))
        assert not watch.fallback("watched")
        query = spark.readStream.schema("at timestamp").parquet(source).writeStream.queryName("broken").foreachBatch(lambda df, n: 1 / 0).option("checkpointLocation", check + "2").trigger(availableNow=True).start()
        with pytest.raises(Exception, match="division"):
            query.awaitTermination(120)
        for _ in range(100):
            if watch.fallback("broken"):
                break
            time.sleep(0.1)
        assert watch.fallback("broken")
    finally:
        spark.streams.removeListener(watch)


def test_flag_by_reports():
    watch = monitor.LagMonitor(most_bytes=100, most_behind=60)
    report = lambda n, b, newest=None: {"id": "q", "name": None, "batchId": n, "timestamp": "2024-01-01T00:10:00.000Z", "numInputRows": 1, "sources": [{"metrics": {"numBytesOutstanding": str(b)}}, {"metrics": None}, {}], "eventTime": {"max": newest} if newest else {}}
    flags = []
    for n, b in enumerate((50, 101, 80, 51, 50, 90)):
        watch.seen(monitor.lag_of(report(n, b)))
        flags.append(watch.fallback("q"))
    assert flags == [False, True, True, True, False, False]
    watch.seen(monitor.lag_of(report(9, 0, "2024-01-01T00:08:00.000Z")))
    assert watch.fallback("q") and watch.lag("q").behind == 120 and not watch.fallback("other")


def test_signals_pause_and_restart(spark, tmp_path):
    done = []
    made = lambda work: cycles.Cycles(spark, str(tmp_path / "signals"), str(tmp_path / "check"), "connector string", work, per_cycle=1)
    one = made(lambda s, n: done.append((n, [r.connector for r in s.collect()])))
    assert one.run() and done == []
    one.signal("a", '{"connector":"crm"}')
    one.signal("b", '{"connector":"erp"}')
    one.pause()
    assert not one.run() and done == []
    one.resume()
    assert one.run()
    assert sorted(c for _, cs in done for c in cs) == ["crm", "erp"] and len(done) == 2
    assert one.run() and len(done) == 2

    def breaks(signals, number):
        raise RuntimeError("cut off")

    one.signal("c", '{"connector":"hr"}')
    with pytest.raises(Exception, match="cut off"):
        made(breaks).run()
    assert one.run() and done[-1][1] == ["hr"] and len(done) == 3

    def pauses(signals, number):
        done.append((number, sorted(r.connector for r in signals.collect())))
        one.pause()

    for name in ("d", "e", "f"):
        one.signal(name, json.dumps({"connector": name}))
    assert not made(pauses).run() and len(done) == 4  # the cycle at hand is finished, the next does not begin
    one.resume()
    assert one.run() and sorted(c for _, cs in done[3:] for c in cs) == ["d", "e", "f"]


def test_ten_thousand_routes(spark):
    routes = [("prefix" if i % 2 else "equals", f"type{i:05d}"[: 6 + i % 4], f"d{i}", i % 977) for i in range(10_000)] + [("prefix", None, "x", 1), ("odd", "type", "x", 0), ("prefix", "", "all", 5000)]
    values = [f"type{i * 7:05d}" for i in range(1500)] + [None, "other", "type0"]
    table = spark.createDataFrame([(k, v, "clash") for k, v in enumerate(values)], "id int, event_type string, datatype string")
    found = events.routed(table, "event_type", spark.createDataFrame(routes, "kind string, text string, datatype string, place int"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    best = {}
    for kind, text, datatype, place in routes:
        if kind != "odd" and text is not None:
            best[kind, text] = min(best.get((kind, text), (place, datatype)), (place, datatype))
    for r in found.collect():
        v = values[r.id]
        hits = [] if v is None else [best[k] for k in [("equals", v), *(("prefix", v[:n]) for n in range(len(v) + 1))] if k in best]
        assert r.datatype == (min(hits)[1] if hits else None), v
