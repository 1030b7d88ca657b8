"""Column functions, merges and readers on small hand-made rows."""

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from concord.functions import records as R
from concord.operators import configs, hooks, merge, metrics, runs, schemas, transform, writeback
from concord.sources import files

STATE = "external_id string, data string, _raw_hash string, _deleted boolean"
INCOMING = "external_id string, data string, _raw_hash string"


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def test_null_hashes_lose_no_data(spark):
    new = spark.createDataFrame([("1", "not json", None), ("2", "fresh", None), ("3", "back", "h"), ("5", "same", None)], INCOMING)
    old = spark.createDataFrame([("1", "old", "h", False), ("3", "{}", "h", True), ("4", "kept", None, False), ("5", "same", None, False)], STATE)
    assert values(merge.apply(new, old)) == [("1", "not json", None, False), ("2", "fresh", None, False), ("3", "back", "h", False), ("4", "kept", None, False), ("5", "same", None, False)]
    assert values(merge.classify(new, old), "external_id", "action") == [("1", "update"), ("2", "insert"), ("3", "resurrect"), ("5", "noop")]


def test_texts_that_are_no_json_have_a_hash(spark):
    df = spark.createDataFrame([("not json",), ('{"b": 1, "a": 2}',), ('{"a":2,"b":1}',), (None,)], "p string")
    got = [r[0] for r in df.select(R.content_hash(F.col("p"))).collect()]
    assert got == [hashlib.sha256(b"not json").hexdigest(), *[hashlib.sha256(b'{"a":2,"b":1}').hexdigest()] * 2, None]


def test_mapping_keeps_types(spark):
    df = spark.createDataFrame([('{"n":5,"a":{"x":1},"b":true,"first-name":"z","l":[{"k":7}]}',)], "p string")
    row = transform.map_fields(df, "p", [transform.Field("f", "first-name"), transform.Field("k", "l[0].k", "int")], strict=False).first()
    assert tuple(row) == ("z", 7, '{"n":5,"a":{"x":1},"b":true}')
    assert df.select(transform.add_reference(F.col("p"), "b", F.lit("r"))).first()[0] == '{"n":5,"a":{"x":1},"first-name":"z","l":[{"k":7}],"b":"r"}'
    with pytest.raises(ValueError):
        R.dot_path(F.col("p"), "a['x']")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_timestamps_do_not_depend_on_the_session(spark, zone):
    cases = {
        "1700000000": "2023-11-14T22:13:20Z", "1700000000000": "2023-11-14T22:13:20Z", "2024-01-14T12:00:00Z": "2024-01-14T12:00:00Z",
        "2024-01-14T12:00:00+02:00": "2024-01-14T10:00:00Z", "2024-01-14 12:00:00.25": "2024-01-14T12:00:00Z", "2024-03-10T02:30:00": "2024-03-10T02:30:00Z",
        "2024-11-03T01:30:00Z": "2024-11-03T01:30:00Z", "Sun, 14 Jan 2024 12:00:00 +0000": "2024-01-14T12:00:00Z", "never": "never",
    }
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(k,) for k in cases], "v string")
        assert dict(df.select("v", R.normalize_timestamp(F.col("v"))).collect()) == cases
        rfc = df.where("v like 'Sun%'").select(R.normalize_timestamp(F.col("v"), "rfc2822"), R.normalize_timestamp(F.col("v"), "iso8601")).first()
        assert tuple(rfc) == ("2024-01-14T12:00:00Z", "Sun, 14 Jan 2024 12:00:00 +0000")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_repeated_ids_hide_no_deletion(spark):
    live = spark.createDataFrame([(str(i), "x", "h", False) for i in range(4)], STATE)
    seen = spark.createDataFrame([("0",)] * 9, "external_id string")
    assert tuple(merge.deletion_guard(live, seen).first()) == (4, 3, 0.75, True)
    assert merge.tombstone(live, seen).count() == 4


def test_change_batches(spark):
    changes = spark.createDataFrame([("a", 1, "UPSERT", "v1", "h1"), ("a", 2, "DELETE", None, None), ("b", 3, "DELETE", None, None), ("z", 4, "DELETE", None, None), (None, 5, "UPSERT", "v", "h")], "external_id string, seq long, op string, data string, _raw_hash string")
    now = spark.createDataFrame([("b", "v0", "h0", False)], STATE)
    first, last = (merge.change_batch(changes, now, "seq", "r", keep) for keep in ("first", "last"))
    assert values(first["state"]) == [("a", "v1", "h1", False), ("b", "{}", "h0", True)]
    assert values(last["state"]) == [("b", "{}", "h0", True)]
    assert values(first["history"], "external_id") == [("a",)] and values(last["history"]) == []
    assert first["rejects"].count() == 1 and first["watermark"].first()[0] == 4


def test_signatures(spark):
    df = spark.createDataFrame([("body",)], "b string")
    for secret in ("s", "k" * 100):
        want = hmac.new(secret.encode(), b"body", hashlib.sha256)
        assert df.select(R.hmac_sha256(secret, F.col("b"))).first()[0] == want.hexdigest()
        import base64

        given = base64.b64encode(want.digest()).decode()
        got = df.select(R.signature_valid(secret, F.col("b"), F.lit(given), "base64"), R.signature_valid(secret, F.col("b"), F.lit(None).cast("string")), R.signature_valid(secret, F.col("b"), F.lit("v1=" + want.hexdigest()))).first()
        assert tuple(got) == (True, False, True)


def test_chains_of_any_length_and_cycles(spark):
    n = 70
    nodes = spark.createDataFrame([(i,) for i in range(n)] + [(900,), (901,), (902,)], "id long")
    edges = spark.createDataFrame([(i, i - 1) for i in range(1, n)] + [(900, 901), (901, 900), (902, 901)], "id long, parent long")
    got = dict(writeback.levels(edges, nodes).collect())
    assert got == {i: i for i in range(n)} | {900: None, 901: None, 902: None}


def test_write_order_flags_whole_groups(spark):
    rows = spark.createDataFrame([("c1", "g1", "p1"), ("p1", "g1", None), ("a", "g2", "b"), ("b", "g2", "a"), ("free", "g2", None), ("x", None, "p1"), ("y", "g3", "p1")], "id string, g string, parent string")
    got = {r.id: (r.write_level, r.cycle) for r in writeback.write_order(rows, "id", "g", ["parent"]).collect()}
    assert got == {"p1": (0, False), "c1": (1, False), "a": (None, True), "b": (None, True), "free": (None, True), "x": (None, False), "y": (0, False)}


def test_levels_deal_rows_before_they_drop_repeated_ones(spark, tmp_path, monkeypatch):
    spark.range(40).selectExpr("id", "id % 3 as g", "id - 3 as parent").write.parquet(f"{tmp_path}/rows")
    plans, write = [], writeback.staged

    def staged(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString().splitlines())
        return write(df, name)

    monkeypatch.setattr(writeback, "staged", staged)
    rows = writeback.write_order(spark.read.parquet(f"{tmp_path}/rows"), "id", "g", ["parent"])
    assert {(r.id, r.write_level) for r in rows.collect()} == {(i, i // 3) for i in range(40)}
    met = 0
    for lines in plans:
        for k, line in enumerate(lines):
            if "Aggregate(" in line:
                below = next(x for x in lines[k + 1 :] if "Exchange" in x or "Scan" in x)
                assert "Exchange hashpartitioning" in below, "\n".join(lines)
                met += 1
    assert met


def test_record_hooks_and_policies(spark):
    rows = spark.createDataFrame([(1, '{"a":1}'), (2, "[1]"), (3, "bad"), (4, None), (5, '{"a":null}')], "id long, p string")

    def fix(r):
        if "_raw" in r:
            return {"text": r["_raw"]}
        return {"a": r["a"] + 1} if r else None

    got = values(hooks.record_hook(rows, "p", fix), "id", "result", "outcome")
    assert got == [(1, '{"a":2}', "upserted"), (2, '{"text":"[1]"}', "upserted"), (3, '{"text":"bad"}', "upserted"), (4, None, "dropped"), (5, None, "failed")]


def test_configs():
    assert configs.connector_order({"b": ["a"], "a": [], "d": ["b", "gone"], "c": ["a"]}) == ["a", "b", "c", "d"]
    with pytest.raises(ValueError, match="x"):
        configs.connector_order({"x": ["y"], "y": ["x"], "z": []})
    types = {"contact": {"read": ["r.contact"], "write": ["w"]}, "order": {"read": ["r.order"]}}
    assert configs.required_scopes(types) == ["r.contact", "r.order", "w"]
    assert configs.missing_scopes(["w", "r.order"], types) == ["r.contact"] and configs.missing_scopes([], types) == []


def test_watermarks_and_schemas(spark):
    marks = spark.createDataFrame([("c", "a"), ("c", "b"), ("d", "a")], "connector string, datatype string")
    assert values(runs.clear_watermarks(marks, "c")) == [("d", "a")]
    with pytest.raises(ValueError):
        runs.clear_watermarks(marks, "c", "a", frozenset({("c", "a")}))
    assert schemas.migrate(marks, marks.schema).columns == ["connector", "datatype"]


def test_readers_on_odd_files(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"a":1}\n\n{"a":1}]\n 7 \n{"a":1},"z":0}\n"x"\n{"a":1}')
    lines = spark.read.text(str(tmp_path / "l.jsonl"))
    assert values(files.json_lines(lines)) == [('"x"',), ("7",), ('{"a":1}',), ('{"a":1}',)]
    assert tuple(files.bad_lines(lines).first()) == (1, 2)
    (tmp_path / "a.json").write_text('[{"a":1}, 5, [2],\n {"b":"x"}]')
    (tmp_path / "o.json").write_text('{"a":1}')
    assert values(files.json_array(spark.read.text([str(tmp_path / n) for n in ("a.json", "o.json")], wholetext=True))) == [('{"a":1}',), ('{"b":"x"}',)]
    (tmp_path / "s.txt").write_text("event: x\ndata: {\"a\":1}\n\ndata:{}\n: c\ndata: oops\n\ndata: 3\n\n")
    assert values(files.event_lines(spark.read.text(str(tmp_path / "s.txt")))) == [("3",), ('{"a":1}',)]


def test_histogram_quantiles_at_the_edges(spark):
    s = spark.createDataFrame([("a", 1.0), ("a", 9.0), ("b", 99.0), ("c", None)], "k string, v double")
    buckets = metrics.histogram(s, F.col("v"), [2.0, 10.0], ["k"])
    assert values(buckets) == sorted([("a", 2.0, 1), ("a", 10.0, 2), ("a", float("inf"), 2), ("b", 2.0, 0), ("b", 10.0, 0), ("b", float("inf"), 1)], key=repr)
    assert values(metrics.quantile(buckets, 0.5, ["k"])) == [("a", 2.0), ("b", 10.0)]


def test_globs(spark):
    df = spark.createDataFrame([("abc",), ("xbc",), ("a.c",), ("]bc",)], "v string")
    for pattern, want in {"[!a]bc": ["]bc", "xbc"], "a?c": ["a.c", "abc"], "[]a]bc": ["]bc", "abc"], "a.*": ["a.c"]}.items():
        assert sorted(r[0] for r in df.where(R.matches_glob(F.col("v"), pattern)).collect()) == want
    assert R.seconds("2h") == 7200 and df.limit(1).select(R.lock_key(F.lit("a"))).first()[0] == int.from_bytes(hashlib.md5(b"a").digest()[:8], "big", signed=True)
