"""Paged sources: partitions, pushed filters, tokens, links, snapshots and streams."""

import json
import uuid

import pytest
from pyspark.errors import PySparkException

from concord.sources import pages

SCHEMA = "id long, name string, at timestamp, inner struct<x:int>, list array<double>"


@pytest.fixture
def folder(spark, tmp_path):
    pages.register(spark)
    path = str(tmp_path / "pages")
    rows = spark.range(1, 1024).selectExpr("id", "concat('n', id % 7) as name", "timestamp_seconds(id) as at", "if(id % 5 = 0, null, named_struct('x', int(id))) as inner", "array(0.5, id) as list")
    assert pages.export_pages(rows.repartition(4), path, ["id"], 100) == 1
    return path, rows


def read(spark, path, style, **options):
    return spark.read.format("concord_pages").schema(options.pop("schema", SCHEMA)).options(style=style, path=path, pageSize=100, **options).load()


@pytest.mark.parametrize("style", pages.STYLES)
def test_all_rows_and_types_by_every_style(spark, folder, style):
    path, rows = folder
    assert sorted(read(spark, path, style).collect()) == sorted(rows.selectExpr("id", "name", "at", "inner", "list").collect())


def test_partitions_come_from_the_total(spark, folder):
    path, _ = folder
    assert read(spark, path, "offset").rdd.getNumPartitions() == 11
    assert read(spark, path, "page", partitions=4).rdd.getNumPartitions() == 4
    assert read(spark, path, "cursor").rdd.getNumPartitions() == 1
    assert read(spark, path, "offset", partitions=3).count() == 1023


def test_filters_reach_the_requests(spark, folder, capsys):
    path, rows = folder
    df = read(spark, path, "offset", cursor="id", filters="name").where("id > 500 and name = 'n3' and inner.x is not null")
    df.explain()
    plan = capsys.readouterr().out
    filters = " ".join(line for line in plan.splitlines() if "Filter" in line)
    assert "BatchScan" in plan and "x" in filters and "500" not in plan and "n3" not in plan  # the scan took them over
    read(spark, path, "offset").where("id > 500").explain()
    assert "500" in capsys.readouterr().out  # no cursor, no pushed filter
    assert sorted(r.id for r in df.collect()) == [k for k in range(501, 1024) if k % 7 == 3 and k % 5]


def test_a_filter_leaves_later_pages_in_place(spark, folder):
    path, _ = folder
    assert [r.id for r in read(spark, path, "cursor", cursor="id").where("id > 1000").collect()] == list(range(1001, 1024))


def test_only_the_schema_is_asked_for(spark, folder):
    path, _ = folder
    request = {}

    class Watched(pages.Folder):
        def fetch(self, asked):
            request.update(asked)
            return super().fetch(asked)

    reader = pages._Reader(type("S", (), {"service": lambda s: Watched(path), "options": {}})(), spark.range(1).selectExpr("id", "'x' as name").schema)
    batch = next(reader.read(reader.partitions()[0]))
    assert batch.schema.names == ["id", "name"] and request["fields"] == ["id", "name"]


def test_a_pinned_listing_does_not_change(spark, folder):
    path, rows = folder
    before = read(spark, path, "offset", snapshot="1")
    assert before.count() == 1023
    assert pages.export_pages(rows.selectExpr("id + 5000 as id", "name", "at", "inner", "list"), path, ["id"], 100) == 2
    assert before.count() == 1023 and read(spark, path, "cursor", snapshot="1").count() == 1023
    for style in pages.STYLES:
        found = [r.id for r in read(spark, path, style).collect()]
        assert len(found) == len(set(found)) == 2046


def test_pages_that_come_during_a_walk_stay_out(folder):
    path, _ = folder
    service = pages.Folder(path)
    walk = pages._walk(service, pages._Asked(), "cursor")
    taken = len(next(walk)["items"])
    (_, root), listing = pages._open(path), service._listing(None)
    with open(f"{root}/listings/000000002", "w") as f:
        json.dump(listing | {"pages": 99, "total": 9900}, f)
    assert taken + sum(len(r["items"]) for r in walk) == 1023


def test_offsets_need_no_page_borders(folder):
    path, _ = folder
    service = pages.Folder(path)
    for offset, limit in ((0, 1), (95, 10), (250, 333), (1020, 50), (5000, 5)):
        assert [r["id"] for r in service.fetch({"offset": offset, "limit": limit})["items"]] == list(range(1024))[1:][offset : offset + limit]


def test_links():
    assert pages.next_link({"link": '<a?p=1>; rel="prev", <b?x=1,2>; rel="next"; title="n"'}) == "b?x=1,2"
    assert pages.next_link({"link": "<c>; rel=next"}) == "c"
    assert pages.next_link({"link": '<c>; rel="nextish"'}) is None and pages.next_link(None) is None


class _Tokens:
    """Answers by token, from a list of (items, next)."""

    def __init__(self, table):
        self.table, self.asked = table, []

    def fetch(self, request):
        self.asked.append(request.get("cursor"))
        items, after = self.table[request.get("cursor")]
        return {"items": items, "next": after}


def test_walks_stop_on_null_tokens_empty_pages_and_cycles():
    walk = lambda table: [len(r["items"]) for r in pages._walk(_Tokens(table), pages._Asked(), "cursor")]
    assert walk({None: ([1, 2], "a"), "a": ([3], None)}) == [2, 1]
    assert walk({None: ([1, 2], "a"), "a": ([], "b")}) == [2]
    assert walk({None: ([], "a")}) == []
    with pytest.raises(ValueError, match="came back"):
        walk({None: ([1], "a"), "a": ([2], "b"), "b": ([3], "a")})


def test_empty_folders_and_unknown_styles(spark, tmp_path):
    pages.register(spark)
    for style in pages.STYLES:
        assert read(spark, str(tmp_path / "none"), style).collect() == []
    with pytest.raises(PySparkException, match="style is one of"):
        read(spark, str(tmp_path / "none"), "odd").collect()


def test_streams_resume_at_their_token(spark, folder, tmp_path):
    path, rows = folder
    name, check = f"s_{uuid.uuid4().hex}", str(tmp_path / "check")
    seen = []

    def run():
        before = len(seen)
        source = spark.readStream.format("concord_pages").schema("id long, name string").options(path=path).load()
        query = source.writeStream.foreachBatch(lambda df, n: seen.extend(r.id for r in df.collect())).queryName(name).trigger(availableNow=True).option("checkpointLocation", check).start()
        assert query.awaitTermination(120)
        return sorted(seen[before:])

    assert run() == list(range(1, 1024))
    assert run() == []
    pages.export_pages(rows.selectExpr("id + 5000 as id", "name", "at", "inner", "list"), path, ["id"], 100)
    assert run() == list(range(5001, 6024))
    assert run() == []


def test_stream_batches_have_a_limit_of_pages(folder):
    path, _ = folder
    stream = pages._Stream(type("S", (), {"service": lambda s: pages.Folder(path), "options": {"maxpagesperbatch": "4"}})(), None)
    at, sizes = stream.initialOffset(), []
    while (end := stream.latestOffset()) != at:
        sizes.append(len(stream.partitions(at, end)))
        at = end
    assert sizes == [4, 4, 3] and stream.partitions(at, at) == []
