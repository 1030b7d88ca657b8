"""Paged listings as Python data sources: pages by number or offset in parallel, pages by token or link in turn, and streams of tokens.

A service answers one request with one page. Register a source for it with ``register``; the one that comes with the package reads
pages that ``export_pages`` wrote. Requests and responses are dictionaries:

* request: ``offset`` and ``limit``, or ``page`` and ``page_size``, or ``cursor``, or ``link``; and ``since`` (cursor column, value),
  ``equals``, ``fields`` and ``snapshot`` where they apply.
* response: ``items``; ``total`` for offsets and page numbers; ``next`` (a token) for cursors; ``headers`` with ``link`` for links;
  ``snapshot`` if the service can pin its listing.
"""

from __future__ import annotations

import io
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol
from urllib.parse import parse_qs, urlencode

import pyarrow as pa
import pyarrow.json as pj
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .staging import staged, unstaged

STYLES = ("offset", "page", "cursor", "link")
ROW_BITS = 33  # of monotonically_increasing_id


class Service(Protocol):
    def fetch(self, request: dict[str, Any]) -> dict[str, Any]: ...


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


@dataclass
class Folder:
    """Pages of a folder of JSON lines. Its listings are numbered; an older one never shows pages that came later.

    Filters make its pages smaller, they don't move rows between them; so ``total`` counts all rows.
    """

    path: str

    def _listing(self, number: int | None) -> dict[str, Any]:
        system, root = _open(self.path)
        if number is None:
            found = system.get_file_info(fs.FileSelector(f"{root}/listings", allow_not_found=True))
            number = max((int(f.base_name) for f in found if f.base_name.isdigit()), default=0)
        if not number:
            return {"number": 0, "pages": 0, "size": 1, "total": 0}
        with system.open_input_file(f"{root}/listings/{number:09d}") as f:
            return json.loads(f.read()) | {"number": number}

    def _page(self, number: int) -> list[dict[str, Any]]:
        system, root = _open(self.path)
        files = system.get_file_info(fs.FileSelector(f"{root}/pages/page={number}", allow_not_found=True))
        items = []
        for name in sorted(f.path for f in files if f.base_name.startswith("part-")):
            with system.open_input_file(name) as f:
                items += [json.loads(line) for line in f.read().splitlines() if line]
        return items

    def fetch(self, request: dict[str, Any]) -> dict[str, Any]:
        request = dict(request)
        if "link" in request:
            request |= {k: v[0] for k, v in parse_qs(request.pop("link").lstrip("?")).items()}
        pinned = request.get("snapshot")
        listing = self._listing(int(pinned) if pinned else None)
        size, out = listing["size"], {"snapshot": str(listing["number"]), "total": listing["total"]}
        if "page" in request:
            request |= {"offset": (request["page"] - 1) * request["page_size"], "limit": request["page_size"]}
        if "offset" in request:
            begin, end = request["offset"], min(request["offset"] + request["limit"], listing["total"])
            starts = listing["starts"] if "starts" in listing else []
            items, first = [], 0
            for k, (start, n) in enumerate(_spans(starts, listing, size)):
                if start < end and start + n > begin:
                    part = self._page(k)
                    first = first if items else start
                    items += part
            items = items[max(0, begin - first) : max(0, end - first)]
        else:
            number = int(request.get("cursor") or 0)
            items = self._page(number) if number < listing["pages"] else []
            if number + 1 < listing["pages"]:
                out["next"] = str(number + 1)
                out["headers"] = {"link": f'<?{urlencode({"cursor": 0})}>; rel="first", <?{urlencode({"cursor": number + 1})}>; rel="next"'}
        if since := request.get("since"):
            name, value = since
            items = [r for r in items if r.get(name) is not None and r[name] > value]
        for name, value in request.get("equals", {}).items():
            items = [r for r in items if r.get(name) == value]
        if fields := request.get("fields"):
            items = [{k: r[k] for k in fields if k in r} for r in items]
        return out | {"items": items}


def _spans(starts: list[int], listing: dict[str, Any], size: int) -> Iterator[tuple[int, int]]:
    """(first row, rows) of each page; each export that was appended begins a page of its own."""
    ends = [*starts[1:], listing["total"]] if starts else []
    for start, end in zip(starts, ends):
        for row in range(start, end, size):
            yield row, min(size, end - row)


def next_link(headers: dict[str, str] | None) -> str | None:
    """The target with rel="next" in a Link header."""
    for target, rest in re.findall(r"<([^>]*)>([^<]*)", (headers or {}).get("link", "")):
        if re.search(r';\s*rel="?next"?(\s|,|;|$)', rest):
            return target
    return None


@dataclass
class _Asked:
    """What all requests of one scan share."""

    since: tuple[str, Any] | None = None
    equals: dict[str, Any] = field(default_factory=dict)
    fields: list[str] = field(default_factory=list)
    snapshot: str | None = None

    def of(self, **more: Any) -> dict[str, Any]:
        shared = {"since": self.since, "equals": self.equals, "fields": self.fields, "snapshot": self.snapshot}
        return {k: v for k, v in shared.items() if v} | more


def _batches(items: list[dict[str, Any]], schema: StructType) -> Iterator[pa.RecordBatch]:
    if items:
        text = io.BytesIO("\n".join(json.dumps(r) for r in items).encode())
        options = pj.ParseOptions(explicit_schema=to_arrow_schema(schema), unexpected_field_behavior="ignore")
        yield from pj.read_json(text, pj.ReadOptions(block_size=1 << 26), options).select(schema.names).to_batches()


def _walk(service: Service, asked: _Asked, style: str) -> Iterator[dict[str, Any]]:
    """Responses in turn until there is no next page or an empty one; a token that comes twice ends in an error."""
    seen, at = set(), None
    while True:
        response = service.fetch(asked.of(**({style: at} if at is not None else {})))
        if not response["items"] and not asked.since and not asked.equals:
            return
        yield response
        if asked.snapshot is None and response.get("snapshot"):
            asked.snapshot = response["snapshot"]
        at = response.get("next") if style == "cursor" else next_link(response.get("headers"))
        if at is None:
            return
        if at in seen:
            raise ValueError(f"the listing came back to {at!r}")
        seen.add(at)


@dataclass
class _Pages(InputPartition):
    requests: list[dict[str, Any]]


class _Reader(DataSourceReader):
    def __init__(self, source: Pages, schema: StructType):
        self.service, self.options, self.schema = source.service(), dict(source.options), schema
        self.style = self.options.get("style", "offset")
        if self.style not in STYLES:
            raise ValueError(f"style is one of {', '.join(STYLES)}, not {self.style!r}")
        self.asked = _Asked(fields=schema.names, snapshot=self.options.get("snapshot"))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """The cursor's lower bound and equality of ``filters`` columns go into the requests; Spark evaluates all others."""
        known = [c.strip() for c in self.options.get("filters", "").split(",") if c.strip()]
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if isinstance(f, GreaterThan) and name == self.options.get("cursor") and isinstance(f.value, (int, float, str)):
                if self.asked.since is None or self.asked.since[1] < f.value:
                    self.asked.since = (name, f.value)
            elif isinstance(f, EqualTo) and name in known and self.asked.equals.setdefault(name, f.value) == f.value:
                pass
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        if self.style in ("cursor", "link"):
            return [_Pages([])]
        size, most = int(self.options.get("pagesize", 1000)), int(self.options.get("partitions", 200))
        head = self.service.fetch(self.asked.of(offset=0, limit=1) if self.style == "offset" else self.asked.of(page=1, page_size=1))
        self.asked.snapshot = self.asked.snapshot or head.get("snapshot")
        n = -(-int(head["total"]) // size)
        requests = [self.asked.of(offset=k * size, limit=size) if self.style == "offset" else self.asked.of(page=k + 1, page_size=size) for k in range(n)]
        per_task = max(1, -(-n // most))
        return [_Pages(requests[k : k + per_task]) for k in range(0, n, per_task)] or [_Pages([])]

    def read(self, partition: _Pages) -> Iterator[pa.RecordBatch]:
        responses = _walk(self.service, self.asked, self.style) if self.style in ("cursor", "link") else map(self.service.fetch, partition.requests)
        for response in responses:
            yield from _batches(response["items"], self.schema)


class _Stream(DataSourceStreamReader):
    """The offset is the token of a page and whether it has been taken; a last page is looked at again for a next one."""

    def __init__(self, source: Pages, schema: StructType):
        self.service, self.options, self.schema = source.service(), dict(source.options), schema
        self.most = int(self.options.get("maxpagesperbatch", 1 << 30))
        self.at: dict[str, Any] | None = None

    def initialOffset(self) -> dict[str, Any]:
        return {"token": "", "taken": False}

    def _steps(self, at: dict[str, Any]) -> Iterator[tuple[str | None, dict[str, Any]]]:
        """(token of a page that is taken, or None; the offset after the step)."""
        while True:
            response = self.service.fetch({"cursor": at["token"]} if at["token"] else {})
            if not at["taken"]:
                if not response["items"]:
                    return
                yield at["token"], {"token": at["token"], "taken": True}
            if response.get("next") is None:
                return
            at = {"token": response["next"], "taken": False}

    def latestOffset(self) -> dict[str, Any]:
        at = self.at or self.initialOffset()
        for k, (_, after) in enumerate(self._steps(at)):
            at = after
            if k + 1 >= self.most:
                break
        self.at = at
        return at

    def partitions(self, start: dict[str, Any], end: dict[str, Any]) -> list[InputPartition]:
        self.at = self.at or end  # a restarted query plans its last batch first
        pages = []
        if start != end:
            for token, after in self._steps(start):
                pages.append(_Pages([{"cursor": token} if token else {}]))
                if after == end:
                    break
        return pages

    def read(self, partition: _Pages) -> Iterator[pa.RecordBatch]:
        for request in partition.requests:
            yield from _batches(self.service.fetch(request)["items"], self.schema)


class Pages(DataSource):
    """``spark.read.format("concord_pages")`` over the pages of a folder (``path``); for another service, subclass it and override
    ``name`` and ``service``.

    Options: ``style`` (offset, page, cursor, link), ``pageSize``, ``partitions`` (most tasks), ``cursor`` (the column of the incremental
    filter), ``filters`` (columns whose equality the service understands), ``snapshot`` (a pinned listing) and, for streams,
    ``maxPagesPerBatch``. The schema names the fields that are asked for. Offsets and page numbers are read in parallel, from the
    listing that the first request saw; tokens and links in one task, page after page. Streams go by token.
    """

    @classmethod
    def name(cls) -> str:
        return "concord_pages"

    def service(self) -> Service:
        return Folder(self.options["path"])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(self, schema)


def register(spark: SparkSession, source: type[Pages] = Pages) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)


def export_pages(rows: DataFrame, path: str, order: list[str], size: int) -> int:
    """Append ``rows`` to a folder of pages, by ``order`` and ``size`` to a page, and give the number of the new listing.

    Rows are numbered by counting partitions, so no task holds more than its own and one page. A listing appears once all its
    pages stand, so a reader sees all of an export or nothing.
    """
    before = Folder(path)._listing(None)
    if before["number"] and before["size"] != size:
        raise ValueError(f"the folder has pages of {before['size']} rows")
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(F.monotonically_increasing_id().alias("__id"), F.to_json(F.struct(*rows.columns)).alias("value"))
    numbered = staged(sorted_rows, "page-rows")
    part = F.shiftright("__id", ROW_BITS)
    counts = sorted(tuple(r) for r in numbered.groupBy(part.alias("p")).count().collect())  # one per partition
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    first = rows.sparkSession.createDataFrame(starts or [(0, 0)], "p long, first long")
    placed = numbered.join(F.broadcast(first), part == F.col("p"))
    number = F.col("first") + F.col("__id").bitwiseAND((1 << ROW_BITS) - 1)
    page = placed.select((F.lit(before["pages"]) + F.floor(number / size)).alias("page"), "value", "__id")
    page.repartition("page").sortWithinPartitions("page", "__id").drop("__id").write.mode("append").partitionBy("page").text(f"{path}/pages")
    unstaged(numbered)
    listing = {"pages": before["pages"] + -(-total // size), "size": size, "total": before["total"] + total, "starts": [*before.get("starts", []), *([before["total"]] if total else [])]}
    system, root = _open(path)
    system.create_dir(f"{root}/listings", recursive=True)
    with system.open_output_stream(f"{root}/listings/{before['number'] + 1:09d}") as f:
        f.write(json.dumps(listing).encode())
    return before["number"] + 1
