"""An outbox of planned writes as a data source: what a job wrote shows once, as a whole, or not at all.

Every task writes one file and reports its name; the commit lists the files of the tasks that succeeded in one commit file. A
task that failed after writing leaves a file that no commit lists, and a retried one is listed once. Streams name their commit by
batch, so a batch that comes again replaces its own commit. Requests carry idempotency keys; ``unsent`` leaves out those
that are committed already.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, Protocol

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamWriter, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

KEY = "idempotency_key"
SCHEMA = f"{KEY} string, method string, path string, headers string, body string"


class Target(Protocol):
    """Where requests go. ``put`` runs in tasks, ``commit`` and ``discard`` on the driver."""

    def put(self, rows: Iterator[dict[str, Any]]) -> tuple[str, int]: ...

    def commit(self, name: str, parts: list[tuple[str, int]]) -> None: ...

    def discard(self, parts: list[tuple[str, int]]) -> None: ...


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


@dataclass
class Files:
    """Files of JSON lines below ``path``/parts, and commits that list them below ``path``/commits."""

    path: str

    def put(self, rows: Iterator[dict[str, Any]]) -> tuple[str, int]:
        system, root = _open(self.path)
        system.create_dir(f"{root}/parts", recursive=True)
        name, n = f"{uuid.uuid4().hex}.jsonl", 0
        with system.open_output_stream(f"{root}/parts/{name}") as f:
            for row in rows:
                f.write((json.dumps(row, default=str) + "\n").encode())
                n += 1
        return name, n

    def commit(self, name: str, parts: list[tuple[str, int]]) -> None:
        system, root = _open(self.path)
        system.create_dir(f"{root}/commits", recursive=True)
        with system.open_output_stream(f"{root}/.{name}") as f:
            f.write(json.dumps(parts).encode())
        system.move(f"{root}/.{name}", f"{root}/commits/{name}")  # a commit shows with all its files

    def discard(self, parts: list[tuple[str, int]]) -> None:
        system, root = _open(self.path)
        for name, _ in parts:
            system.delete_file(f"{root}/parts/{name}")

    def committed(self) -> list[str]:
        system, root = _open(self.path)
        out: list[str] = []
        for info in system.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True)):
            with system.open_input_file(info.path) as f:
                out += [name for name, n in json.loads(f.read()) if n]
        return sorted(set(out))

    def rows(self, name: str) -> Iterator[dict[str, Any]]:
        system, root = _open(self.path)
        with system.open_input_file(f"{root}/parts/{name}") as f:
            for line in f.read().splitlines():
                yield json.loads(line)


@dataclass
class _Written(WriterCommitMessage):
    part: tuple[str, int]


class _Writer(DataSourceWriter, DataSourceStreamWriter):
    def __init__(self, target: Target, job: str):
        self.target, self.job = target, job

    def write(self, iterator: Iterator[Row]) -> _Written:
        return _Written(self.target.put(r.asDict(recursive=True) for r in iterator))

    @staticmethod
    def _parts(messages: list[_Written | None]) -> list[tuple[str, int]]:
        return [m.part for m in messages if m is not None]

    def commit(self, messages: list[_Written | None], batchId: int | None = None) -> None:
        self.target.commit(self.job if batchId is None else f"{self.job}-{batchId:012d}", self._parts(messages))

    def abort(self, messages: list[_Written | None], batchId: int | None = None) -> None:
        self.target.discard(self._parts(messages))


@dataclass
class _Part(InputPartition):
    name: str


class _Reader(DataSourceReader):
    def __init__(self, files: Files, schema: StructType):
        self.files, self.names = files, schema.names

    def partitions(self) -> list[InputPartition]:
        return [_Part(n) for n in self.files.committed()] or [_Part("")]

    def read(self, partition: _Part) -> Iterator[tuple]:
        for row in self.files.rows(partition.name) if partition.name else ():
            yield tuple(row.get(n) for n in self.names)


class Outbox(DataSource):
    """``format("concord_outbox")`` with ``path``; write in append mode, read what is committed.

    For a stream give ``job``, a name that stays over restarts. For another target subclass it and override ``name`` and ``target``.
    """

    @classmethod
    def name(cls) -> str:
        return "concord_outbox"

    def schema(self) -> str:
        return SCHEMA

    def target(self) -> Target:
        return Files(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("an outbox only takes more: write in append mode")
        return _Writer(self.target(), uuid.uuid4().hex)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return _Writer(self.target(), self.options.get("job", "stream"))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(Files(self.options["path"]), schema)


def register(spark: SparkSession, source: type[Outbox] = Outbox) -> None:
    spark.dataSource.register(source)


def unsent(requests: DataFrame, path: str) -> DataFrame:
    """The requests whose keys no commit has yet, each key once."""
    sent = requests.sparkSession.read.format("concord_outbox").option("path", path).load().select(KEY)
    return requests.dropDuplicates([KEY]).join(sent, KEY, "left_anti")
