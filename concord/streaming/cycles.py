"""Work cycles that signals trigger: small files in a folder, read as a stream until none is left."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


@dataclass(frozen=True)
class Cycles:
    """``work(signals, number)`` for each batch of signals in ``folder``; the checkpoint remembers which ones are done.

    A signal is a JSON file of one kind of record (``schema``). ``run`` takes all that wait, one cycle for at most ``per_cycle`` files, and
    ends. While ``paused`` nothing begins; signals wait. A cycle that has begun is finished, also if the pause comes during it: then
    the run ends behind it. A cycle that was cut off comes again with the same number and the same signals.
    """

    spark: SparkSession
    folder: str
    checkpoint: str
    schema: str
    work: Callable[[DataFrame, int], None]
    per_cycle: int = 1000

    @property
    def _mark(self) -> str:
        return f"{self.checkpoint}-paused"

    def pause(self) -> None:
        system, path = _open(self._mark)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        with system.open_output_stream(path) as f:
            f.write(b"")

    def resume(self) -> None:
        system, path = _open(self._mark)
        if self.paused:
            system.delete_file(path)

    @property
    def paused(self) -> bool:
        system, path = _open(self._mark)
        return system.get_file_info(path).type != fs.FileType.NotFound

    def signal(self, name: str, text: str) -> None:
        """Put a signal into the folder; it shows as a whole."""
        system, path = _open(self.folder)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/.{name}") as f:
            f.write(text.encode())
        system.move(f"{path}/.{name}", f"{path}/{name}.json")

    def start(self) -> StreamingQuery | None:
        """A query that takes the waiting signals and ends; None while paused."""
        if self.paused:
            return None
        system, path = _open(self.folder)
        system.create_dir(path, recursive=True)
        waiting = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", self.per_cycle).option("pathGlobFilter", "*.json").json(self.folder)

        def cycle(signals: DataFrame, number: int) -> None:
            if self.paused:
                raise Paused(f"paused before cycle {number}")
            self.work(signals, number)

        return waiting.writeStream.foreachBatch(cycle).trigger(availableNow=True).option("checkpointLocation", self.checkpoint).start()

    def run(self) -> bool:
        """Work off what waits; False if a pause left some of it."""
        query = self.start()
        if query is None:
            return False
        try:
            query.awaitTermination()
        except Exception:
            if self.paused:
                return False
            raise
        return True


class Paused(Exception):
    """A cycle that did not begin because of a pause."""
