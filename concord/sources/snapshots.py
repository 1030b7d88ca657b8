"""Snapshots as bucketed tables: a merge shuffles only what comes in, and writes only the partitions that it touches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import merge

PART = "__part"


@dataclass(frozen=True)
class Snapshot:
    """A table of records (external_id, data, _raw_hash, _deleted), in ``parts`` partitions by key hash with ``buckets`` buckets each.

    Rows of one bucket lie together in every partition, so a join by key reads the table as it lies. Choose ``buckets`` as the number of
    tasks of a merge, and ``parts`` so that a usual batch leaves most of them alone.
    """

    spark: SparkSession
    name: str
    buckets: int = 200
    parts: int = 64

    def _part(self) -> Column:
        return F.pmod(F.xxhash64("external_id"), F.lit(self.parts)).cast("int").alias(PART)

    def create(self, rows: DataFrame) -> None:
        """Write the first state; one row per external_id."""
        made = rows.select(*merge.STATE, self._part()).repartition(self.buckets, "external_id")
        made.write.format("parquet").partitionBy(PART).bucketBy(self.buckets, "external_id").sortBy("external_id").saveAsTable(self.name)

    def read(self, incoming: DataFrame | None = None) -> DataFrame:
        """All records, or those in the partitions that ``incoming`` touches; at most ``parts`` numbers reach the driver."""
        rows = self.spark.table(self.name)
        if incoming is not None:
            rows = rows.where(F.col(PART).isin(sorted(r[0] for r in incoming.select(self._part()).distinct().collect())))
        return rows.select(*merge.STATE)

    def merged(self, incoming: DataFrame) -> DataFrame:
        """The touched partitions after the records of ``incoming`` (one per external_id), with the action of each record."""
        return merge.upserted(incoming, self.read(incoming))

    def merge(self, incoming: DataFrame) -> dict[str, int]:
        """Write ``merged`` in place of the partitions that it touches, and give the counters of the same pass.

        ``incoming`` has external_id, data, _raw_hash and may have ``op``, whose DELETE makes tombstones. A second run with the same records
        leaves the same state. Stage ``incoming`` first if it is dear to compute: it is read twice.
        """
        seen = Observation()
        rows = self.merged(incoming).observe(seen, *merge.action_counts())
        key = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "dynamic")
        try:
            rows.select(*merge.STATE, self._part()).write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(key, before)
        return {k: int(v) for k, v in seen.get.items()}


def snapshot_sink(snapshot: Snapshot, prepare: Callable[[DataFrame], DataFrame], keep: str = "last", told: Callable[[int, dict[str, int]], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body: change records (external_id, seq, op, data, _raw_hash) that ``prepare`` makes of a batch, merged in place.

    Of several changes of one key the last counts, or the first. Records without a key are left out. A batch that comes again leaves the same
    state. ``told`` gets the batch's number and its counters.
    """

    def body(batch: DataFrame, number: int) -> None:
        changes = prepare(batch).where("external_id is not null")
        chosen = merge.latest_change if keep == "last" else merge.first_per_key
        one = chosen(changes, "external_id", "seq", ["op", "data", "_raw_hash"]).persist()
        try:
            counters = snapshot.merge(one)
        finally:
            one.unpersist()
        if told:
            told(number, counters)

    return body
