"""Hard negatives by bit-sliced integer products.

Components become integers, and these are cut into bit planes. A product of an anchor with a row is summed plane by plane, the
most significant plane first; after each plane the bits still to come bound the score from both sides. A pair leaves as
soon as its interval cannot reach what is asked: the anchor's best scores so far, or the span of scores that negatives may have.
While most pairs of a block are alive a plane is one matrix product of 0/1 planes, exact in floating point; the few pairs that
are left are then finished one by one.

Rows are dealt to parts of bounded size by their row number, whatever their labels. The anchors stream past every part,
and a part sends on only its best rows for each anchor, so a task holds one part and one block of anchors. Two such passes run: one
finds the positives, the other the negatives in the spans that these set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
PART_ROWS = 8192
TILE_ROWS, TILE_ANCHORS = 2048, 256
SPARSE = 0.05  # share of living pairs from which they are finished one by one
LONG = 1 << 62


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite entry."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def planes_of(rows: np.ndarray, bits: int) -> list[np.ndarray]:
    """0/1 planes of the components plus 2^(bits - 1), the lowest bit first."""
    shifted = rows + (1 << (bits - 1))
    return [((shifted >> k) & 1).astype(np.float64) for k in range(bits)]


def products(anchors: np.ndarray, planes: list[np.ndarray], low: np.ndarray, high: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The allowed pairs whose score lies from low to high (one of each per anchor): anchor, row, score.

    The scores are exact; sums of a plane must stay below 2^53.
    """
    bits = len(planes)
    exact = anchors.astype(np.float64)
    offset = anchors.sum(axis=1) << (bits - 1)
    above, below = np.maximum(anchors, 0).sum(axis=1), np.minimum(anchors, 0).sum(axis=1)
    low, high = low + offset, high + offset
    rows = np.arange(len(planes[0]))
    total = np.zeros((len(anchors), len(rows)), np.int64)
    alive = allowed
    k = bits
    while k:
        k -= 1
        total += (exact @ planes[k][rows].T).astype(np.int64) << k
        rest = (1 << k) - 1
        alive = alive & (total + (rest * above)[:, None] >= low[:, None]) & (total + (rest * below)[:, None] <= high[:, None])
        if k and np.count_nonzero(alive) <= SPARSE * alive.size:
            break
        used = alive.any(axis=0)
        if np.count_nonzero(used) <= len(used) // 2:
            rows, total, alive = rows[used], total[:, used], alive[:, used]
    a, r = np.nonzero(alive)
    score, r = total[a, r], rows[r]
    while k and len(a):
        k -= 1
        score += np.concatenate([np.einsum("ij,ij->i", exact[a[i : i + 65536]], planes[k][r[i : i + 65536]]).astype(np.int64) for i in range(0, len(a), 65536)]) << k
        rest = (1 << k) - 1
        keep = (score + rest * above[a] >= low[a]) & (score + rest * below[a] <= high[a])
        a, r, score = a[keep], r[keep], score[keep]
    return a, r, score - offset[a]


def _first(group: np.ndarray, score: np.ndarray, place: np.ndarray, most: int) -> np.ndarray:
    """Indices of the ``most`` best of each group: highest score, then smallest place."""
    order = np.lexsort((place, -score, group))
    sorted_group = group[order]
    start = np.flatnonzero(np.diff(sorted_group, prepend=-1))
    nth = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[nth < most]


class _Part:
    """Rows of one part, in the order of (id, row number), nulls last, so that an index is also the place among ties."""

    def __init__(self, batches: list[pa.RecordBatch], bits: int):
        rows = pa.Table.from_batches(batches).sort_by([("vec_id", "ascending"), ("row_id", "ascending")])
        self.vec_id = rows.column("vec_id").combine_chunks()
        self.row_id, self.label = (rows.column(c).to_numpy() for c in ("row_id", "label"))
        self.q = _matrix(rows.column("q").combine_chunks())
        self.bits = bits
        self.tiles: list[tuple[np.ndarray, list[np.ndarray]]] = []

    def cut(self, by_label: bool) -> None:
        order = np.argsort(self.label, kind="stable") if by_label else np.arange(len(self.label))
        for k in range(0, len(order), TILE_ROWS):
            at = order[k : k + TILE_ROWS]
            self.tiles.append((at, planes_of(self.q[at], self.bits)))

    def emit(self, anchor: np.ndarray, nr: np.ndarray, at: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(anchor), pa.array(nr.astype(np.int32)), self.vec_id.take(pa.array(at)), pa.array(self.row_id[at]), pa.array(score)]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "nr", "found_id", "found_row", "score"])


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _positives(part: _Part, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The part's best rows of each anchor's label, but the anchor itself."""
    anchor, label, q = batch.column("row_id").to_numpy(), batch.column("label").to_numpy(), _matrix(batch.column("q"))
    n = len(anchor)
    low, high = np.full(n, -LONG), np.full(n, LONG)
    held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
    for at, planes in part.tiles:
        some = np.flatnonzero((label >= part.label[at[0]]) & (label <= part.label[at[-1]]))  # tiles are cut in the order of labels
        if not len(some):
            continue
        allowed = (label[some][:, None] == part.label[at][None, :]) & (anchor[some][:, None] != part.row_id[at][None, :])
        a, r, score = products(q[some], planes, low[some], high[some], allowed)
        held = tuple(np.concatenate(x) for x in zip(held, (some[a], at[r], score)))
        best = _first(held[0], held[2], held[1], POSITIVES)
        held = tuple(x[best] for x in held)
        low = _raised(low, held[0], held[2], POSITIVES)
    if len(held[0]):
        yield part.emit(anchor[held[0]], np.zeros(len(held[0])), held[1], held[2])


def _raised(low: np.ndarray, group: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """``low`` raised to the last of the best scores where a group has ``most`` of them."""
    full = np.bincount(group, minlength=len(low)) >= most
    worst = np.full(len(low), LONG)
    np.minimum.at(worst, group, score)
    return np.where(full, np.maximum(low, worst), low)


def _negatives(part: _Part, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The part's best rows of other labels in the span of each positive of each anchor."""
    anchor, label, q = batch.column("row_id").to_numpy(), batch.column("label").to_numpy(), _matrix(batch.column("q"))
    asked = batch.column("asked")
    owner = np.repeat(np.arange(len(anchor)), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
    span = asked.flatten()
    nr, floor, ceiling = (span.field(k).to_numpy() for k in ("nr", "low", "high"))
    low, high = np.full(len(anchor), LONG), np.full(len(anchor), -LONG)
    np.minimum.at(low, owner, floor)
    np.maximum.at(high, owner, ceiling)
    reach = floor.copy()
    held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))  # span, row, score
    first_span = np.searchsorted(owner, np.arange(len(anchor) + 1))
    for at, planes in part.tiles:
        allowed = label[:, None] != part.label[at][None, :]
        a, r, score = products(q, planes, low, high, allowed)
        times = np.diff(first_span)[a]
        which = np.repeat(first_span[a] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum()) if len(a) else np.empty(0, np.int64)
        r, score = np.repeat(r, times), np.repeat(score, times)
        fits = (score >= reach[which]) & (score <= ceiling[which])
        held = tuple(np.concatenate(x) for x in zip(held, (which[fits], at[r[fits]], score[fits])))
        best = _first(held[0], held[2], held[1], NEGATIVES)
        held = tuple(x[best] for x in held)
        reach = _raised(reach, held[0], held[2], NEGATIVES)
        low = np.full(len(anchor), LONG)
        np.minimum.at(low, owner, reach)
    if len(held[0]):
        yield part.emit(anchor[owner[held[0]]], nr[held[0]], held[1], held[2])


def _meet(bits: int, find, by_label: bool):
    """Reads partitions sorted by (part, kind): the rows of a part, then the anchors that pass it."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, part = None, [], None
        for batch in batches:
            kind = batch.column("part").to_numpy() * 2 + batch.column("is_anchor").to_numpy(zero_copy_only=False)
            cuts = [*np.flatnonzero(np.diff(kind, prepend=-1)).tolist(), len(kind)]
            for begin, end in zip(cuts, cuts[1:]):
                piece = batch.slice(begin, end - begin)
                if kind[begin] // 2 != number:
                    number, rows, part = kind[begin] // 2, [], None
                if not kind[begin] % 2:
                    rows.append(piece)
                    continue
                if part is None and rows:
                    part = _Part(rows, bits)
                    part.cut(by_label)
                if part is not None:
                    for k in range(0, piece.num_rows, TILE_ANCHORS):
                        yield from find(part, piece.slice(k, TILE_ANCHORS))

    return meet


FOUND = "anchor long, nr int, found_id long, found_row long, score long"


def _passed(rows: DataFrame, anchors: DataFrame, parts: int, bits: int, find, by_label: bool) -> DataFrame:
    dealt = rows.withColumn("asked", F.lit(None).cast("array<struct<nr:int,low:long,high:long>>")).withColumn("part", F.pmod(F.xxhash64("row_id"), F.lit(parts))).withColumn("is_anchor", F.lit(False))
    passing = anchors.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))).withColumn("is_anchor", F.lit(True))
    met = dealt.unionByName(passing).repartitionById(parts, F.col("part").cast("int")).sortWithinPartitions("part", "is_anchor")
    return met.mapInArrow(_meet(bits, find, by_label), FOUND)


def _best(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "nr").orderBy(F.col("score").desc(), F.col("found_id").asc_nulls_last(), "found_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(embeddings: DataFrame, anchor_every: int = ANCHOR_EVERY, part_rows: int = PART_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from vec_id, embedding and label.

    Rows with a null label or vector, or with a null or non-finite component, take no part. Components become floor(256 * x);
    vectors shorter than the longest are filled with zeros. Labels of ids divisible by 7 become (label + 1) % 10 first. Anchors are rows
    with ids divisible by ``anchor_every``. Higher scores come first, ties by smaller id (null ids last, then by row). Each row counts for
    itself, repeated or not: a copy of an anchor is one of its other rows, and repeated anchors give their rows each. An anchor without
    other rows of its label, or without a negative in the span of a positive, gives no rows for it. Other columns are ignored;
    empty in, empty out. Scores must fit a long: a ValueError names components that are too large for that.
    """
    known = embeddings.where(F.col("label").isNotNull() & usable(F.col("embedding")))
    label = F.col("label").cast("long")
    rows = known.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("q"),
    )
    rows = staged(rows, "quantised-vectors")
    largest = F.greatest(F.abs(F.array_max("q")), F.abs(F.array_min("q") + 1))
    n, size, top = rows.agg(F.count("*"), F.max(F.size("q")), F.max(largest)).first()
    size, top = max(size or 0, 1), int(top or 0)
    bits = top.bit_length() + 1
    if size << (2 * bits) >= LONG:
        raise ValueError(f"components up to {top} in {size} dimensions have scores beyond a long")
    rows = rows.withColumn("q", F.concat("q", F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("q"))))
    parts = max(1, -(-n // part_rows))
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)
    asked_nothing = anchors.withColumn("asked", F.lit(None).cast("array<struct<nr:int,low:long,high:long>>"))
    positives = _best(_passed(rows, asked_nothing, parts, bits, _positives, True), POSITIVES)
    positives = staged(positives.select("anchor", F.col("rank").alias("nr"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # LOW% <= negative <= HIGH% of the positive score, in whole numbers
    score = F.col("positive_score")
    spans = positives.select("anchor", F.struct("nr", F.expr(f"-((-{LOW_PERCENT} * positive_score - pmod(-{LOW_PERCENT} * positive_score, 100L)) div 100)").alias("low"), F.expr(f"({HIGH_PERCENT} * positive_score - pmod({HIGH_PERCENT} * positive_score, 100L)) div 100").alias("high")).alias("span")).where(score >= 0)
    asked = spans.groupBy("anchor").agg(F.collect_list("span").alias("asked"))  # at most POSITIVES
    asking = anchors.join(asked, F.col("row_id") == F.col("anchor")).drop("anchor")
    negatives = _best(_passed(rows, asking, parts, bits, _negatives, False), NEGATIVES)
    named = positives.join(rows.select(F.col("row_id").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    found = negatives.select("anchor", "nr", "rank", F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return named.join(found, ["anchor", "nr"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
