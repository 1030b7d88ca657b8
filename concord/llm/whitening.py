"""Embedding whitening with exact covariances by digit-slice products.

Entries become integers. A task cuts its centred integers into limbs of a few bits, so that every sum of limb products
stays below 2^53 and a float64 matrix product is exact. The products are recombined as big integers, the tasks' matrices are
merged in two rounds, and the exact covariance, rounded once, is decomposed. Only sums over dimensions and pairs of dimensions
reach the driver, whatever the number of rows; distinct vectors are found by an aggregate, so copies of one vector meet
as one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import staged
from .hard_negatives import usable

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
BATCH, LIMB = 4096, 20  # 4096 products of two 20-bit limbs stay below 2^53
LARGEST = 1 << 55
NUMBER = 40  # bytes of a big integer
ZERO = 1e-12  # eigenvalues up to this share of the largest one count as zero


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id and x, floor(64 * c) + 1000000 for each entry c, without rows that hold none, a null or a non-finite entry."""
    known = embeddings.where(usable(F.col("embedding")))
    known = known.select("vec_id", F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))
    known = known.where(~F.exists("x", lambda x: F.abs(x + 1) >= LARGEST))
    return known.select("vec_id", F.transform("x", lambda x: x + SHIFT).alias("x"))


def limbs(values: np.ndarray, bits: int = LIMB) -> list[np.ndarray]:
    """``values`` as the sum of limb[k] * 2^(bits * k); all limbs but the last are not negative, all are below 2^bits in size."""
    out = []
    while True:
        if all(-(1 << bits) < v < 1 << bits for v in (values.min(initial=0), values.max(initial=0))):
            return [*out, values.astype(np.float64)]
        out.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits


def exact_gram(values: np.ndarray) -> np.ndarray:
    """values.T @ values as big integers, for int64 or big integer entries."""
    size = values.shape[1]
    total = np.zeros((size, size), object)
    for k in range(0, len(values), BATCH):
        parts = limbs(values[k : k + BATCH])
        for i, a in enumerate(parts):
            for j in range(i, len(parts)):
                product = (a.T @ parts[j]).astype(np.int64).astype(object)
                total += (product if i == j else product + product.T) << (LIMB * (i + j))
    return total


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, in int64 where it fits."""
    if n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, sums), default=0) < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _packed(numbers: list[int]) -> bytes:
    return b"".join(int(v).to_bytes(NUMBER, "little", signed=True) for v in numbers)


def _unpacked(blob: bytes) -> np.ndarray:
    return np.array([int.from_bytes(blob[k : k + NUMBER], "little", signed=True) for k in range(0, len(blob), NUMBER)], object)


def merged(vectors: DataFrame, part: Callable[[np.ndarray], list[int]]) -> np.ndarray | None:
    """Sums of big integers over all batches of vectors: each task adds up its own, two rounds merge what they give."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = np.array(part(_vectors(batch.column("x"))), object)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [_packed(total.tolist())]})

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for blob in batch.column("sums"):
                total = _unpacked(blob.as_py()) if total is None else total + _unpacked(blob.as_py())
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [_packed(total.tolist())]})

    each = vectors.select("x").mapInArrow(local, "sums binary").repartition(F.xxhash64("sums")).mapInArrow(fold, "sums binary")
    rows = each.repartition(8, F.xxhash64("sums")).mapInArrow(fold, "sums binary").collect()
    return sum(_unpacked(r.sums) for r in rows) if rows else None


@dataclass
class Moments:
    """Of the fit list: n, the sums S, and the covariance times n^3, all exact."""

    n: int
    sums: list[int]
    gram: np.ndarray

    def covariance(self) -> np.ndarray:
        return (self.gram / self.n**3).astype(float)  # big integers divide with one rounding


def moments(vectors: DataFrame) -> Moments | None:
    """Of distinct vectors x of one length; None if there are none. Values are centred before they are multiplied."""
    found = merged(vectors, lambda x: [len(x), *((x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object))])
    if found is None:
        return None
    n, *sums = map(int, found)
    size = len(sums)
    upper = np.triu_indices(size)
    half = merged(vectors, lambda x: exact_gram(centred(x, n, sums))[upper].tolist())
    gram = np.zeros((size, size), object)
    gram[upper] = half
    gram.T[upper] = half
    return Moments(n, sums, gram)


@dataclass
class Whitening:
    n: int
    sums: list[int]
    components: np.ndarray  # dimensions x components, each unit vector over the root of its eigenvalue
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Whitened rows, and the exact sum of (n * x - S)^2 of each."""
        off = centred(x, self.n, self.sums)
        wide = off.astype(object) if off.dtype == object or int(np.abs(off).max(initial=0)) ** 2 * max(off.shape[1], 1) >= 1 << 62 else off
        return (off / self.n).astype(float) @ self.components, (wide * wide).sum(axis=1).tolist()


def whitening(m: Moments, most: int = COMPONENTS) -> Whitening:
    values, vectors = np.linalg.eigh(m.covariance())
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = int((values[:most] > ZERO * max(values[0], 0)).sum())
    trace = float(sum(int(v) for v in np.diagonal(m.gram)) / m.n**3)
    return Whitening(m.n, m.sums, vectors[:, :keep] / np.sqrt(values[:keep]), values[:keep] / trace if keep else values[:0])


def identity_error(vectors: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity.

    Tasks center their rows on their own means, and the merges correct for the distance between means.
    """
    k = w.components.shape[1]
    if not k:
        return 0.0

    def joined(a, b):
        if a is None:
            return b
        n, gap = a[0] + b[0], b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)

    def packed(state) -> Iterator[pa.RecordBatch]:
        if state is not None:
            yield pa.RecordBatch.from_pydict({"state": [np.concatenate([[state[0]], state[1], state[2].ravel()]).tobytes()]})

    def unpacked(blob: bytes):
        v = np.frombuffer(blob)
        return v[0], v[1 : k + 1], v[k + 1 :].reshape(k, k)

    def local(batches):
        state = None
        for batch in batches:
            if batch.num_rows:
                made = w.apply(_vectors(batch.column("x")))[0]
                mean = made.mean(axis=0)
                state = joined(state, (float(len(made)), mean, (made - mean).T @ (made - mean)))
        yield from packed(state)

    def fold(batches):
        state = None
        for batch in batches:
            for blob in batch.column("state"):
                state = joined(state, unpacked(blob.as_py()))
        yield from packed(state)

    each = vectors.select("x").mapInArrow(local, "state binary").repartition(F.xxhash64("state")).mapInArrow(fold, "state binary")
    state = None
    for row in each.repartition(8, F.xxhash64("state")).mapInArrow(fold, "state binary").collect():
        state = joined(state, unpacked(row.state))
    return float(np.abs(state[2] / state[0] - np.eye(k)).max())


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, exact_deviation string"


def whiten(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error, exact_deviation.

    Rows whose vector is null or holds a null or non-finite entry are dropped; so are those with an entry beyond 2^55 / 64, which has no
    exact long. Vectors shorter than the longest are filled up with entries of zero. Each distinct vector is fitted once, every usable
    row is returned, repeated rows and null ids too. Components whose eigenvalue is at most 1e-12 of the largest have no finite
    whitening and are left out, so a single distinct vector gives no rows. deviation is exact; where it is beyond a long it is null,
    and exact_deviation has all its digits. Other columns are ignored; empty in, empty out.
    """
    spark = embeddings.sparkSession
    rows = quantised(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"))
    size = rows.agg(F.max(F.size("x"))).first()[0]
    if not size:
        return spark.createDataFrame([], SCHEMA)
    rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(size) - F.size("x"))))
    fit = staged(rows.select("x").distinct(), "fit-list")
    model = whitening(moments(fit), most)
    error, k = identity_error(fit, model), model.components.shape[1]

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            made, deviation = model.apply(_vectors(batch.column("x")))
            of = np.repeat(np.arange(len(made)), k)
            texts = pa.array([str(d) for d in deviation])
            longs = pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64())
            columns = {
                "vec_id": batch.column("vec_id").take(pa.array(of)),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(made))),
                "n": pa.array(np.full(len(of), model.n)),
                "deviation": longs.take(pa.array(of)),
                "whitened": pa.array(made.ravel()),
                "explained": pa.array(np.tile(model.explained, len(made))),
                "identity_error": pa.array(np.full(len(of), error)),
                "exact_deviation": texts.take(pa.array(of)),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(applied, SCHEMA)
