"""Line deduplication with two Bloom filters.

One filter holds the hashes of lines seen once, the other those seen again. Tasks fill local filters over
their own documents; merging them bit by bit (a bit is "twice" if it was set on both sides or twice on one)
never loses a repeat. Only lines that the second filter suspects leave their task, as a digest and an id;
an exact count confirms them and picks the document that keeps them. The filters have a
fixed largest size, so a full filter only raises the number of suspects, never changes the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ._common import staged

BLANKS = b" \t\n\x0b\x0c\r"
BITS_PER_DOCUMENT = 128
MIN_BITS, MAX_BITS = 1 << 20, 1 << 28
PROBES = 3
CHUNK = 1 << 16


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line without blanks at its ends and with A-Z lower-cased; None if it has too few code points."""
    key = line.strip(BLANKS).lower()
    if len(key) < min_chars or (not key.isascii() and len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + np.arange(PROBES, dtype=np.uint64) * high[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def _is_set(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _set(bitmap: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


def _document_keys(text: bytes | None, min_chars: int) -> set[bytes]:
    found = {line_key(x, min_chars) for x in (text or b"").split(b"\n")}
    found.discard(None)
    return found


def _fill(min_chars: int, bits: int):
    """Local filters over a task's documents, in chunks."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            hashes = [xxhash.xxh3_64_intdigest(k) for t in batch.column("text").to_pylist() for k in _document_keys(t, min_chars)]
            at, times = np.unique(_positions(np.array(hashes, np.uint64), bits), return_counts=True)
            _set(twice, at[(times > 1) | _is_set(once, at)])
            _set(once, at)
        size = min(CHUNK, bits // 8)
        for k in range(0, bits // 8, size):
            if once[k : k + size].any():
                yield pa.RecordBatch.from_pylist([{"chunk": k // size, "once": once[k : k + size].tobytes(), "twice": twice[k : k + size].tobytes()}])

    return fill


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold the chunks of a partition; it holds one pair for each chunk number, however many tasks sent one."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            once, twice = (np.frombuffer(row[k], np.uint8) for k in ("once", "twice"))
            if row["chunk"] in held:
                o, t = held[row["chunk"]]
                t |= twice | (o & once)
                o |= once
            else:
                held[row["chunk"]] = (once.copy(), twice.copy())
    for chunk, (_, twice) in held.items():
        yield pa.RecordBatch.from_pylist([{"chunk": chunk, "twice": twice.tobytes()}])


def _suspects(min_chars: int, bits: int, shared):
    schema = pa.schema([("digest", pa.binary()), ("doc_id", pa.int64())])

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            keys, owners = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = _document_keys(text, min_chars)
                keys += found
                owners += [doc_id] * len(found)
            hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
            hit = np.flatnonzero(_is_set(twice, _positions(hashes, bits)).all(axis=1))
            yield pa.RecordBatch.from_pydict({"digest": [digest(keys[i]) for i in hit], "doc_id": [owners[i] for i in hit]}, schema=schema)

    return suspects


def repeated_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """(doc_id, digests): for each document the digests of the lines it loses."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    wanted = max(MIN_BITS, BITS_PER_DOCUMENT * docs.count())
    bits = min(MAX_BITS, 1 << (wanted - 1).bit_length())
    chunks = texts.select("text").mapInArrow(_fill(min_chars, bits), "chunk long, once binary, twice binary")
    merged = chunks.repartition("chunk").mapInArrow(_merge, "chunk long, twice binary")
    twice = np.zeros(bits // 8, np.uint8)
    size = min(CHUNK, bits // 8)
    for row in merged.collect():  # at most MAX_BITS / 8 bytes
        twice[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(row["twice"], np.uint8)
    shared = spark.sparkContext.broadcast(twice.tobytes())
    suspects = staged(texts.mapInArrow(_suspects(min_chars, bits, shared), "digest binary, doc_id long"), "line-suspects")
    confirmed = (
        suspects.distinct()
        .groupBy("digest").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keep_id"))
        .where(F.col("n_docs") >= min_docs)
        .select("digest", "keep_id")
    )
    confirmed = staged(confirmed, "line-confirmed")
    lost = suspects.join(confirmed, "digest").where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return lost.groupBy("doc_id").agg(F.collect_set("digest").alias("digests"))


def _drop(min_chars: int, schema: pa.Schema):
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for text, lost in zip(batch.column("__text").to_pylist(), batch.column("__lost").to_pylist()):
                lines = (text or b"").split(b"\n")
                stay = lines
                if lost:
                    lost = set(lost)
                    stay = [x for x in lines if (k := line_key(x, min_chars)) is None or digest(k) not in lost]
                kept.append(b"\n".join(stay))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            made = {
                "text": pa.array(kept, pa.binary()).cast(pa.string()),
                "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in schema.names], schema=schema)

    return drop


def dedup_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``, and n_lines (before) and n_dropped.

    A line's key is the line without blanks (space, \\t to \\r) at its ends and with A-Z lower-cased. Keys of
    at least ``min_chars`` code points in at least ``min_docs`` documents lose all their lines but those of
    the largest doc_id. Null text counts as one empty line and comes back as an empty text. Rows that share
    a doc_id count as one document; null doc_ids count as one document that never keeps a line. Columns of
    ``docs`` named n_lines or n_dropped are replaced; all others stay. Texts of any length are read whole, one at a time. Empty in,
    empty out.
    """
    lost = repeated_lines(docs, min_docs, min_chars).select(F.col("doc_id").alias("__id"), F.col("digests").alias("__lost"))
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    out = T.StructType([f for f in docs.select(*rest).schema] + [T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    joined = docs.select(*rest, F.col("text").cast("binary").alias("__text")).join(lost.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    return joined.mapInArrow(_drop(min_chars, to_arrow_schema(out)), out)
