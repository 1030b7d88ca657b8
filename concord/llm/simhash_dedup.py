"""SimHash near-duplicates found with a Gray-order hierarchical index.

Distinct fingerprints are dealt to tasks by blocks: within ``radius`` differing bits, at least one of
radius + 1 blocks is equal, so each pair meets in a task that holds a block's value. A task sorts its
fingerprints by (block value, Gray rank), which puts codes with few differing bits side by side, and
builds a tree over that order: a node holds the bits that all codes below it share (mask and pattern), upper
nodes hold what whole groups share. A self-join descends over pairs of nodes, adds up the differences in
newly shared bits, and prunes a pair of groups as soon as the sum exceeds the radius.

A task returns its links as stars; components over them are found by joins. Blocks with very many
fingerprints are cut into chunks, and each pair of chunks gets a task of its own.

``similar_texts`` links texts by the Jaccard similarity of their five-word shingles instead. Its radius is too wide for
blocks of bits, so tasks hold the texts that share one of the first shingles in hash order: two texts of similarity s
share one among the first n - ceil(s * n) + 1 of n. The same index finds the candidates there, and MinHash sketches drop
those that only share a passage, of which there are ever more in a larger table; components of candidates
are dealt out with their texts, and only pairs whose exact similarity is high enough are linked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ._common import staged, unstaged

SHINGLE, SEED, RADIUS = 3, 42, 3
FANOUT = 8
CHUNK_ROWS = 20_000
CHUNK_TEXTS = 500
TEXTS_AT_ONCE = 500
BROADCAST_ROWS = 400_000
SIMILAR_SHINGLE, SIMILARITY, SIMILAR_RADIUS, SKETCH_BITS, SKETCH_RADIUS = 5, 0.8, 26, 128, 32
PRINTS = ("fp", "low", "high")
PASS_BYTES = 1 << 30


def shingle_hashes(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each word shingle, repeats included; words are runs of bytes other than space and \\t to \\r."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    starts = [0, *(e + 1 for e in ends[:-1])]
    hash_ = xxhash.xxh64_intdigest
    return np.array([hash_(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :] or ends[-1:])], np.uint64)


def fingerprints_of(texts: list[bytes | None], size: int = SHINGLE, block: int = 1 << 16) -> np.ndarray:
    """One 64-bit fingerprint per text: a bit is 1 if it is set in over half the text's shingle hashes."""
    return fingerprints_of_hashes([shingle_hashes(t, size) for t in texts], block)


def fingerprints_of_hashes(each: list[np.ndarray], block: int = 1 << 16) -> np.ndarray:
    lengths = np.array([len(x) for x in each], np.int64)
    hashes = np.concatenate([*each, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(len(each)), lengths)
    counts = np.zeros((len(each), 64), np.int64)
    for k in range(0, len(hashes), block):
        part, own = hashes[k : k + block], owner[k : k + block]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.diff(own, prepend=-1))
        counts[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    return np.packbits(2 * counts > lengths[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = fingerprints_of(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made.view(np.int64))], names=["doc_id", "fp"])


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def linked_pairs(keys: np.ndarray, codes: np.ndarray, radius: int, fanout: int = FANOUT, step: int = 1 << 13) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of equal key and at most ``radius`` differing bits; sorted by (key, Gray rank)."""
    levels = [(keys, keys, np.full(len(codes), ~np.uint64(0)), codes)]  # lowest and highest key, mask, pattern
    while len(levels[-1][0]) > fanout:
        low, high, mask, pattern = levels[-1]
        first = np.arange(0, len(low), fanout)
        last = np.minimum(first + fanout, len(low)) - 1
        both, either = np.bitwise_and.reduceat(pattern, first), np.bitwise_or.reduceat(pattern & mask, first)
        shared = np.bitwise_and.reduceat(mask, first) & ~(both ^ either)
        levels.append((low[first], high[last], shared, both & shared))
    top = len(levels[-1][0])
    a, b = np.triu_indices(top)
    none = np.zeros(len(a), np.uint64)
    stack = [(len(levels) - 1, a, b, none, none.astype(np.uint8))]
    while stack:
        depth, a, b, known, differing = stack.pop()
        if len(a) > step * fanout * fanout:
            half = len(a) // 2
            stack += [(depth, a[:half], b[:half], known[:half], differing[:half]), (depth, a[half:], b[half:], known[half:], differing[half:])]
            continue
        low, high, mask, pattern = levels[depth]
        near = (high[a] >= low[b]) & ((a != b) if depth == 0 else True)
        a, b, known, differing = a[near], b[near], known[near], differing[near]
        shared = mask[a] & mask[b]
        differing = differing + np.bitwise_count((pattern[a] ^ pattern[b]) & shared & ~known)
        near = differing <= radius
        a, b, shared, differing = a[near], b[near], shared[near], differing[near]
        if depth == 0:
            yield a, b
            continue
        size = len(levels[depth - 1][0])
        for k in range(0, len(a), step):
            x, y = a[k : k + step, None], b[k : k + step, None]
            inner = np.arange(fanout * fanout)
            x, y = (x * fanout + inner // fanout).ravel(), (y * fanout + inner % fanout).ravel()
            keep = (x <= y) & (y < size) & (x < size)
            stack.append((depth - 1, x[keep], y[keep], np.repeat(shared[k : k + step], fanout * fanout)[keep], np.repeat(differing[k : k + step], fanout * fanout)[keep]))


def stars(keys: np.ndarray, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For each code linked to a smaller one, the code and the smallest index-connected code."""
    order = np.lexsort((gray_rank(codes), keys))
    keys, codes = keys[order], codes[order]
    label = np.arange(len(codes))
    for a, b in linked_pairs(keys, codes, radius):
        while len(a):
            x, y = label[a], label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := label[label], label):
                label = up
    moved = np.flatnonzero(label != np.arange(len(codes)))
    return codes[moved], codes[label[moved]]


def _link(radius: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("task").to_numpy(), b.column("fp").to_numpy()) for b in batches]
        if parts:
            keys, codes = (np.concatenate(x) for x in zip(*parts))
            _, keys = np.unique(keys, return_inverse=True)
            a, b = stars(keys, codes.view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return link


def _small(table: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A staged table of a few numbers a row, broadcast if its counted rows are within the bound."""
    return F.broadcast(table) if table.count() <= most else table


def _tasks(dealt: DataFrame, limit: int, salt: str = "fp") -> DataFrame:
    """``dealt`` with an array ``tasks`` in place of ``block``: a block of more than ``limit`` rows becomes pairs of chunks."""
    sizes = dealt.groupBy("block").agg(F.count("*").alias("n"))
    heavy = staged(sizes.where(F.col("n") > limit).withColumn("chunks", F.ceil(F.col("n") / limit).cast("int")).drop("n"), "heavy-blocks")
    chunk = F.pmod(F.xxhash64(salt), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(F.least(chunk, j).alias("i"), F.greatest(chunk, j).alias("j")))
    parts = F.when(F.col("chunks").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(pairs)
    tasks = dealt.join(_small(heavy), "block", "left").withColumn("tasks", F.transform(parts, lambda part: F.xxhash64("block", part.i, part.j)))
    return tasks.drop("block", "chunks")


def _passes(dealt: DataFrame, limit: int, most: int) -> int:
    """How many passes over the tasks keep the copies of ``text`` in each within what the texts take once, or within ``most`` bytes."""
    sizes = dealt.groupBy("block").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("size"))
    once, copied = sizes.agg(F.sum("size"), F.sum(F.col("size") * F.ceil(F.col("n") / limit))).first()
    return -(-(copied or 0) // max(once or 0, most)) or 1


def links(fingerprints: DataFrame, radius: int = RADIUS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect all pairs within ``radius`` bits.

    A task holds two chunks of ``chunk_rows`` at most, whatever the input. Blocks that are cut into chunks are named in a
    broadcast table, which the blocks' bits bound: 4 blocks of 16 bits have 262,144 values.
    """
    width = -(-64 // (radius + 1))
    blocks = F.array(*[F.concat_ws(":", F.lit(i), F.shiftrightunsigned("fp", i * width).bitwiseAND((1 << min(width, 64 - i * width)) - 1)) for i in range(radius + 1)])
    dealt = fingerprints.select("fp", F.explode(blocks).alias("block"))
    tasks = _tasks(dealt, chunk_rows).select("fp", F.explode("tasks").alias("task"))
    return tasks.repartition("task").mapInArrow(_link(radius), "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Texts are lower-cased (A-Z) and cut into 3-word shingles; texts of fewer words have one shingle, null and
    wordless texts the fingerprint zero, which links like any other. Fingerprints link at ``radius`` or
    fewer differing bits. component_id is the smallest doc_id that links reach (null only where a
    component has no id). Repeated rows and ties share a component. Other columns are ignored. Texts of any length are
    read whole; empty in, empty out.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    marked = staged(texts.mapInArrow(_fingerprint, "doc_id long, fp long"), "fingerprints")
    distinct = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    linked = staged(distinct.join(roots, "fp"), "linked-fingerprints")
    merged = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_linked = linked.join(staged(merged, "component-ids"), "root").select("fp", "component_id")
    of_single = distinct.join(roots, "fp", "left_anti").select("fp", F.col("least_id").alias("component_id"))
    by_fingerprint = staged(of_linked.unionByName(of_single), "fingerprint-components")
    return marked.join(by_fingerprint, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _prefix(sizes: int, similarity: float) -> int:
    return sizes - math.ceil(similarity * sizes - 1e-9) + 1 if sizes else 0


def _mixed(hashes: np.ndarray) -> np.ndarray:
    x = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


MULTIPLIERS = _mixed(np.arange(1, SKETCH_BITS + 1, dtype=np.uint64)) | np.uint64(1)


def sketches_of(sets: list[np.ndarray], block: int = 1 << 16) -> np.ndarray:
    """MinHash sketches, a bit from the smallest of a set's hashes under each of ``SKETCH_BITS`` multipliers; 64 bits to a column.

    Bits of two sets differ with probability (1 - similarity) / 2.
    """
    least = np.zeros((len(sets), SKETCH_BITS), np.uint64)
    for row, hashes in zip(least, sets):
        step = max(1, block // max(1, len(hashes)))
        for k in range(0, SKETCH_BITS if len(hashes) else 0, step):
            row[k : k + step] = (hashes * MULTIPLIERS[k : k + step, None]).min(axis=1)
    return np.packbits((least >> np.uint64(24)).astype(np.uint8) & 1, axis=1, bitorder="little").view("<u8")


def _describe(similarity: float):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, TEXTS_AT_ONCE) for whole in batches for k in range(0, whole.num_rows, TEXTS_AT_ONCE)):
            each = [shingle_hashes(t, SIMILAR_SHINGLE) for t in batch.column("text").to_pylist()]
            sets = [np.unique(x) for x in each]
            nodes = np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in sets], np.uint64).view(np.int64)
            first = [x[: _prefix(len(x), similarity)].view(np.int64) for x in sets]
            ends = np.cumsum([0, *map(len, first)]).astype(np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*first, np.empty(0, np.int64)])))
            size = pa.array([len(x) for x in sets], pa.int32())
            prints = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (fingerprints_of_hashes(sets), *sketches_of(sets).T)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(nodes), size, *prints, prefix], names=["doc_id", "text_hash", "node", "size", *PRINTS, "prefix"])

    return describe


def _similar_stars(keys: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, codes: np.ndarray, low: np.ndarray, high: np.ndarray, similarity: float, sets: list[np.ndarray] | None, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Stars of the candidates of equal key, or with ``sets`` of those whose similarity is high enough.

    A pair is compared only as long as other pairs have not connected it, so a group of n near copies takes about n comparisons.
    """
    order = np.lexsort((gray_rank(codes), keys))
    keys, nodes, sizes, codes, low, high = keys[order], nodes[order], sizes[order], codes[order], low[order], high[order]
    label = np.arange(len(codes))
    for a, b in linked_pairs(keys, codes, SIMILAR_RADIUS):
        fits = np.minimum(sizes[a], sizes[b]) >= similarity * np.maximum(sizes[a], sizes[b]) - 1e-9
        fits &= np.bitwise_count(low[a] ^ low[b]) + np.bitwise_count(high[a] ^ high[b]) <= SKETCH_RADIUS
        a, b = a[fits], b[fits]
        while len(a):
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
            if sets is None:
                x, y = a, b
            else:
                x, y, a, b = a[:step], b[:step], a[step:], b[step:]
                both = np.array([len(np.intersect1d(sets[order[i]], sets[order[j]], assume_unique=True)) for i, j in zip(x, y)], np.int64)
                alike = both >= similarity * (sizes[x] + sizes[y] - both) - 1e-9
                x, y = x[alike], y[alike]
            while len(x):
                u, v = label[x], label[y]
                apart = u != v
                x, y, u, v = x[apart], y[apart], u[apart], v[apart]
                np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
                while not np.array_equal(up := label[label], label):
                    label = up
    moved = np.flatnonzero(label != np.arange(len(codes)))
    return nodes[moved], nodes[label[moved]]


def _link_similar(similarity: float, verify: bool):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts)
        keys, nodes, sizes, *prints = (rows.column(c).to_numpy() for c in ("task", "node", "size", *PRINTS))
        _, keys, times = np.unique(keys, return_inverse=True, return_counts=True)
        at = np.flatnonzero(times[keys] > 1)
        sets = [np.unique(shingle_hashes(t, SIMILAR_SHINGLE)) for t in rows.column("text").take(pa.array(at)).to_pylist()] if verify else None
        a, b = _similar_stars(keys[at], nodes[at], sizes[at], *(x[at].view(np.uint64) for x in prints), similarity, sets)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return link


def similar_texts(docs: DataFrame, similarity: float = SIMILARITY, chunk_rows: int = CHUNK_ROWS, chunk_texts: int = CHUNK_TEXTS, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id and component_id, the smallest doc_id that links reach (null where none has an id).

    Texts link at a Jaccard similarity of ``similarity`` or more between their sets of five-word shingles, cut as in
    ``near_duplicates``; wordless and null texts are alike. The radii are far above the bits in which such sets differ: at 0.8 a
    bit of the fingerprint differs with probability 0.15 (up to 0.19 in short texts) and one of the sketch with 0.1, so 26 of 64 and 32 of
    128 bits are exceeded in less than one of 50,000 such pairs. Texts of similarity 0.1 have sketches within 32 bits about once in a million
    pairs, those of similarity 0.3 about once in a hundred, so candidates form small groups.

    A task holds two chunks at most, of ``chunk_rows`` rows without texts or ``chunk_texts`` texts, whatever the input; a group of n
    candidates copies each of its texts n / chunk_texts times. Copies are made in passes over the tasks, each of as many bytes as the candidates'
    texts (``pass_bytes`` if they have fewer), and a pass's copies go before the next one. An empty table gives an empty one, repeated rows one row
    each, other columns are ignored, and texts of any length are read whole.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    marked = staged(texts.mapInArrow(_describe(similarity), "doc_id long, text_hash long, node long, size int, fp long, low long, high long, prefix array<long>"), "shingle-sets")
    # one row stands for all with its shingle set; the sets' long columns stay where they are
    distinct = marked.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_hash")).alias("row"), *(F.first(c).alias(c) for c in ("size", *PRINTS)))
    distinct = staged(distinct, "distinct-shingle-sets")
    is_row = (F.col("text_hash") == F.col("row.text_hash")) & F.col("doc_id").eqNullSafe(F.col("row.doc_id"))
    standing = marked.select("doc_id", "text_hash", "prefix", "node").join(_small(distinct.select(F.col("node").alias("n"), "row", "size", *PRINTS)), (F.col("node") == F.col("n")) & is_row)
    dealt = standing.select("node", "size", *PRINTS, F.explode("prefix").alias("block"))
    tasks = _tasks(dealt, chunk_rows, "node").select("node", "size", *PRINTS, F.explode("tasks").alias("task"))
    loose = components(tasks.repartition("task").mapInArrow(_link_similar(similarity, False), "a long, b long"))
    members = staged(distinct.join(loose, "node"), "candidate-members")
    with_text = texts.join(_small(members.select("row", "node", "size", *PRINTS, F.col("root").alias("block"))), is_row)
    with_text = staged(with_text.select("node", "size", *PRINTS, "block", "text"), "candidate-texts")
    tasks, found = _tasks(with_text, chunk_texts, "node"), []
    passes = _passes(with_text, chunk_texts, pass_bytes)
    for k in range(passes):
        own = F.filter("tasks", lambda task: F.pmod(task, F.lit(passes)) == k)
        part = tasks.select("node", "size", *PRINTS, "text", F.explode(own).alias("task")).repartition("task")
        found.append(staged(part.mapInArrow(_link_similar(similarity, True), "a long, b long"), "similar-pairs"))
    roots = staged(components(reduce(DataFrame.unionByName, found)), "similar-roots")
    for done in (with_text, *found):
        unstaged(done)
    linked = distinct.select("node", "least_id").join(roots, "node", "left").select("node", "least_id", F.coalesce("root", "node").alias("root"))
    least = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_node = staged(linked.join(least, "root").select("node", "component_id"), "similar-components")
    return marked.select("doc_id", "node").join(by_node, "node").select("doc_id", "component_id")
