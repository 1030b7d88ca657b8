"""Removal of byte strings that repeat across documents, by interval expansion on Burrows-Wheeler transforms.

A position is covered if a string of ``LENGTH`` bytes over it also starts in a document with a smaller id.

1. Segments. Every string of LENGTH bytes has a minimiser: the leftmost ``GRAM``-byte substring with the least hash among
   its LENGTH - GRAM + 1. Neighbouring strings with one minimiser form a segment. Equal strings have equal minimisers, so
   only segments that share a minimiser can repeat each other. Tasks send (minimiser hash, document, place) packed by hash.
2. Candidates. Minimisers of several documents go back to these documents, whose segments are then cut from the texts.
   Copies of one segment within a task go through the expansion at once; only that of the smallest document goes on.
3. Intervals. Segments are dealt by minimiser. A task sorts the suffixes of a block of whole minimisers to depth LENGTH,
   which gives the Burrows-Wheeler transform, and extends all candidate strings backwards breadth first, ``STEP`` bytes a
   level: each interval of suffixes that share a prefix splits by the bytes before them, so common prefixes arise by
   increasing length. Intervals of one document are dropped; expansion stops at LENGTH. What is left are the strings
   that repeat, and all but their smallest document lose them. Copies enter once, with their smallest and largest document.
4. Removal. Covered ranges go back to their documents.

Only the bytes decide; hashes deal the work. The segments of a minimiser with more than ``HEAVY`` of them (or one in a million
of all strings, which bounds their number) are dealt by single strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ._common import staged

LENGTH, GRAM, STEP, FIRST = 50, 20, 10, 5
SLACK = LENGTH - GRAM
PIECE = 1 << 15
FLUSH = 1 << 19
OFTEN = 8
CUT = 200_000
BLOCK = 1 << 19
HEAVY, MOST_HEAVY = 4_000, 1_000_000
SEND_TASK, TEXT_TASK, EXPAND_TASK = 4 << 20, 16 << 20, 8 << 20  # bytes of text behind a task

_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_BYTE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_LOW = np.uint64(0xFFFF)


def _pair(h: np.ndarray, gap: int) -> np.ndarray:
    """Hashes of neighbours that lie ``gap`` apart."""
    out = h[: len(h) - gap] * _K[0]
    out += h[gap:] * _K[1]
    out ^= out >> np.uint64(31)
    out *= _K[2]
    return out


def _slid_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` values."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[: len(x) - done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(data, end of the own text for each byte, text number, offset of the piece's first byte in its text): texts joined
    to pieces of at most about PIECE bytes; pieces of a longer text overlap by LENGTH - 1."""
    held, size = [], 0
    for i, t in enumerate(texts):
        if len(t) < LENGTH:
            continue
        if size + len(t) > PIECE and held:
            yield _joined(texts, held)
            held, size = [], 0
        if len(t) > PIECE:
            whole = np.frombuffer(t, np.uint8)
            for a in range(0, len(t) - LENGTH + 1, PIECE):
                part = whole[a : a + PIECE + LENGTH - 1]
                yield part, np.full(len(part), len(part)), np.full(len(part), i), np.full(len(part), -a)
            continue
        held.append(i)
        size += len(t)
    if held:
        yield _joined(texts, held)


def _joined(texts: list[bytes], held: list[int]):
    lengths = np.array([len(texts[i]) for i in held])
    last = np.cumsum(lengths)
    return np.frombuffer(b"".join(texts[i] for i in held), np.uint8), np.repeat(last, lengths), np.repeat(np.array(held), lengths), np.repeat(last - lengths, lengths)


def segments(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, minimiser hash of 48 bits, first start, number of starts) of all segments; starts are offsets in the text."""
    for data, end, number, base in _pieces(texts):
        h1 = _BYTE[data]
        h4 = _pair(_pair(h1, 1), 2)
        gram = _pair(_pair(h4, 4), 8)
        gram = gram[: len(data) - GRAM + 1] * _K[0] + h4[16 : 16 + len(data) - GRAM + 1]
        gram ^= gram >> np.uint64(29)
        gram *= _K[2]
        gram |= _LOW
        gram ^= _LOW - np.arange(len(gram), dtype=np.uint64)  # the place in the low bits: ties go to the left
        least = _slid_least(gram, SLACK + 1)
        at = np.flatnonzero(np.arange(len(least)) + LENGTH <= end[: len(least)])
        best = least[at]
        new = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (at[1:] != at[:-1] + 1)]))
        first = at[new]
        yield number[first], best[new] >> np.uint64(16), first - base[first], np.diff(np.append(new, len(at)))


def _planes(values: np.ndarray, width: int = 8) -> bytes:
    """The low ``width`` bytes of each number, byte by byte, which compresses better."""
    return values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unplanes(blob: bytes, width: int = 8) -> np.ndarray:
    full = np.zeros((len(blob) // width, 8), np.uint8)
    full[:, :width] = np.frombuffer(blob, np.uint8).reshape(width, -1).T
    return full.view("<i8").ravel()


PACKED = "part int, kind string, anchor binary, doc binary, low binary, run binary"
_PACKED = pa.schema([("part", pa.int32()), ("kind", pa.string()), *[(c, pa.binary()) for c in ("anchor", "doc", "low", "run")]])


def _split(part: np.ndarray) -> list[np.ndarray]:
    """Row numbers of each part, in their order."""
    order = np.argsort(part, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(part[order])) + 1)


def _pack(part: np.ndarray, kind: str, anchor, doc, low, run) -> pa.RecordBatch:
    """One row for each part, its columns as differences, byte by byte."""
    rows = [(int(part[o[0]]), kind, _planes(anchor[o], 6), _planes(np.diff(doc[o], prepend=0)), _planes(np.diff(low[o], prepend=0)), _planes(run[o], 1)) for o in _split(part)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PACKED)], schema=_PACKED)


def _unpack(rows: list[dict]) -> tuple[np.ndarray, ...]:
    """(anchor, doc, low, run) of packed rows."""
    made = [(_unplanes(r["anchor"], 6), np.cumsum(_unplanes(r["doc"])), np.cumsum(_unplanes(r["low"])), _unplanes(r["run"], 1)) for r in rows]
    return tuple(np.concatenate(c) for c in zip(*made)) if made else (np.empty(0, np.int64),) * 4


def _home(doc: np.ndarray, parts: int) -> np.ndarray:
    """The part of a document, the same as ``_home_column`` gives."""
    return (doc ^ (doc >> 15) ^ (doc >> 31)) % parts


def _home_column(parts: int):
    doc = F.col("doc_id")
    return F.pmod(doc.bitwiseXOR(F.shiftright(doc, 15)).bitwiseXOR(F.shiftright(doc, 31)), F.lit(parts)).cast("int")


def _send(parts: int, homes: int):
    """Segments packed by minimiser. Where one task sees a minimiser in several documents and more than OFTEN times, its
    segments are known as candidates, and only the smallest and largest document, with the count, stand for them with the others."""

    def flushed(held):
        anchor, doc, low, run = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(anchor, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(anchor[order]) != 0]))
        least, most = np.minimum.reduceat(doc[order], first), np.maximum.reduceat(doc[order], first)
        count = np.diff(np.append(first, len(order)))
        often = (count > OFTEN) & (least < most)
        known = np.empty(len(order), bool)
        known[order] = np.repeat(often, count)
        if known.any():
            yield _pack(_home(doc[known], homes) % parts, "known", anchor[known], doc[known], low[known], run[known])
            stand, n = np.repeat(anchor[order][first[often]], 2), count[often]
            ends, halves = np.stack([least[often], most[often]], 1).ravel(), np.stack([n // 2, n - n // 2], 1).ravel()
            yield _pack(stand % parts, "stand", stand, ends, halves, np.zeros(len(stand), np.int64))
        if not known.all():
            yield _pack(anchor[~known] % parts, "one", anchor[~known], doc[~known], low[~known], run[~known])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for number, anchor, low, run in segments(batch.column("text").to_pylist()):
                held.append((anchor.astype(np.int64), ids[number], low, run))
                size += len(low)
                if size > FLUSH:
                    yield from flushed(held)
                    held, size = [], 0
        if held:
            yield from flushed(held)

    return send


def _resolve(homes: int, heavy: int):
    """Segments whose minimiser several documents have, packed by document; and, as rows of kind heavy, the minimisers with
    more than ``heavy`` segments."""

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        anchor, doc, low, run = _unpack([r for r in rows if r["kind"] != "known"])
        if len(anchor):
            order = np.argsort(anchor, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(anchor[order]) != 0]))
            shared = np.minimum.reduceat(doc[order], first) < np.maximum.reduceat(doc[order], first)
            many = np.add.reduceat(np.where(run > 0, 1, low)[order], first) > heavy
            keep = order[np.repeat(shared, np.diff(np.append(first, len(order))))]
            keep = keep[run[keep] > 0]
            if len(keep):
                yield _pack(_home(doc[keep], homes), "place", anchor[keep], doc[keep], low[keep], run[keep])
            if many.any():
                named = anchor[order][first[many]]
                none = np.zeros(len(named), np.int64)
                yield _pack(none, "heavy", named, none, none, none)
        anchor, doc, low, run = _unpack([r for r in rows if r["kind"] == "known"])
        if len(anchor):
            yield _pack(_home(doc, homes), "place", anchor, doc, low, run)

    return resolve


def suffix_order(data: np.ndarray) -> np.ndarray:
    """Suffix numbers in the order of their first LENGTH bytes, zeros following the last; for up to 2^21 bytes."""
    n = len(data)
    bits = np.uint64(max(1, int(n).bit_length()))
    mask, here = np.uint64((1 << int(bits)) - 1), np.arange(n, dtype=np.uint64)
    rank = np.zeros(n, np.uint64)
    for k in range(FIRST):
        rank <<= np.uint64(8)
        rank[: n - k] |= data[k:]
    done, top = FIRST, rank
    while True:
        key = np.sort((top << bits) | here)
        order = (key & mask).astype(np.int64)
        if done == LENGTH:
            return order
        key >>= bits
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[1], key[1:] != key[:-1]])).astype(np.uint64)
        step = min(done, LENGTH - done)
        top = rank << bits
        top[: n - step] |= rank[step:]
        done += step


def repeated(data: np.ndarray, start: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each start, whether its string of LENGTH bytes also starts in a document smaller than its least, or its most.

    The documents that have a start's copy are given by the least and the most of them. Breadth-first backward extension
    over the Burrows-Wheeler transform, STEP bytes a level: a level holds, in suffix order, the intervals of strings that
    several documents have, beginning with the empty string at the end of each.
    """
    data = np.concatenate([data, np.zeros(LENGTH, np.uint8)])
    order = suffix_order(data)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    head = np.lib.stride_tricks.sliding_window_view(data, 8).copy().view(np.uint64).ravel()  # bytes 0 to 7 of a place, 2 to 9 by its second next
    at, member = rank[start + LENGTH], np.arange(len(start))
    interval = np.zeros(len(start), np.int64)
    bits = np.int64(max(1, len(start).bit_length()))
    found = np.zeros((2, len(start)), bool)
    for _ in range(LENGTH // STEP):
        moved = np.sort((rank[order[at] - STEP] << bits) | np.arange(len(at)))
        turned, at = moved & ((1 << bits) - 1), moved >> bits
        member, interval, place = member[turned], interval[turned], order[at]
        a, b = head[place], head[place + STEP - 8]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (interval[1:] != interval[:-1])])  # a common prefix ends here
        first = np.flatnonzero(new)
        smallest = np.minimum.reduceat(least[member], first)
        keep = np.repeat(smallest < np.maximum.reduceat(most[member], first), np.diff(np.append(first, len(at))))
        if not keep.any():
            return found[0], found[1]
        at, member = at[keep], member[keep]
        interval = np.cumsum(new)[keep] - 1
    smallest = smallest[interval]
    found[0, member], found[1, member] = least[member] > smallest, most[member] > smallest
    return found[0], found[1]


def _ranges(texts: list[bytes], least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text number, offset, length, 0 or 1) of the runs of starts that repeat, for each text's least document and for its others."""
    lengths = np.array([len(t) for t in texts])
    runs = lengths - LENGTH + 1
    row = np.repeat(np.arange(len(texts)), runs)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
    out = []
    for which, flags in enumerate(repeated(np.frombuffer(b"".join(texts), np.uint8), (np.cumsum(lengths) - lengths)[row] + offset, least[row], most[row])):
        hit = np.flatnonzero(flags)
        new = np.flatnonzero(np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])])) if len(hit) else hit
        out.append((row[hit[new]], offset[hit[new]], np.diff(np.append(new, len(hit))), np.full(len(new), which)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _decided(texts: list[bytes], code: np.ndarray, doc: np.ndarray, several_only: bool) -> tuple[np.ndarray, ...]:
    """(row, offset, length) of covered starts of rows of segment ``code`` in document ``doc``, and each code's smallest document.

    ``several_only`` leaves out segments of one document; the others need not meet each other then, so any blocks will do.
    """
    order = np.lexsort((doc, code))
    first = np.flatnonzero(np.concatenate([[True], np.diff(code[order]) != 0]))
    least = doc[order][first]
    most = doc[order][np.append(first[1:], len(order)) - 1]
    chosen = np.flatnonzero(most > least) if several_only else np.arange(len(texts))
    size = np.cumsum([len(texts[i]) for i in chosen])
    block = size // BLOCK if several_only else np.zeros(len(chosen), np.int64)
    found = [(np.empty(0, np.int64),) * 4]
    for b in np.unique(block):
        now = chosen[block == b]
        number, offset, length, which = _ranges([texts[i] for i in now], least[now], most[now])
        found.append((2 * now[number] + which, offset, length, which))
    entry, offset, length, _ = (np.concatenate(x) for x in zip(*found))
    # rows take the verdict of their segment: the smallest document's rows one, all others the other
    order = np.argsort(entry, kind="stable")
    mine = 2 * code + (doc > least[code])
    begin, end = np.searchsorted(entry[order], mine), np.searchsorted(entry[order], mine, "right")
    many = end - begin
    row = np.repeat(np.arange(len(code)), many)
    pick = order[np.repeat(begin, many) + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)]
    return row, offset[pick], length[pick], least


_FOUND = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("low", pa.binary()), ("run", pa.binary())])
FOUND = "doc_id long, text_key long, low binary, run binary"


def _by_text(doc: np.ndarray, key: np.ndarray, low: np.ndarray, run: np.ndarray) -> pa.RecordBatch:
    """Ranges of starts, one row per text."""
    order = np.lexsort((low, key, doc))
    doc, key, low, run = doc[order], key[order], low[order].astype(np.int64), run[order].astype(np.int64)
    cut = np.concatenate([[0], np.flatnonzero((np.diff(doc) != 0) | (np.diff(key) != 0)) + 1, [len(doc)]])
    blobs = [[x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])] for x in (low, run)]
    return pa.RecordBatch.from_arrays([pa.array(doc[cut[:-1]]), pa.array(key[cut[:-1]]), *[pa.array(b, pa.binary()) for b in blobs]], schema=_FOUND)


# a row holds covered ranges of one text, or many segments: their minimisers, starts, bytes and rows, and documents, keys and places by row
CANDIDATES = FOUND + ", part int, anchor binary, runs binary, bytes binary, rows binary, docs binary, keys binary, places binary"
_CANDIDATES = pa.schema([*_FOUND, ("part", pa.int32()), *[(c, pa.binary()) for c in ("anchor", "runs", "bytes", "rows", "docs", "keys", "places")]])


def _going(parts: int, texts: list[bytes], code, anchor, doc, key, place) -> pa.RecordBatch:
    """Segments packed by the part that their minimisers are dealt to; each one's bytes once, compressed."""
    order = np.argsort(code, kind="stable")
    code, anchor, doc, key, place = (x[order] for x in (code, anchor, doc, key, place))
    first = np.flatnonzero(np.concatenate([[True], np.diff(code) != 0]))
    count = np.diff(np.append(first, len(code)))
    rows = []
    for o in _split(anchor[first] % parts):
        mine = np.repeat(first[o], count[o]) + np.arange(count[o].sum()) - np.repeat(np.cumsum(count[o]) - count[o], count[o])
        held = [texts[i] for i in code[first[o]].tolist()]
        runs = np.array([len(t) - LENGTH + 1 for t in held])
        packed = pa.compress(b"".join(held), codec="zstd", asbytes=True)
        rows.append((int(anchor[first[o[0]]] % parts), _planes(anchor[first[o]], 6), _planes(runs, 1), packed, _planes(count[o]), _planes(np.diff(doc[mine], prepend=0)), _planes(key[mine]), _planes(np.diff(place[mine], prepend=0))))
    none = [pa.nulls(len(rows), f.type) for f in _FOUND]
    return pa.RecordBatch.from_arrays([*none, *[pa.array(c, f.type) for c, f in zip(zip(*rows), list(_CANDIDATES)[4:])]], schema=_CANDIDATES)


def _covered(parts: int, doc, key, low, run) -> pa.RecordBatch:
    made = _by_text(doc, key, low, run)
    part = pa.array(made.column("text_key").to_numpy() % parts, pa.int32())
    return pa.RecordBatch.from_arrays([*made.columns, part, *[pa.nulls(len(made), f.type) for f in list(_CANDIDATES)[5:]]], schema=_CANDIDATES)


def _singles(texts: list[bytes], code, anchor, doc, key, place) -> tuple:
    """The same strings as segments of one start each, with hashes of their own in place of minimisers."""
    codes: dict[bytes, int] = {}
    made = []
    for c, d, k, p in zip(code.tolist(), doc.tolist(), key.tolist(), place.tolist()):
        made += [(codes.setdefault(texts[c][i : i + LENGTH], len(codes)), d, k, p + i) for i in range(len(texts[c]) - LENGTH + 1)]
    code, doc, key, place = np.array(made, np.int64).T
    own = np.array([int.from_bytes(hashlib.blake2b(t, digest_size=6).digest(), "little") for t in codes], np.int64)
    return list(codes), code, own[code], doc, key, place


def _candidates(parts: int, heavy: Broadcast):
    """Cuts candidate segments out of the texts (packed places come first), decides copies within the task and packs what is left."""

    def flushed(codes, rows):
        texts = list(codes)
        code, anchor, doc, key, place = np.array(rows, np.int64).T
        row, offset, length, least = _decided(texts, code, doc, True)
        lost = doc > least[code]
        mine = lost[row]  # those of the smallest document are judged again, with all others
        if mine.any():
            yield _covered(parts, doc[row[mine]], key[row[mine]], place[row[mine]] + offset[mine], length[mine])
        many = np.isin(anchor, heavy.value)
        for those, cut in ((~lost & ~many, lambda *x: x), (~lost & many, _singles)):
            if those.any():
                yield _going(parts, *cut(texts, *(x[those] for x in (code, anchor, doc, key, place))))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, places = [], None
        codes: dict[bytes, int] = {}
        rows: list[tuple] = []
        for batch in batches:
            kinds = batch.column("text").is_valid().to_numpy(zero_copy_only=False)
            if not kinds.all():
                packed += batch.filter(pa.array(~kinds)).select(["anchor", "doc", "low", "run"]).to_pylist()
                batch = batch.filter(pa.array(kinds))
            if not len(batch):
                continue
            if places is None:
                anchor, doc, low, run = _unpack(packed)
                order = np.lexsort((low, doc))
                packed, places = [], tuple(x[order] for x in (doc, anchor, low, run))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            begin, end = np.searchsorted(places[0], ids), np.searchsorted(places[0], ids, "right")
            for text, i, key, b, e in zip(batch.column("text"), ids.tolist(), batch.column("text_key").to_pylist(), begin.tolist(), end.tolist()):
                if b == e:
                    continue
                text = text.as_py()
                for a, s, r in zip(places[1][b:e].tolist(), places[2][b:e].tolist(), places[3][b:e].tolist()):
                    if s + r + LENGTH - 1 <= len(text):  # another row of this doc_id may be shorter
                        rows.append((codes.setdefault(text[s : s + r + LENGTH - 1], len(codes)), a, i, key, s))
                if len(rows) > CUT:
                    yield from flushed(codes, rows)
                    codes, rows = {}, []
        if rows:
            yield from flushed(codes, rows)

    return candidates


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered ranges of packed segments, in blocks of whole minimisers; ranges that come in go out as they are."""
    packed = []
    for batch in batches:
        done = batch.column("low").is_valid()
        yield batch.filter(done).select(_FOUND.names)
        packed += batch.filter(pa.compute.invert(done)).to_pylist()
    if not packed:
        return
    texts: list[bytes] = []
    for r in packed:
        size = _unplanes(r["runs"], 1) + LENGTH - 1
        data = pa.decompress(r.pop("bytes"), decompressed_size=int(size.sum()), codec="zstd", asbytes=True)
        end = np.cumsum(size)
        texts += [data[a:b] for a, b in zip((end - size).tolist(), end.tolist())]
    anchor, count = (np.concatenate([_unplanes(r[c], w) for r in packed]) for c, w in (("anchor", 6), ("rows", 8)))
    doc, place = (np.concatenate([np.cumsum(_unplanes(r[c])) for r in packed]) for c in ("docs", "places"))
    key = np.concatenate([_unplanes(r["keys"]) for r in packed])
    del packed
    begin = np.cumsum(count) - count
    order = np.argsort(anchor, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(anchor[order]) != 0]))
    size = np.add.reduceat(np.array([len(t) for t in texts])[order], starts)
    block = np.repeat((np.cumsum(size) - size) // BLOCK, np.diff(np.append(starts, len(order))))
    for now in np.split(order, np.flatnonzero(np.diff(block)) + 1):
        codes: dict[bytes, int] = {}
        code = np.repeat([codes.setdefault(texts[i], len(codes)) for i in now.tolist()], count[now])
        mine = np.repeat(begin[now], count[now]) + np.arange(count[now].sum()) - np.repeat(np.cumsum(count[now]) - count[now], count[now])
        block_rows = list(codes), code, doc[mine], key[mine], place[mine]
        for part in [block_rows] if sum(map(len, codes)) <= 3 * BLOCK else _by_string(*block_rows):
            row, offset, length, _ = _decided(*part[:3], False)
            if len(row):
                yield _by_text(part[2][row], part[3][row], part[4][row] + offset, length)


def _by_string(texts: list[bytes], code, doc, key, place) -> Iterator[tuple]:
    """Blocks of single strings, for a minimiser that is too large for a block of its own."""
    held, code, own, doc, key, place = _singles(texts, code, code, doc, key, place)
    order = np.argsort(own, kind="stable")
    new = np.cumsum(np.diff(own[order], prepend=own[order[0]]) != 0)
    at = np.searchsorted(new, new)  # where a value begins: its strings stay together
    for rows in np.split(order, np.flatnonzero(np.diff(at * LENGTH // BLOCK)) + 1):
        used, now = np.unique(code[rows], return_inverse=True)
        yield [held[i] for i in used.tolist()], now, doc[rows], key[rows], place[rows]


def _keep(text: bytes, low: np.ndarray, high: np.ndarray) -> tuple[bytes, int, int]:
    """What is left of ``text`` without the spans, bytes removed, and maximal removed runs."""
    change = np.zeros(len(text) + 1, np.int32)
    np.add.at(change, low, 1)
    np.add.at(change, high, -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def _remove(schema: pa.Schema):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, size, removed, spans = [], [], [], []
            for text, lows, runs in zip(*(batch.column(c).to_pylist() for c in ("__text", "__low", "__run"))):
                text = text or b""
                size.append(len(text))
                if lows:
                    low = np.frombuffer(b"".join(lows), np.int64)
                    text, n, m = _keep(text, low, low + np.frombuffer(b"".join(runs), np.int64) + LENGTH - 1)
                kept.append(text)
                removed.append(n if lows else 0)
                spans.append(m if lows else 0)
            made = {"kept": pa.array(kept, pa.binary())} | {c: pa.array(x, pa.int64()) for c, x in (("n_bytes", size), ("n_removed", removed), ("n_spans", spans))}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in schema.names], schema=schema)

    return remove


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without ``text``, with kept (binary), n_bytes, n_removed and n_spans (maximal removed runs).

    Texts are UTF-8 bytes; null counts as empty. Texts of any length are taken whole. Matches never cross documents, a
    document is not compared with itself, nor are rows that share a doc_id (repeated rows have the same result); a null
    doc_id is neither larger nor smaller than another, so its row stays whole. Columns named as the added ones are
    replaced; all others stay. Empty in, empty out.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, homes, ends = (int(total // size) + 8 for size in (SEND_TASK, TEXT_TASK, EXPAND_TASK))
    sent = texts.select("doc_id", "text").where(F.octet_length("text") >= LENGTH).mapInArrow(_send(parts, homes), PACKED)
    heavy = max(HEAVY, total // MOST_HEAVY)
    shared = staged(sent.repartitionById(parts, F.col("part")).mapInArrow(_resolve(homes, heavy), PACKED), "places")
    named = _unpack([r.asDict() for r in shared.where("kind = 'heavy'").collect()])[0]  # at most MOST_HEAVY
    named = docs.sparkSession.sparkContext.broadcast(named)
    looked = shared.where("kind = 'place'").withColumnRenamed("part", "home").unionByName(texts.withColumn("home", _home_column(homes)), allowMissingColumns=True)
    looked = looked.repartitionById(homes, F.col("home")).sortWithinPartitions(F.col("text").isNotNull(), "doc_id")
    going = looked.mapInArrow(_candidates(ends, named), CANDIDATES).repartitionById(ends, F.col("part"))
    covered = staged(going.mapInArrow(_expand, FOUND), "covered")
    covered = covered.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.collect_list("low").alias("__low"), F.collect_list("run").alias("__run"))
    added = ("kept", "n_bytes", "n_removed", "n_spans")
    rest = [c for c in docs.columns if c not in ("text", *added)]
    out = T.StructType([*docs.select(*rest).schema, T.StructField("kept", T.BinaryType()), *[T.StructField(c, T.LongType()) for c in added[1:]]])
    joined = docs.select(*rest, F.col("text").cast("binary").alias("__text"))
    same = (F.col("doc_id") == F.col("__id")) & (F.xxhash64(F.coalesce(F.col("__text"), F.lit("").cast("binary"))) == F.col("__key"))
    joined = joined.join(covered.hint("shuffle_hash"), same, "left").drop("__id", "__key")
    return joined.mapInArrow(_remove(to_arrow_schema(out)), out)
