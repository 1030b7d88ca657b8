"""Compact sequences of whole numbers, read from memory-mapped words: fixed-width fields and Elias-Fano monotone sequences.

All reads take arrays of positions or targets and answer them together.
"""

from __future__ import annotations

import json
from functools import cached_property

import numpy as np

ONE = np.uint64(1)


class Fields:
    """Numbers of ``width`` bits side by side in 64-bit words."""

    def __init__(self, words: np.ndarray, width: int):
        self.words, self.width = words, width

    @staticmethod
    def packed(values: np.ndarray, width: int) -> np.ndarray:
        if not width or not len(values):
            return np.zeros(1, np.uint64)
        bytes_ = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, : -(-width // 8)]
        bits = np.unpackbits(bytes_, axis=1, count=width, bitorder="little")
        packed = np.packbits(bits.ravel(), bitorder="little")
        return np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(at), np.int64)
        first = at * self.width
        word, shift = first >> 6, (first & 63).astype(np.uint64)
        value = (self.words[word] >> shift) | ((self.words[word + 1] << ONE) << (np.uint64(63) - shift))
        return (value & np.uint64((1 << self.width) - 1)).astype(np.int64)


class Monotone:
    """A never falling sequence in Elias-Fano form: low bits in fields, high bits in unary."""

    def __init__(self, words: dict[str, np.ndarray], size: int, width: int, top: int):
        self.size, self.width, self.top = size, width, top
        self.low, self.high = Fields(words["low"], width), words["high"]

    def _bits(self) -> np.ndarray:
        return np.unpackbits(self.high.view(np.uint8), count=self.size + self.top + 1, bitorder="little").view(bool)

    @cached_property
    def ones(self) -> np.ndarray:
        """The place of each one, four bytes each; made when a number is read first."""
        return np.flatnonzero(self._bits()).astype(np.uint32)

    @cached_property
    def starts(self) -> np.ndarray:
        """How many numbers have smaller high bits, for all of up to ``top + 1``; made at the first search."""
        zeros = np.flatnonzero(~self._bits())
        return np.concatenate([[0], zeros - np.arange(self.top + 1)]).astype(np.uint32)

    @staticmethod
    def packed(values: np.ndarray) -> tuple[dict[str, np.ndarray], dict[str, int]]:
        n, last = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (last // max(n, 1)).bit_length() - 1)
        top = last >> width
        bits = np.zeros(-(-(n + top + 1) // 64) * 64, np.uint8)
        bits[(values >> width) + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        return {"low": Fields.packed(values & ((1 << width) - 1), width), "high": high}, {"size": n, "width": width, "top": top}

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return ((self.ones[at] - at) << self.width) | self.low[at]

    def successor(self, target: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The first place from ``begin`` up to ``end`` whose number is at least ``target`` (``end`` if none), and whether it is equal."""
        bucket, low = target >> self.width, target & ((1 << self.width) - 1)
        first, last = (self.starts[np.clip(b, 0, self.top + 1)].astype(np.int64) for b in (bucket, bucket + 1))
        if begin is not None:
            first, last = np.clip(first, begin, end), np.clip(last, begin, end)
        place, found = last.copy(), np.zeros(len(first), bool)
        open_ = np.flatnonzero(first < last)
        left, right, low = first[open_], last[open_], low[open_]
        equal = np.zeros(len(open_), bool)  # whether the number at ``right`` is the target's
        while len(open_):
            middle = (left + right) >> 1
            number = self.low[middle]
            less = number < low
            left, right, equal = np.where(less, middle + 1, left), np.where(less, right, middle), np.where(less, equal, number == low)
            done, more = left >= right, left < right
            place[open_[done]], found[open_[done]] = right[done], equal[done]
            open_, left, right, low, equal = (x[more] for x in (open_, left, right, low, equal))
        return place, found


def to_bytes(sequences: dict[str, np.ndarray], fields: dict[str, tuple[np.ndarray, int]]) -> bytes:
    """Monotone sequences, and fields of a width, as one block of words behind a header."""
    parts, header, at = [], {}, 0
    for name, values in sequences.items():
        words, about = Monotone.packed(values)
        header[name] = about | {"low": [at, len(words["low"])], "high": [at + len(words["low"]), len(words["high"])]}
        parts += [words["low"], words["high"]]
        at += len(words["low"]) + len(words["high"])
    for name, (values, width) in fields.items():
        words = Fields.packed(values, width)
        header[name] = {"width": width, "words": [at, len(words)]}
        parts.append(words)
        at += len(words)
    text = json.dumps(header).encode()
    text += b" " * (-len(text) % 8)
    return np.array([len(text)], np.uint64).tobytes() + text + np.concatenate(parts).tobytes()


def opened(path: str) -> dict[str, Monotone | Fields]:
    """What ``to_bytes`` gave, from a memory-mapped file."""
    words = np.asarray(np.memmap(path, np.uint64, mode="r"))
    size = int(words[0])
    header = json.loads(words[1 : 1 + size // 8].tobytes())
    words = words[1 + size // 8 :]
    part = lambda span: words[span[0] : span[0] + span[1]]
    out: dict[str, Monotone | Fields] = {}
    for name, x in header.items():
        if "size" in x:
            out[name] = Monotone({k: part(x[k]) for k in ("low", "high")}, x["size"], x["width"], x["top"])
        else:
            out[name] = Fields(part(x["words"]), x["width"])
    return out
