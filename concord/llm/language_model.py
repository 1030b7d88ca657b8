"""Language models in Elias-Fano tries, and the scores of texts under them.

``learned_scores`` learns a model of order three from some rows of a table and scores all of them. With counts c, the probability
of a token w after words u, v is (c(uvw) + m3 p(w|v)) / (c(uv) + m3), and p(w|v) is (c(vw) + m2 p(w)) / (c(v) + m2), where p(w) is the
token's share of all tokens (a hierarchical Dirichlet model). The trie of a shard has v on its first level, pairs on its second (the
successors of v, and the words before it) and trigrams on its third. On the third level a successor is not numbered as a word but by
its place among the successors of v, so its numbers are as small as v has few (context-based numbering of words). A trigram is where
its pair (v, w) is, as is the weight m3 / (c(vw) + m3) of the context that (v, w) is for the next token: a token's logarithm is the sum
of what two shards know, and one exchange of the tokens serves to learn and to score.

``fit`` and ``score`` keep a model of order two and apply it to any table: the probability of a token after a word is its discounted share of the word's successors, plus what the
discount left over times the token's share of all tokens. A trie has the contexts (words) on its first level, with their
left-over weights and counts and with monotone pointers to the second level, the successors of each context. Both levels are
monotone sequences in Elias-Fano form with probabilities quantised to twelve bits, rounded down so that they never
sum to more than one. A successor is numbered relative to its context, so one search of a target number between two pointers
finds it.

Tries are shards of bounded size, dealt by context; a context with very many tokens is dealt to several shards by successor. No
task or driver ever holds the whole model: queries go to the shard that can answer them, as packed blocks of one batch of texts,
and what comes back is summed by text. Only a bounded number of the most frequent words is known to every task. A trie is a
file that a task maps into memory.
"""

from __future__ import annotations

import itertools
import os
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import elias_fano
from ._common import staged

DISCOUNT = 0.75
LEVEL_BITS, STEPS = 12, 256  # log10 probabilities in steps of 1/256 down to -16
FREQUENT = 1 << 19
SHARD_TOKENS = 1_000_000
PIECE = 4 << 20
END, BEGIN = 1 << 20, (1 << 20) + 1  # codes; words below are frequent ones, in the order of their counts
RARE = 1 << 62
BLANKS = b" \t\n\x0b\x0c\r"


def held_out() -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _pieces(texts: pa.Array) -> Iterator[list[tuple[int, bytes, bool]]]:
    """(text's number, piece, whether it is the last) in groups of bounded size; texts are only cut at blanks."""
    group, size = [], 0
    for i, text in enumerate(texts):
        whole = (text.as_py() or b"") if text.is_valid else b""
        at = 0
        while True:
            stop = len(whole)
            if stop - at > PIECE:
                stop = at + PIECE
                while stop < len(whole) and whole[stop] not in BLANKS:
                    stop += 1
            group.append((i, whole[at:stop], stop == len(whole)))
            size += stop - at
            if size >= PIECE:
                yield group
                group, size = [], 0
            if stop == len(whole):
                break
            at = stop
    if group:
        yield group


def _tokens(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words: the piece's number and the number of the word among distinct ones, whose hashes come third."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(pieces, pa.binary()).view(pa.string())))
    words, owner = split.flatten(), pc.list_parent_indices(split)
    full = pc.greater(pc.binary_length(words), 0)
    words, owner = words.filter(full).dictionary_encode(), owner.filter(full).to_numpy()
    each = words.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False)
    distinct = np.fromiter(map(xxhash.xxh3_64_intdigest, each), np.uint64, len(each))
    return owner, words.indices.to_numpy(), distinct.view(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for group in _pieces(batch.column("text")):
            _, word, distinct = _tokens([p for _, p, _ in group])
            yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(np.bincount(word, minlength=len(distinct)))], names=["word", "count"])


@dataclass
class Vocabulary:
    """What every task knows: totals, and the frequent words (at most a bounded number) with their counts."""

    n_docs: int
    n_words: int
    n_distinct: int
    hashes: np.ndarray  # sorted
    codes: np.ndarray  # of these hashes
    counts: np.ndarray  # by code; at END and BEGIN the number of texts
    shards: int
    shard_tokens: int
    rest: np.ndarray | None = None  # by code: left-over weight of contexts that lie in several shards, else 0

    @property
    def n_tokens(self) -> int:
        return self.n_words + self.n_docs

    @property
    def base(self) -> int:
        """N + 1 * (V + 1)."""
        return self.n_tokens + self.n_distinct + (self.n_docs > 0) + 1

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Codes of words, frequent or not."""
        out = RARE | ((hashes >> 2) & (RARE - 1))
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            out = np.where(self.hashes[at] == hashes, self.codes[at], out)
        return out

    def shared(self, codes: np.ndarray) -> np.ndarray:
        """Share of all tokens; words that are not frequent, known or not, have one share of what is left of N + 1."""
        frequent = codes < RARE
        rare_tokens = self.n_tokens - self.counts[:END].sum() - self.n_docs
        rare_words = self.n_distinct - len(self.hashes)
        out = np.full(len(codes), (rare_tokens + 1) / (rare_words + 1) / (self.n_tokens + 1))
        count = self.counts[codes[frequent]]
        out[frequent] = np.where(count > 0, count / (self.n_tokens + 1), out[frequent])  # without texts to learn from no end is known
        return out

    def spread(self, context: np.ndarray) -> np.ndarray:
        """Over how many shards a context is dealt."""
        frequent = context < RARE
        out = np.ones(len(context), np.int64)
        out[frequent] = np.clip(-(-4 * self.counts[context[frequent]] // self.shard_tokens), 1, self.shards)
        return out


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(20)).astype(np.int64)


def _ranked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the rank of each code; of many codes only rare ones are sorted."""
    if len(codes) < END >> 4:
        return np.unique(codes, return_inverse=True)
    rare = np.flatnonzero(codes > BEGIN)
    seen = np.zeros(BEGIN + 2, bool)
    if not len(rare):
        seen[codes] = True
        return np.flatnonzero(seen), (np.cumsum(seen) - 1)[codes]
    distinct, back = np.unique(codes[rare], return_inverse=True)
    small = codes.copy()
    small[rare] = BEGIN + 1
    seen[small] = True
    seen[-1] = False
    frequent = np.flatnonzero(seen)
    rank = (np.cumsum(seen) - 1)[small]
    rank[rare] = len(frequent) + back
    return np.concatenate([frequent, distinct]), rank


def _planes(values: np.ndarray, width: int) -> bytes:
    """Bytes of equal rank side by side, which compresses well."""
    return values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def _unplaned(blob: bytes, n: int, width: int) -> np.ndarray:
    return np.frombuffer(blob, np.uint8).reshape(width, n).T.copy().view(f"<u{width}").ravel().astype(np.int64)


def pack(context: np.ndarray, word: np.ndarray, extra: np.ndarray) -> bytes:
    """Rows (context, word, extra) sorted by context; extra is below 2^32."""
    first = np.flatnonzero(np.diff(context, prepend=-1))
    rare = word >= RARE
    parts = [_planes(context[first], 8), _planes(np.diff(np.append(first, len(context))), 4), _planes(np.where(rare, RARE >> 40, word), 4), _planes(word[rare], 8), _planes(extra, 4)]
    return struct.pack("<3I", len(first), len(context), int(rare.sum())) + pa.compress(b"".join(parts), "zstd", asbytes=True)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct contexts, the number of each row's context among them, words, extras."""
    m, n, r = struct.unpack_from("<3I", blob)
    sizes = [8 * m, 4 * m, 4 * n, 8 * r, 4 * n]
    body = pa.decompress(blob[12:], sum(sizes), "zstd", asbytes=True)
    at = np.cumsum([0, *sizes])
    contexts, times, word, rare, extra = (_unplaned(body[at[k] : at[k + 1]], size // width, width) for k, (size, width) in enumerate(zip(sizes, (8, 4, 4, 8, 4))))
    word[word == RARE >> 40] = rare
    return contexts, np.repeat(np.arange(m), times), word, extra


#: Bytes of a trigram in a block: its context, word and word before, and what else is said of it. A rare code is marked, and follows in full.
WIDTHS, MARK = (3, 3, 3, 4), (1 << 21) - 1


def packed3(context: np.ndarray, word: np.ndarray, before: np.ndarray, extra: np.ndarray, cuts: list[int]) -> Iterator[bytes]:
    """A block of the rows between any two ``cuts``: a byte of equal rank side by side, as in ``pack``."""
    planes, rare = np.empty((sum(WIDTHS), len(context)), np.uint8), []
    k = 0
    for column, width in zip((context, word, before, extra), WIDTHS):
        if width == 3:
            at = np.flatnonzero(column >= RARE)
            rare.append((column[at].astype("<u8"), np.searchsorted(at, cuts).tolist()))
            column = np.minimum(column, MARK)
        for byte in range(width):
            planes[k] = column >> 8 * byte
            k += 1
    for i, (a, b) in enumerate(itertools.pairwise(cuts)):
        full = [codes[places[i] : places[i + 1]] for codes, places in rare]
        body = planes[:, a:b].tobytes() + b"".join(x.tobytes() for x in full)
        yield struct.pack("<4I", b - a, *map(len, full)) + pa.compress(body, "zstd", asbytes=True)


def pack3(context: np.ndarray, word: np.ndarray, before: np.ndarray, extra: np.ndarray) -> bytes:
    """One block of all rows."""
    return next(packed3(context, word, before, extra, [0, len(context)]))


def unpacked3(blocks: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Contexts, words, words before and extras of the blocks' rows, and how many rows each block has."""
    planes, rare, sizes = [], ([], [], []), []
    for block in blocks:
        n, *full = struct.unpack_from("<4I", block)
        body = pa.decompress(memoryview(block)[16:], sum(WIDTHS) * n + 8 * sum(full), "zstd", asbytes=True)
        planes.append(np.frombuffer(body, np.uint8, sum(WIDTHS) * n).reshape(sum(WIDTHS), n))
        sizes.append(n)
        at = sum(WIDTHS) * n
        for codes, m in zip(rare, full):
            if m:
                codes.append(np.frombuffer(body, "<i8", m, at))
            at += 8 * m
    planes = np.concatenate(planes, axis=1)
    columns, k = [], 0
    for i, width in enumerate(WIDTHS):
        column = planes[k].astype(np.uint32)
        for byte in range(1, width):
            column |= planes[k + byte].astype(np.uint32) << np.uint32(8 * byte)
        column = column.astype(np.int64)
        if i < 3 and rare[i]:
            column[column == MARK] = np.concatenate(rare[i])
        columns.append(column)
        k += width
    return columns, np.array(sizes)


@dataclass
class _Ngrams:
    """All tokens of a group of pieces, ends included: their texts' numbers, and tokens, contexts and the words before as places in sorted ``codes``."""

    doc: np.ndarray
    context: np.ndarray
    token: np.ndarray
    codes: np.ndarray
    before: np.ndarray | None = None

    def dealt(self, vocabulary: Vocabulary) -> np.ndarray:
        """The shard of each."""
        home, spread = _mixed(self.codes) % vocabulary.shards, vocabulary.spread(self.codes)
        shard = home[self.context]
        wide = np.flatnonzero((spread > 1)[self.context])
        shard[wide] = (shard[wide] + _mixed(self.codes)[self.token[wide]] % spread[self.context[wide]]) % vocabulary.shards
        return shard

    def keys(self) -> np.ndarray:
        """A number for each (context, token), in their order."""
        return self.context * len(self.codes) + self.token


def _ngrams(group, last: dict[int, tuple[int, int]], vocabulary: Vocabulary) -> _Ngrams:
    """``last`` carries the last two words of a text over a cut."""
    owner, word, distinct = _tokens([p for _, p, _ in group])
    codes, rank = _ranked(np.concatenate([vocabulary.of(distinct), np.array([END, BEGIN, *(c for i, _, _ in group if i in last for c in last[i])], np.int64)]))
    end, begin = rank[len(distinct) : len(distinct) + 2]
    doc = np.array([i for i, _, _ in group], np.int64)
    n = np.bincount(owner, minlength=len(group))
    ends = np.array([e for _, _, e in group])
    size = n + ends
    start = np.cumsum(size) - size
    token = np.full(size.sum(), end, np.int64)
    token[np.arange(len(word)) + np.repeat(start - (np.cumsum(n) - n), n)] = rank[word]
    context = np.empty_like(token)
    context[1:] = token[:-1]
    before = np.empty_like(token)
    held = {}
    for k, (i, _, _) in enumerate(group):  # what stands before a piece is the text's beginning, or its last words before the cut
        if size[k]:
            held[start[k]], context[start[k]] = np.searchsorted(codes, last[i]) if i in last else (begin, begin)
            if not ends[k]:
                z = start[k] + size[k] - 1
                last[i] = (int(codes[context[z]]), int(codes[token[z]]))
    before[1:] = context[:-1]
    before[list(held)] = list(held.values())
    return _Ngrams(np.repeat(doc, size), context, token, codes, before)


def _order(shard: np.ndarray) -> np.ndarray:
    """Rows by shard; numpy sorts numbers of 16 bits fastest."""
    return np.argsort(shard.astype(np.min_scalar_type(int(shard.max(initial=0)))), kind="stable")


def _by_shard(shard: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    shard = shard[order]
    cuts = _cuts(shard)
    for a, b in zip(cuts, cuts[1:]):
        yield int(shard[a]), order[a:b]


def _cuts(sorted_: np.ndarray) -> list[int]:
    """Where runs of equal numbers begin, and the end."""
    return [*np.flatnonzero(np.diff(sorted_, prepend=-1)).tolist(), len(sorted_)]


def _shard_order(shard: np.ndarray, keys: np.ndarray, top: int) -> np.ndarray:
    """Rows by shard and then by their keys, which are below ``top``."""
    if (int(shard.max(initial=0)) + 1) * top < 1 << 63:
        return np.argsort(shard * top + keys)
    return np.lexsort((keys, shard))


def _count_bigrams(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            last: dict[int, tuple[int, int]] = {}
            for group in _pieces(batch.column("text")):
                all_ = _ngrams(group, last, vocabulary)
                keys, times = np.unique(all_.keys(), return_counts=True)
                one = _Ngrams(keys, *np.divmod(keys, len(all_.codes)), all_.codes)
                shard, context, token = one.dealt(vocabulary), one.codes[one.context], one.codes[one.token]
                rows = [(s, pack(context[at], token[at], times[at])) for s, at in _by_shard(shard, _order(shard))]
                yield pa.RecordBatch.from_pydict({"shard": pa.array([s for s, _ in rows], pa.int64()), "bigrams": [b for _, b in rows]})

    return count


def _summed(context: np.ndarray, token: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, with their summed counts."""
    order = np.lexsort((token, context))
    context, token = context[order], token[order]
    first = np.flatnonzero((np.diff(context, prepend=-1) != 0) | (np.diff(token, prepend=-1) != 0))
    times = np.add.reduceat(times[order], first) if len(first) else times
    return context[first], token[first], times


def level(p: np.ndarray) -> np.ndarray:
    """Steps below 1, rounded so that the probability never grows."""
    return np.minimum(np.ceil(-np.log10(p) * STEPS - 1e-9), (1 << LEVEL_BITS) - 1).astype(np.int64)


def value(steps: np.ndarray) -> np.ndarray:
    return 10.0 ** (steps / -STEPS)


def trie_of(context: np.ndarray, token: np.ndarray, times: np.ndarray, vocabulary: Vocabulary) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The trie of sorted distinct pairs; and the contexts that lie in several shards, with their successors in this one."""
    words = np.unique(token)
    first = np.flatnonzero(np.diff(context, prepend=-1))
    contexts, degree = context[first], np.diff(np.append(first, len(context)))
    count = np.add.reduceat(times, first)
    frequent = contexts < RARE
    count[frequent] = vocabulary.counts[contexts[frequent]]  # a context in several shards has only a part of it here
    share = (times - DISCOUNT) / np.repeat(count, degree)
    rest = DISCOUNT * degree / count
    relative = np.repeat(np.arange(len(contexts)) * len(words), degree) + np.searchsorted(words, token)
    rare_count = np.where(frequent, 0, count)
    blob = elias_fano.to_bytes(
        {"contexts": contexts, "words": words, "pointers": np.append(first, len(context)), "successors": relative},
        {"share": (level(share), LEVEL_BITS), "rest": (level(rest), LEVEL_BITS), "count": (rare_count, int(rare_count.max()).bit_length())},
    )
    wide = vocabulary.spread(contexts) > 1
    return blob, contexts[wide], degree[wide]


def _build(shared):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        number, held = None, []

        def built():
            parts = [unpack(b) for b in held]
            context, token, times = (np.concatenate(x) for x in zip(*[(c[i], w, t) for c, i, w, t in parts]))
            blob, wide, degree = trie_of(*_summed(context, token, times), vocabulary)
            return pa.RecordBatch.from_pydict({"shard": pa.array([number], pa.int64()), "trie": [blob], "wide": pa.array([wide.tolist()], pa.list_(pa.int64())), "degree": pa.array([degree.tolist()], pa.list_(pa.int64()))})

        for batch in batches:
            for shard, blob in zip(batch.column("shard").to_pylist(), batch.column("bigrams").to_pylist()):
                if shard != number and held:
                    yield built()
                    held = []
                number = shard
                held.append(blob)
        if held:
            yield built()

    return build


class Trie:
    """Levels of one shard in a memory-mapped file, or none."""

    def __init__(self, blob: bytes | None):
        self.levels = None
        if blob:
            with tempfile.NamedTemporaryFile(delete=False) as f:
                f.write(blob)
            self.levels = elias_fano.opened(f.name)
            os.unlink(f.name)  # the mapping keeps it for as long as it is read

    def counts(self, words: np.ndarray) -> np.ndarray:
        """Counts of words that are not frequent; 0 for unknown ones."""
        out = np.zeros(len(words), np.int64)
        if self.levels:
            at, known = self.levels["contexts"].successor(words)
            out[known] = self.levels["count"][at[known]]
        return out

    def probabilities(self, contexts: np.ndarray, of: np.ndarray, words: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
        """Of each word after contexts[of]."""
        lower = vocabulary.shared(words)
        rest, at, known = np.ones(len(contexts)), np.zeros(len(contexts), np.int64), np.zeros(len(contexts), bool)
        if self.levels:
            at, known = self.levels["contexts"].successor(contexts)
            rest[known] = value(self.levels["rest"][at[known]])
        frequent = contexts < RARE
        wide = np.zeros(len(contexts))
        wide[frequent] = vocabulary.rest[contexts[frequent]]
        rest = np.where(wide > 0, wide, rest)
        p = rest[of] * lower
        if self.levels:
            place, found = self._successors(at, known, of, words)
            p[found] += value(self.levels["share"][place[found]])
        return p

    def _successors(self, at: np.ndarray, known: np.ndarray, of: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word stands on the second level behind the context at[of] of the first, and whether it does."""
        place, found = np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        distinct, back = np.unique(words, return_inverse=True)
        nr, seen = self.levels["words"].successor(distinct)
        ask = np.flatnonzero(known[of] & seen[back])
        pointers, where = self.levels["pointers"], at[of[ask]]
        begin, end = pointers[at[known]], pointers[at[known] + 1]
        place_of = np.cumsum(known) - 1
        target = where * self.levels["words"].size + nr[back[ask]]
        place[ask], found[ask] = self.levels["successors"].successor(target, begin[place_of[of[ask]]], end[place_of[of[ask]]])
        return place, found


@dataclass
class Model:
    vocabulary: Vocabulary
    tries: DataFrame  # shard, trie, wide, degree


def _vocabulary(texts: DataFrame, frequent: int, shard_tokens: int) -> Vocabulary:
    if not 0 <= frequent < END:
        raise ValueError("at most 2^20 - 1 words can be frequent")
    n_docs = texts.count()
    words = staged(texts.mapInArrow(_count_words, "word long, count long").groupBy("word").agg(F.sum("count").alias("count")), "word-counts")
    size = F.floor(8 * F.log2("count")).cast("int")
    sizes = words.groupBy(size.alias("size")).agg(F.count("*").alias("n"), F.sum("count").alias("count")).orderBy(F.desc("size")).collect()  # at most 512
    least, room = 1 << 30, frequent
    for row in sizes:
        if row.n > room:
            break
        least, room = row["size"], room - row.n
    taken = words.where(size >= least).toArrow()  # at most ``frequent``
    hashes, counts = taken.column("word").to_numpy(), taken.column("count").to_numpy()
    order = np.lexsort((hashes, -counts))
    codes = np.empty(len(order), np.int64)
    codes[order] = np.arange(len(order))
    by_hash = np.argsort(hashes)
    by_code = np.zeros(BEGIN + 1, np.int64)
    by_code[codes] = counts
    by_code[[END, BEGIN]] = n_docs
    n_words, n_distinct = sum(r["count"] for r in sizes), sum(r.n for r in sizes)
    shards = max(1, -(-(n_words + n_docs) // shard_tokens))
    return Vocabulary(n_docs, n_words, n_distinct, hashes[by_hash], codes[by_hash], by_code, shards, shard_tokens, np.zeros(BEGIN + 1))


def fit(docs: DataFrame, frequent: int = FREQUENT, shard_tokens: int = SHARD_TOKENS) -> Model:
    """Learn a model of order two from the texts of all rows of ``docs``; null texts are empty, repeated rows count each, other columns are ignored.

    Words are runs of all but space and \\t to \\r with A-Z lower-cased, told apart by 64-bit hashes. Ties among frequent words go by hash.
    An empty table gives a model for which every token has probability one.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    vocabulary = _vocabulary(texts, frequent, shard_tokens)
    shared = spark.sparkContext.broadcast(vocabulary)
    counted = texts.mapInArrow(_count_bigrams(shared), "shard long, bigrams binary").repartitionById(vocabulary.shards, F.col("shard").cast("int")).sortWithinPartitions("shard")
    tries = staged(counted.mapInArrow(_build(shared), "shard long, trie binary, wide array<long>, degree array<long>"), "tries")
    zipped = tries.select(F.explode(F.arrays_zip("wide", "degree")).alias("x")).groupBy(F.col("x.wide").alias("wide")).agg(F.sum("x.degree").alias("degree"))
    for row in zipped.collect():  # frequent words at most
        vocabulary.rest[row.wide] = value(level(np.array([DISCOUNT * row.degree / vocabulary.counts[row.wide]])))[0]
    return Model(vocabulary, tries)


TEXTS, BIGRAMS, WORDS, TRIGRAMS = 1, 2, 3, 4
TOGETHER = 100_000  # queries that are answered at once
PARTS = "batch long, kind int, block binary"


def _ask(shared):
    """Blocks of queries for the shards, and one row per batch with what is known about its texts already.

    Where rows say whether they are learned from, queries are trigrams that tell so.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        task = TaskContext.get().partitionId() << 32
        for nr, batch in enumerate(batches):
            n = batch.num_rows
            learned = batch.column("learned").to_numpy(zero_copy_only=False).astype(np.int64) if "learned" in batch.schema.names else None
            tokens, known, base = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
            last: dict[int, tuple[int, int]] = {}
            for group in _pieces(batch.column("text")):
                all_ = _ngrams(group, last, vocabulary)
                frequent = all_.codes < RARE
                count = np.zeros(len(all_.codes), np.int64)
                count[frequent] = vocabulary.counts[all_.codes[frequent]]
                tokens += np.bincount(all_.doc, minlength=n)
                known += np.bincount(all_.doc, (count > 0)[all_.token], n).astype(np.int64)
                base += np.bincount(all_.doc, np.where(frequent, np.log10((count + 1) / vocabulary.base), 0)[all_.token], n)
                rare = np.flatnonzero(~frequent[all_.token])
                rare_doc, rare_token = all_.doc[rare], all_.codes[all_.token[rare]]
                shard = all_.dealt(vocabulary)
                order = _shard_order(shard, all_.keys(), len(all_.codes) ** 2)
                cuts = _cuts(shard[order])
                shards = shard[order[cuts[:-1]]].tolist()
                context, token, doc = all_.codes[all_.context[order]], all_.codes[all_.token[order]], all_.doc[order]
                if learned is None:
                    rows = [(s, BIGRAMS, pack(context[a:b], token[a:b], doc[a:b])) for s, a, b in zip(shards, cuts, cuts[1:])]
                else:
                    blocks = packed3(context, token, all_.codes[all_.before[order]], 2 * doc + learned[doc], cuts)
                    rows = [(s, TRIGRAMS, block) for s, block in zip(shards, blocks)]
                shard = _mixed(rare_token) % vocabulary.shards  # where a rare word is a context, undivided
                if learned is None:
                    for s, at in _by_shard(shard, np.lexsort((rare_token, shard))):
                        rows.append((s, WORDS, pack(rare_token[at], np.zeros(len(at), np.int64), rare_doc[at])))
                else:
                    order = _order(shard)
                    cuts, rare_token, rare_doc = _cuts(shard[order]), rare_token[order], rare_doc[order].astype("<u4")
                    blocks = (rare_token[a:b].tobytes() + rare_doc[a:b].tobytes() for a, b in itertools.pairwise(cuts))
                    rows += [(s, WORDS, block) for s, block in zip(shard[order[cuts[:-1]]].tolist(), blocks)]
                yield _rows([s for s, *_ in rows], task | nr, [k for _, k, _ in rows], [b for *_, b in rows])
            ids = batch.column("doc_id")
            about = np.column_stack([ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), tokens, known])
            yield _rows([(task | nr) % vocabulary.shards], task | nr, [TEXTS], [struct.pack("<I", n) + about.astype("<i8").tobytes() + base.tobytes()])

    return ask


def _rows(shards: list[int], batch: int, kinds: list[int], blocks: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array(shards, pa.int64()), pa.array([batch] * len(shards), pa.int64()), pa.array(kinds, pa.int32()), pa.array(blocks, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "batch", "kind", "block"])


def _sums(doc: np.ndarray, *values: np.ndarray) -> bytes:
    """Sums by text, of those that occur."""
    some = np.flatnonzero(np.bincount(doc))
    sums = [np.bincount(doc, v)[some] for v in values]
    return struct.pack("<I", len(some)) + some.astype("<u4").tobytes() + b"".join(s.astype("<f8").tobytes() for s in sums)


def _answered(trie: Trie, asked: list[tuple], vocabulary: Vocabulary) -> Iterator[tuple[int, int, bytes]]:
    """The sums of many blocks of one shard, whose queries are put together."""
    pairs = [x for x in asked if x[1] == BIGRAMS]
    if pairs:
        first = [np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(words, prepend=-1) != 0)) for _, _, (_, of, words, _) in pairs]  # each pair once
        begins = np.cumsum([0, *(len(contexts) for _, _, (contexts, *_) in pairs)])
        contexts = np.concatenate([contexts for _, _, (contexts, *_) in pairs])
        of = np.concatenate([of[at] + begin for (_, _, (_, of, *_)), at, begin in zip(pairs, first, begins)])
        words = np.concatenate([words[at] for (_, _, (_, _, words, _)), at in zip(pairs, first)])
        found = np.log10(trie.probabilities(contexts, of, words, vocabulary))
        ends = np.cumsum([len(at) for at in first])
        for (nr, kind, (_, _, _, doc)), at, end in zip(pairs, first, ends):
            yield nr, kind, _sums(doc, np.repeat(found[end - len(at) : end], np.diff(np.append(at, len(doc)))))
    for nr, kind, (contexts, of, _, doc) in asked:
        if kind == WORDS:
            count = trie.counts(contexts)[of]
            yield nr, kind, _sums(doc, np.log10((count + 1) / vocabulary.base), count > 0)


def _answer(shared):
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        number, trie = None, Trie(None)
        for batch in batches:
            out, asked, size = [], [], 0
            for shard, nr, kind, block in zip(*(batch.column(c) for c in ("shard", "batch", "kind", "block"))):
                shard, nr, kind, block = shard.as_py(), nr.as_py(), kind.as_py(), block.as_py()
                if shard != number or size > TOGETHER:
                    out += _answered(trie, asked, vocabulary)
                    asked, size = [], 0
                if shard != number:
                    number, trie = shard, Trie(None)
                if kind == 0:
                    trie = Trie(block)
                elif kind == TEXTS:
                    out.append((nr, kind, block))
                else:
                    asked.append((nr, kind, unpack(block)))
                    size += len(asked[-1][2][3])
            out += _answered(trie, asked, vocabulary)
            yield _told(out)

    return answer


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads partitions sorted by (batch, kind): the row of a batch's texts, then the sums for them."""
    held = None

    def told(state):
        number, about, base, score = state
        ids = pa.array(about[:, 0], mask=about[:, 1] == 0)
        return pa.RecordBatch.from_arrays([ids, pa.array(about[:, 2]), pa.array(about[:, 3]), pa.array(base), pa.array(score)], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    for batch in batches:
        for number, kind, block in zip(*(batch.column(c).to_pylist() for c in ("batch", "kind", "block"))):
            (n,) = struct.unpack_from("<I", block)
            if kind == TEXTS:
                if held:
                    yield told(held)
                about = np.frombuffer(block, "<i8", 4 * n, 4).reshape(n, 4).copy()
                held = (number, about, np.frombuffer(block, "<f8", n, 4 + 32 * n).copy(), np.zeros(n))
                continue
            doc = np.frombuffer(block, "<u4", n, 4)
            values = np.frombuffer(block, "<f8", -1, 4 + 4 * n).reshape(-1, n)
            if kind in (BIGRAMS, TRIGRAMS):
                held[3][doc] += values[0]
            else:
                held[2][doc] += values[0]
                held[1][doc, 3] += values[1].astype(np.int64)
    if held:
        yield told(held)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of each row of ``docs``; scores are log10 probabilities of whole texts.

    Tokens are the words and one end. base_score adds up log10((c + 1) / (N + V + 1)) with the counts that the model learned; known tokens have
    c > 0. Null and empty texts have one token, their end. Repeated rows are scored each, null ids stay null, other columns are
    ignored. Very long texts are worked on in pieces cut at blanks. Empty in, empty out. ``docs`` should be read from a table:
    a batch that is computed again must hold the same rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.vocabulary)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    asked = texts.mapInArrow(_ask(shared), f"shard long, {PARTS}")
    tries = model.tries.select("shard", F.lit(0).cast("long").alias("batch"), F.lit(0).alias("kind"), F.col("trie").alias("block"))
    met = tries.unionByName(asked).repartitionById(model.vocabulary.shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "kind")
    answers = staged(met.mapInArrow(_answer(shared), PARTS), "answers")
    return answers.repartition("batch").sortWithinPartitions("batch", "kind").mapInArrow(_gather, "doc_id long, n_tokens long, n_known long, base_score double, score double")


PRIOR2, PRIOR3 = 1000, 10  # m2, m3: so many tokens weighs what the shorter context says
FINE, COARSE = 64, 16  # steps of counts of pairs and of trigrams, for each doubling


def _steps(counts: np.ndarray, fine: int) -> tuple[np.ndarray, int]:
    """Counts in steps of their logarithm, rounded down, and the bits that they need; they come back by ``_times``."""
    steps = np.floor(np.log2(counts) * fine + 1e-9).astype(np.int64)
    return steps, int(steps.max(initial=0)).bit_length()


def _times(steps: np.ndarray, fine: int) -> np.ndarray:
    return (2.0 ** (np.arange(int(steps.max(initial=0)) + 1) / fine))[steps]


@dataclass
class _Trigrams:
    """Distinct trigrams in the order of the trie: their contexts, words and words before as ranks among distinct codes."""

    contexts: np.ndarray
    words: np.ndarray
    befores: np.ndarray
    context: np.ndarray
    word: np.ndarray
    before: np.ndarray
    of: np.ndarray  # the trigram of each row that they come from

    def coded(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.contexts[self.context[at]], self.words[self.word[at]], self.befores[self.before[at]]


def _trigrams(context: np.ndarray, word: np.ndarray, before: np.ndarray, bits: int = 63) -> _Trigrams:
    """Of rows; ranks that have more than ``bits`` together are not sorted as one number."""
    (contexts, context), (words, word), (befores, before) = map(_ranked, (context, word, before))
    narrow, middle = (len(x).bit_length() for x in (befores, words))
    if narrow + middle + len(contexts).bit_length() <= bits:
        key = (((context << middle) | word) << narrow) | before
        order = np.argsort(key)
        key = key[order]
        new = np.diff(key, prepend=-1) != 0
        key = key[new]
        context, word, before = key >> (narrow + middle), (key >> narrow) & ((1 << middle) - 1), key & ((1 << narrow) - 1)
    else:
        order = np.lexsort((before, word, context))
        context, word, before = context[order], word[order], before[order]
        new = (np.diff(context, prepend=-1) != 0) | (np.diff(word, prepend=-1) != 0) | (np.diff(before, prepend=-1) != 0)
        context, word, before = context[new], word[new], before[new]
    of = np.empty(len(order), np.int32)
    of[order] = np.cumsum(new, dtype=np.int32) - 1
    return _Trigrams(contexts, words, befores, context, word, before, of)


def _distinct(context: np.ndarray, word: np.ndarray, before: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct trigrams by context, word and the word before, with their summed counts."""
    all_ = _trigrams(context, word, before)
    sums = np.bincount(all_.of, times, len(all_.context)).astype(np.int64)
    at = np.flatnonzero(sums)
    return *all_.coded(at), sums[at]


def trigram_trie(context: np.ndarray, word: np.ndarray, before: np.ndarray, times: np.ndarray) -> bytes:
    """The trie of sorted distinct trigrams (``before``, ``context``, ``word``)."""
    new = np.ones(len(context), bool)
    new[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
    pair = np.flatnonzero(new)
    first = np.flatnonzero(np.diff(context[pair], prepend=-1))
    contexts, degree = context[pair][first], np.diff(np.append(first, len(pair)))
    nr = np.repeat(np.arange(len(contexts)), degree)  # of a pair's context
    pair_times = np.add.reduceat(times, pair)
    count = np.add.reduceat(pair_times, first)
    rare_count = np.where(contexts < RARE, 0, count)
    words, word_nr = _ranked(word[pair])

    third = np.flatnonzero(context != BEGIN)  # behind a text's beginning nothing more is known
    pair_of = (np.cumsum(new) - 1)[third]
    befores, before_nr = _ranked(before[third])
    key = nr[pair_of] * len(befores) + before_nr
    order = np.argsort(key, kind="stable")
    key, rank = key[order], (np.arange(len(pair)) - np.repeat(first, degree))[pair_of[order]]
    head = np.flatnonzero(np.diff(key, prepend=-1))
    predecessors = key[head]
    of = predecessors // max(len(befores), 1)
    many = np.bincount(of, minlength=len(contexts))  # words before each context
    places, bases = (np.concatenate([[0], np.cumsum(x)]) for x in (many, many * degree))
    base = bases[of] + (np.arange(len(of)) - places[of]) * degree[of]
    pair_steps, pair_bits = _steps(pair_times, FINE)
    steps, bits = _steps(times[third][order], COARSE)
    return elias_fano.to_bytes(
        {
            "contexts": contexts, "words": words, "befores": befores,
            "pointers": np.append(first, len(pair)), "successors": nr * len(words) + word_nr,
            "places": places, "bases": bases, "predecessors": predecessors,
            "ranges": np.append(head, len(key)), "trigrams": np.repeat(base, np.diff(np.append(head, len(key)))) + rank,
        },
        {"pair_times": (pair_steps, pair_bits), "times": (steps, bits), "count": (rare_count, int(rare_count.max()).bit_length())},
    )


class TrigramTrie(Trie):
    def logarithms(self, asked: _Trigrams, vocabulary: Vocabulary) -> np.ndarray:
        """What this shard knows of each distinct trigram, as log10: its probability over the weight of its own context, and the
        weight that its pair has, as a context, for what is known about words alone. They are looked up in the order of the trie."""
        count = np.zeros(len(asked.contexts))
        frequent = asked.contexts < RARE
        count[frequent] = vocabulary.counts[asked.contexts[frequent]]
        if self.levels:
            at, known = self.levels["contexts"].successor(asked.contexts)
            rare = known & ~frequent
            count[rare] = self.levels["count"][at[rare]]
            word_nr, word_seen = self.levels["words"].successor(asked.words)
            before_nr, before_seen = self.levels["befores"].successor(asked.befores)
            at = np.minimum(at, self.levels["contexts"].size - 1)
            begin, end = self.levels["pointers"][at], self.levels["pointers"][at + 1]
            place_of, base = self.levels["places"][at], self.levels["bases"][at]
        prior, shared = PRIOR2 / (count + PRIOR2), vocabulary.shared(asked.words)
        deep, is_end = asked.contexts != BEGIN, asked.words == END
        out = np.empty(len(asked.context))
        for a in range(0, len(out), TOGETHER):
            context, word, before = (x[a : a + TOGETHER] for x in (asked.context, asked.word, asked.before))
            new = (np.diff(context, prepend=-1) != 0) | (np.diff(word, prepend=-1) != 0)
            pair = np.cumsum(new) - 1
            of, word = context[new], word[new]
            times, more = np.zeros(len(of)), np.zeros(len(pair))
            if self.levels:
                ask = np.flatnonzero(known[of] & word_seen[word])
                asked_of = of[ask]
                place, found = self.levels["successors"].successor(at[asked_of] * self.levels["words"].size + word_nr[word[ask]], begin[asked_of], end[asked_of])
                ask, place = ask[found], place[found]
                times[ask] = _times(self.levels["pair_times"][place], FINE)
                rank = np.full(len(of), -1, np.int64)  # of a known pair, among those of its context
                rank[ask] = place - begin[of[ask]]
                ask = np.flatnonzero(((rank >= 0) & deep[of])[pair] & before_seen[before])
                predecessor, met = self.levels["predecessors"].successor(at[context[ask]] * self.levels["befores"].size + before_nr[before[ask]])
                ask, predecessor = ask[met], predecessor[met]
                of_ask = context[ask]
                target = base[of_ask] + (predecessor - place_of[of_ask]) * (end - begin)[of_ask] + rank[pair[ask]]
                ranges = self.levels["ranges"]
                place, found = self.levels["trigrams"].successor(target, ranges[predecessor], ranges[predecessor + 1])
                more[ask[found]] = _times(self.levels["times"][place[found]], COARSE)
            p = prior[of] * (times / PRIOR2 + shared[word])
            upper = np.where(is_end[word], 0, times * 2 ** (1 / FINE))  # nothing follows an end
            out[a : a + TOGETHER] = np.log10(PRIOR3 / (upper + PRIOR3))[pair] + np.log10(more / PRIOR3 + p[pair])
        return out


class _Asked:
    """Blocks of one shard whose trigrams are put together; each distinct one is sorted and looked up once."""

    def __init__(self, rows: list[tuple[int, int, bytes]]):
        rows = sorted(rows, key=lambda r: r[0])
        self.words = [(nr, block) for nr, kind, block in rows if kind == WORDS]  # codes of eight bytes, then texts of four
        self.batches = [nr for nr, kind, _ in rows if kind == TRIGRAMS]
        self.trigrams = None
        if self.batches:
            (*columns, self.extra), sizes = unpacked3([block for _, kind, block in rows if kind == TRIGRAMS])
            self.ends = np.cumsum(sizes)
            self.trigrams = _trigrams(*columns)

    def learned(self) -> list[tuple[np.ndarray, ...]]:
        """Distinct trigrams of the texts that are learned from, with their counts."""
        if self.trigrams is None:
            return []
        times = np.bincount(self.trigrams.of, self.extra & 1, len(self.trigrams.context)).astype(np.int64)
        at = np.flatnonzero(times)
        return [(*self.trigrams.coded(at), times[at])]

    def answered(self, trie: TrigramTrie, vocabulary: Vocabulary) -> Iterator[tuple[int, int, bytes]]:
        """The sums by text, once for each batch."""
        if self.trigrams is not None:
            found = trie.logarithms(self.trigrams, vocabulary)[self.trigrams.of]
            for nr, a, b in self._by_batch(self.batches, self.ends):
                yield nr, TRIGRAMS, _sums(self.extra[a:b] >> 1, found[a:b])
        if self.words:
            sizes = [len(block) // 12 for _, block in self.words]
            codes, of = _ranked(np.concatenate([np.frombuffer(block, "<i8", n) for (_, block), n in zip(self.words, sizes)]))
            doc = np.concatenate([np.frombuffer(block, "<u4", n, 8 * n) for (_, block), n in zip(self.words, sizes)])
            count = trie.counts(codes)
            base, known = np.log10((count + 1) / vocabulary.base)[of], (count > 0)[of]
            for nr, a, b in self._by_batch([nr for nr, _ in self.words], np.cumsum(sizes)):
                yield nr, WORDS, _sums(doc[a:b], base[a:b], known[a:b])

    @staticmethod
    def _by_batch(batches: list[int], ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
        begin = 0
        for k, nr in enumerate(batches):
            if k + 1 == len(batches) or batches[k + 1] != nr:
                yield nr, begin, int(ends[k])
                begin = int(ends[k])


def _merged(parts: list[tuple[np.ndarray, ...]]) -> list[tuple[np.ndarray, ...]]:
    return [_distinct(*(np.concatenate(x) for x in zip(*parts)))] if len(parts) > 1 else parts


def _learned(blocks: list[bytes], so_far: list[tuple]) -> list[tuple]:
    """Distinct trigrams of the texts that are learned from."""
    return _merged([*so_far, *_Asked([(0, TRIGRAMS, block) for block in blocks]).learned()])


def _n_rows(kind: int, block: bytes) -> int:
    return struct.unpack_from("<I", block)[0] if kind == TRIGRAMS else len(block) // 12


def _learn_and_answer(shared, rows_at_once: int = 2 * SHARD_TOKENS):
    """A shard's trie is made from its blocks, which are answered from the trie then; all but the last two million rows wait in a file."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        rows = (r for batch in batches for r in zip(*(batch.column(c) for c in ("shard", "batch", "kind", "block"))))
        for _, of_shard in itertools.groupby(rows, lambda r: r[0].as_py()):
            with tempfile.TemporaryFile() as waiting:
                out, index, held, learned, size = [], [], [], [], 0
                for _, nr, kind, block in of_shard:
                    nr, kind, block = nr.as_py(), kind.as_py(), block.as_py()
                    if kind == TEXTS:
                        out.append((nr, kind, block))
                        continue
                    n = _n_rows(kind, block)
                    if held and size + n > rows_at_once:
                        learned = _merged([*learned, *_Asked(held).learned()])
                        index.append([(*x[:2], waiting.write(x[2])) for x in held])
                        held, size = [], 0
                    held.append((nr, kind, block))
                    size += n
                asked = _Asked(held)
                learned = _merged([*learned, *asked.learned()])
                trie = TrigramTrie(trigram_trie(*learned[0]) if learned and len(learned[0][0]) else None)
                del held, learned
                yield _told([*out, *asked.answered(trie, vocabulary)])
                waiting.seek(0)
                for part in index:
                    asked = None
                    asked = _Asked([(nr, kind, waiting.read(length)) for nr, kind, length in part])
                    yield _told(list(asked.answered(trie, vocabulary)))

    return answer


def _told(out: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary())], names=["batch", "kind", "block"])


def learned_scores(docs: DataFrame, learned: Column, frequent: int = FREQUENT, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """What ``score`` gives of all rows of ``docs``, and train_tokens, under a model of order three of those rows that are ``learned`` from.

    Rows for which ``learned`` is null are not learned from. What is said of ``fit`` and ``score`` about texts, repeated rows and ids holds here.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), F.coalesce(learned, F.lit(False)).alias("learned"))
    vocabulary = _vocabulary(texts.where("learned").select("text"), frequent, shard_tokens)
    vocabulary.rest = None
    shared = spark.sparkContext.broadcast(vocabulary)
    asked = texts.mapInArrow(_ask(shared), f"shard long, {PARTS}").repartitionById(vocabulary.shards, F.col("shard").cast("int")).sortWithinPartitions("shard")
    answers = staged(asked.mapInArrow(_learn_and_answer(shared), PARTS), "answers")
    told = answers.repartition("batch").sortWithinPartitions("batch", "kind").mapInArrow(_gather, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return told.withColumn("train_tokens", F.lit(vocabulary.n_tokens).cast("long"))
