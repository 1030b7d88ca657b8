import math
import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from concord.llm import elias_fano, language_model, registry

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall((text or "").encode().lower()), None]


class Plain:
    """The model by its definition, in dictionaries; probabilities are quantised as in the trie."""

    def __init__(self, texts, frequent):
        each = [tokens(t) for t in texts]
        self.c = Counter(w for t in each for w in t)
        self.pair = Counter(p for t in each for p in zip([b"", *t], t))
        self.context, self.degree = Counter(), Counter()
        for (v, _), n in self.pair.items():
            self.context[v] += n
            self.degree[v] += 1
        self.n, self.v = sum(self.c.values()), len(self.c)
        words = {w: n for w, n in self.c.items() if w is not None}
        sizes = Counter(math.floor(8 * math.log2(n)) for n in words.values())
        least, room = math.inf, frequent
        for s in sorted(sizes, reverse=True):
            if sizes[s] > room:
                break
            least, room = s, room - sizes[s]
        self.frequent = {w for w, n in words.items() if math.floor(8 * math.log2(n)) >= least}
        rare = [n for w, n in words.items() if w not in self.frequent]
        self.rare = (sum(rare) + 1) / (len(rare) + 1) / (self.n + 1)

    def quantised(self, p):
        return 10 ** (-min(math.ceil(-math.log10(p) * 256 - 1e-9), 4095) / 256)

    def scores(self, text):
        t = tokens(text)
        base = sum(math.log10((self.c[w] + 1) / (self.n + self.v + 1)) for w in t)
        total = 0.0
        for v, w in zip([b"", *t], t):
            lower = self.c[w] / (self.n + 1) if self.c[w] and (w is None or w in self.frequent) else self.rare
            p = lower
            if self.context[v]:
                p = self.quantised(0.75 * self.degree[v] / self.context[v]) * lower
                if self.pair[v, w]:
                    p += self.quantised((self.pair[v, w] - 0.75) / self.context[v])
            total += math.log10(p)
        return len(t), sum(self.c[w] > 0 for w in t), base, total


def held(rows, docs, plain):
    assert len(rows) == len(docs)
    wanted = sorted(((i, *plain.scores(t)) for i, t in docs), key=repr)
    found = sorted(((r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in rows), key=repr)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    for got, want in zip(sorted(found, key=key), sorted(wanted, key=key)):
        assert got[:3] == want[:3]
        assert np.allclose(got[3:], want[3:], rtol=1e-9), (got, want)


def out(crc_id):
    return crc_id is not None and zlib.crc32(str(crc_id).encode()) % 7 == 2


def test_query_equals_the_definition_and_beats_the_base(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    rows = registry.op11_language_model(spark, "/root/testdata/sf0.01").collect()
    plain = Plain([t for i, t in docs if not out(i)], language_model.FREQUENT)
    held(rows, docs, plain)
    assert all(r.held_out == out(r.doc_id) and r.train_tokens == plain.n for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


@pytest.mark.parametrize(("frequent", "shard_tokens", "piece"), [(0, 500, 64), (20, 100, 1 << 20), (1000, 300, 200), (1000, 100_000, 8 << 20)])
def test_shards_spread_contexts_and_cut_texts(spark, make_docs, monkeypatch, frequent, shard_tokens, piece):
    monkeypatch.setattr(language_model, "PIECE", piece)
    rnd = random.Random(4)
    words = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(400)]
    docs = [(i, " ".join(rnd.choice(words).upper() if rnd.random() < 0.1 else rnd.choice(words) for _ in range(rnd.randint(0, 120)))) for i in range(80)]
    table = make_docs(docs, clash=True).repartition(3)
    model = language_model.fit(table, frequent, shard_tokens)
    held(language_model.score(table, model).collect(), docs, Plain([t for _, t in docs], frequent))


def test_nulls_repeats_blanks_and_long_texts(spark, make_docs, edge_pairs):
    pairs = [*edge_pairs, (20, " \t\x0b "), (21, "a\x0cb\x1cc d Ä ä A"), (22, "the " * 200_000), (None, None)]
    model = language_model.fit(make_docs(pairs, clash=True), shard_tokens=50_000)
    assert model.vocabulary.shards > 4
    new = [*pairs, (30, "never seen before"), (31, "one end b c d")]
    held(language_model.score(make_docs(new), model).collect(), new, Plain([t for _, t in pairs], language_model.FREQUENT))


def test_empty_tables(spark, make_docs):
    model = language_model.fit(make_docs([]))
    assert language_model.score(make_docs([]), model).collect() == []
    rows = language_model.score(make_docs([(1, "a b"), (2, None)]), model).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in rows) == [(1, 3, 0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0)]


def test_probabilities_sum_to_one_at_most(spark, make_docs):
    docs = [(i, "a b c a b a d" if i % 2 else "b c e") for i in range(50)]
    model = language_model.fit(make_docs(docs), shard_tokens=10**6)
    trie = language_model.Trie(model.tries.collect()[0].trie)
    codes = np.array([*range(len(model.vocabulary.hashes)), language_model.END, language_model.RARE | 5], np.int64)
    for context in [*codes.tolist()[:-2], language_model.BEGIN]:
        p = trie.probabilities(np.array([context]), np.zeros(len(codes), np.int64), codes, model.vocabulary)
        assert 0.97 < p.sum() <= 1 + 1e-9


@pytest.mark.parametrize("top", [3, 200, 10**6, 2**62])
def test_monotone_sequences(top, tmp_path):
    rnd = np.random.default_rng(7)
    for n in (0, 1, 70, 3000):
        values = np.sort(rnd.integers(0, top, n))
        (tmp_path / "x").write_bytes(elias_fano.to_bytes({"s": values}, {"f": (values, int(top).bit_length())}))
        made = elias_fano.opened(tmp_path / "x")
        at = rnd.integers(0, max(n, 1), 500) if n else np.empty(0, np.int64)
        assert np.array_equal(made["s"][at], values[at]) and np.array_equal(made["f"][at], values[at])
        target = np.concatenate([values, values + 1, rnd.integers(0, top, 500)])
        place, found = made["s"].successor(target)
        assert np.array_equal(place, np.searchsorted(values, target)) and np.array_equal(found, np.isin(target, values))
        begin, end = np.sort(rnd.integers(0, n + 1, (2, len(target))), axis=0)
        place, found = made["s"].successor(target, begin, end)
        wanted = np.clip(np.searchsorted(values, target), begin, end)
        assert np.array_equal(place, wanted) and np.array_equal(found, (wanted < end) & (values[np.minimum(wanted, max(n - 1, 0))] == target) if n else found)


class Trigrams(Plain):
    """The model of order three by its definition; counts are quantised as in the trie."""

    def __init__(self, texts, frequent):
        super().__init__(texts, frequent)
        self.triple = Counter()
        for t in map(tokens, texts):
            self.triple.update(zip([b"", b"", *t], [b"", *t], t))

    @staticmethod
    def steps(n, fine):
        return 2 ** (math.floor(math.log2(n) * fine + 1e-9) / fine) if n else 0

    def probability(self, u, v, w):
        """v is b"" at the beginning of a text, which has no words before it."""
        lower = self.c[w] / (self.n + 1) if self.c[w] and (w is None or w in self.frequent) else self.rare
        p = (self.steps(self.pair[v, w], 64) + language_model.PRIOR2 * lower) / (self.context[v] + language_model.PRIOR2)
        if v == b"":
            return p
        context = self.steps(self.pair[u, v], 64) * 2 ** (1 / 64)
        return (self.steps(self.triple[u, v, w], 16) + language_model.PRIOR3 * p) / (context + language_model.PRIOR3)

    def scores(self, text):
        t = tokens(text)
        return *super().scores(text)[:3], sum(math.log10(self.probability(*x)) for x in zip([b"", b"", *t], [b"", *t], t))


def test_query_is_of_order_three(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    rows = registry.op11_language_model(spark, "/root/testdata/sf0.01").collect()
    plain = Trigrams([t for i, t in docs if not out(i)], language_model.FREQUENT)
    held(rows, docs, plain)
    assert all(r.held_out == out(r.doc_id) and r.train_tokens == plain.n for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


@pytest.mark.parametrize(("frequent", "shard_tokens", "piece"), [(0, 500, 64), (20, 100, 1 << 20), (1000, 300, 200), (1000, 100_000, 8 << 20)])
def test_trigrams_of_shards_and_cut_texts(spark, make_docs, monkeypatch, frequent, shard_tokens, piece):
    monkeypatch.setattr(language_model, "PIECE", piece)
    rnd = random.Random(5)
    words = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(400)]
    docs = [(i, " ".join(rnd.choice(words).upper() if rnd.random() < 0.1 else rnd.choice(words) for _ in range(rnd.randint(0, 120)))) for i in range(80)]
    scored = language_model.learned_scores(make_docs(docs, clash=True).repartition(3), F.when(F.col("doc_id") % 5 > 0, True), frequent, shard_tokens)
    held(scored.collect(), docs, Trigrams([t for i, t in docs if i % 5], frequent))


def test_trigrams_of_nulls_repeats_and_long_texts(spark, make_docs, edge_pairs):
    pairs = [*edge_pairs, (20, " \t\x0b "), (21, "a\x0cb\x1cc d Ä ä A"), (22, "the " * 200_000), (None, None)]
    new = [(30, "never seen before"), (31, "one end b c d the the")]
    scored = language_model.learned_scores(make_docs([*pairs, *new]), ~F.coalesce(F.col("doc_id"), F.lit(0)).isin(30, 31), shard_tokens=50_000)
    held(scored.collect(), [*pairs, *new], Trigrams([t for _, t in pairs], language_model.FREQUENT))


def test_trigrams_of_empty_tables(spark, make_docs):
    assert language_model.learned_scores(make_docs([]), F.lit(True)).collect() == []
    rows = language_model.learned_scores(make_docs([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in rows) == [(1, 3, 0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0)]
    rows = language_model.learned_scores(make_docs([(1, ""), (2, "a")]), F.col("doc_id") == 1).collect()
    held(rows, [(1, ""), (2, "a")], Trigrams([""], language_model.FREQUENT))


def test_trigram_probabilities_sum_to_one_at_most():
    model = Trigrams(["a b c a b a d", "b c e", "a b c c"] * 20, 1000)
    for u, v in {p for p in model.pair if p[1] is not None}:
        assert 0.9 < sum(model.probability(u, v, w) for w in [*model.c, b"new"]) <= 1 + 1e-9


def test_trigrams_summed_in_parts():
    rnd = np.random.default_rng(3)
    rows = np.sort(rnd.integers(0, 9, 5000))
    word, before, learned = rnd.integers(0, 9, 5000), rnd.integers(0, 9, 5000), rnd.integers(0, 2, 5000)
    blocks = [language_model.pack3(rows[a : a + 500], word[a : a + 500], before[a : a + 500], learned[a : a + 500]) for a in range(0, 5000, 500)]
    whole = language_model._learned(blocks, [])[0]
    parts = language_model._learned(blocks[3:], language_model._learned(blocks[:3], []))[0]
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))
    assert Counter(zip(*(x[learned == 1].tolist() for x in (rows, word, before)))) == {(a, b, c): n for a, b, c, n in zip(*(x.tolist() for x in whole))}


def one_shard(rows_at_once=None, blocks=40, rows=3000):
    """A shard's answers for blocks of ten batches over few distinct trigrams, some of them rare words; and its vocabulary."""
    rnd = np.random.default_rng(5)
    counts = np.zeros(language_model.BEGIN + 1, np.int64)
    counts[:9], counts[-2:] = 5000, 10
    vocabulary = language_model.Vocabulary(10, 50_000, 12, np.arange(9), np.arange(9), counts, 1, 10**6)
    codes = np.array([*range(9), language_model.END, language_model.RARE | 3, language_model.RARE | 9])
    made = []
    for k in range(blocks):
        context, word, before = codes[np.sort(rnd.integers(0, 12, rows))], *codes[rnd.integers(0, 12, (2, rows))]
        made.append((k % 10, language_model.TRIGRAMS, language_model.pack3(context, word, before, 2 * rnd.integers(0, 7, rows) + rnd.integers(0, 2, rows))))
        rare = codes[-2:][np.sort(rnd.integers(0, 2, 5))]
        made.append((k % 10, language_model.WORDS, rare.tobytes() + np.arange(5, dtype="<u4").tobytes()))
    run = language_model._learn_and_answer(SimpleNamespace(value=vocabulary), *[x for x in [rows_at_once] if x])
    batches = [pa.RecordBatch.from_pydict({"shard": [0], "batch": [nr], "kind": [kind], "block": pa.array([b], pa.binary())}) for nr, kind, b in made]
    return [tuple(x.values()) for b in run(iter(batches)) for x in b.to_pylist()]


def test_each_trigram_of_a_shard_is_looked_up_once(monkeypatch):
    asked, successor = [], elias_fano.Monotone.successor
    monkeypatch.setattr(elias_fano.Monotone, "successor", lambda self, target, *more: asked.append(len(target)) or successor(self, target, *more))
    answers = one_shard()
    assert sum(asked) < 3 * 12**3 + 1000  # of 120,000 rows
    assert sum(kind == language_model.TRIGRAMS for _, kind, _ in answers) == 10


def test_rows_that_wait_in_a_file_are_answered_alike():
    def sums(answers):
        out = Counter()
        for nr, kind, block in answers:
            n = int.from_bytes(block[:4], "little")
            for doc, x in zip(np.frombuffer(block, "<u4", n, 4).tolist(), np.frombuffer(block, "<f8", n, 4 + 4 * n).tolist()):
                out[nr, kind, doc] += x
        return out

    whole, parts = sums(one_shard()), sums(one_shard(10_000))
    assert whole.keys() == parts.keys() and all(math.isclose(whole[k], parts[k], rel_tol=1e-12) for k in whole)


def test_blocks_and_ranks_with_rare_words():
    rnd = np.random.default_rng(11)
    codes = np.concatenate([rnd.integers(0, language_model.BEGIN + 1, 50), language_model.RARE | rnd.integers(0, 2**62, 50)])
    columns = [codes[rnd.integers(0, 100, 2000)] for _ in range(3)] + [rnd.integers(0, 2**32, 2000)]
    blocks = list(language_model.packed3(*columns, [0, 1, 900, 900, 2000]))
    made, sizes = language_model.unpacked3(blocks)
    assert sizes.tolist() == [1, 899, 0, 1100] and all(np.array_equal(a, b) for a, b in zip(made, columns))
    for some in (columns[0], codes[:0], *(np.tile(x, 2000) for x in (codes, codes[:50], codes[50:]))):
        assert all(np.array_equal(a, b) for a, b in zip(language_model._ranked(some), np.unique(some, return_inverse=True)))
    for bits in (63, 5):
        distinct = language_model._trigrams(*columns[:3], bits)
        assert all(np.array_equal(a[distinct.of], b) for a, b in zip(distinct.coded(slice(None)), columns))
        triples = list(zip(*(x.tolist() for x in distinct.coded(slice(None)))))
        assert triples == sorted(set(triples))
    shard, keys = rnd.integers(0, 9, 500), rnd.permutation(500)
    assert np.array_equal(language_model._shard_order(shard, keys, 500), language_model._shard_order(shard, keys, 2**62))
