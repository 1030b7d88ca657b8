import hashlib
import random

import numpy as np

from concord.llm import registry, suffix_dedup

N = 50


def brute(pairs):
    least = {}
    data = {i: (t or "").encode() for i, t in pairs}
    for i, b in data.items():
        if i is not None:
            for s in range(len(b) - N + 1):
                w = b[s : s + N]
                least[w] = min(least.get(w, i), i)
    out = {}
    for i, b in data.items():
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - N + 1):
            if i is not None and least[b[s : s + N]] < i:
                gone[s : s + N] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[i] = (len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


def result(docs):
    from pyspark.sql import functions as F

    rows = suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    return {r[0]: tuple(r[1:]) for r in rows}


def test_query_equals_brute_force(spark):
    pairs = [tuple(r) for r in registry.documents(spark, "/root/testdata/sf0.01").select("doc_id", "text").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in registry.op4_suffix_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert got == brute(pairs)
    assert sum(v[1] for v in got.values()) > 0


def test_planted_passages(make_docs):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(n) for n in (4, 8, 10, 12, 15, 40)] + ["x" * 49, "y" * 50, "z" * 120, "ab" * 40]
    pairs = []
    for i in range(120):
        parts = [text(rnd.randint(0, 30)) for _ in range(3)]
        parts.insert(rnd.randint(0, 3), rnd.choice(shared)[rnd.randint(0, 9) :])
        pairs.append((rnd.randint(0, 10_000) * 200 + i, rnd.choice(["", " "]).join(parts)))
    assert result(make_docs(pairs)) == brute(pairs)


def test_heavy_minimisers_are_dealt_by_strings(make_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HEAVY", 10)
    rnd = random.Random(4)
    noise = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    passage = noise(60)
    pairs = [(i, noise(rnd.randint(0, 70)) + passage[rnd.randint(0, 9) :] + noise(60)) for i in range(80)]
    assert result(make_docs(pairs)) == brute(pairs)


def test_a_heavy_minimiser_sends_rows_in_proportion():
    """10,000 contexts of one passage: each string is sent once, and no value they are dealt by has more than a few."""
    rnd = random.Random(6)
    noise = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    passage = noise(30)
    texts = [(noise(25) + passage + noise(25)).encode() for _ in range(10_000)]
    n = np.arange(10_000)
    held, code, anchor, doc, _, place = suffix_dedup._singles(texts, n, n * 0, n, n * 0, n * 0)
    assert len(code) == 10_000 * 31 and np.bincount(np.unique(anchor, return_inverse=True)[1]).max() < 20
    assert all(held[c] == texts[d][p : p + N] for c, d, p in zip(code.tolist(), doc.tolist(), place.tolist()))


def test_blocks_of_single_strings(monkeypatch):
    rnd = random.Random(9)
    parts = ["".join(rnd.choice("ab") for _ in range(30)) for _ in range(5)]
    texts = list({"".join(rnd.choice(parts) for _ in range(3))[: rnd.randint(50, 80)].encode() for _ in range(200)})
    code = np.array([rnd.randrange(len(texts)) for _ in range(500)])
    doc, place = np.arange(500) // 2, np.arange(500) * 1000
    strings = {}
    for c, d in zip(code.tolist(), doc.tolist()):
        for i in range(len(texts[c]) - N + 1):
            strings[texts[c][i : i + N]] = min(d, strings.get(texts[c][i : i + N], d))
    expected = {p + i for c, d, p in zip(code.tolist(), doc.tolist(), place.tolist()) for i in range(len(texts[c]) - N + 1) if strings[texts[c][i : i + N]] < d}
    monkeypatch.setattr(suffix_dedup, "BLOCK", 2000)
    found, blocks = set(), 0
    for held, c, d, _, p in suffix_dedup._by_string(texts, code, doc, doc * 0, place):
        row, offset, length, _ = suffix_dedup._decided(held, c, d, False)
        found |= {p[r] + o + i for r, o, n in zip(row, offset, length) for i in range(n)}
        blocks += 1
    assert found == expected and blocks > 3


def test_a_hot_minimiser_in_many_contexts(make_docs):
    rnd = random.Random(8)
    noise = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    passage = noise(30)
    docs = make_docs([(i, noise(40) + passage + noise(40)) for i in range(10_000)])
    assert {v[1] for v in result(docs).values()} == {0}


def test_long_texts_come_in_pieces(monkeypatch):
    """Whatever the pieces, every string has the minimiser that its own bytes give, and one segment."""
    rnd = random.Random(5)
    noise = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n)).encode()
    texts = [noise(rnd.randint(0, 900)) + b"z" * rnd.choice((0, 120)) + noise(rnd.randint(0, 2000)) for _ in range(30)]

    def strings():
        return sorted((n, s + i, a) for number, anchor, low, run in suffix_dedup.segments(texts) for n, a, s, r in zip(number.tolist(), anchor.tolist(), low.tolist(), run.tolist()) for i in range(r))

    whole = strings()
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    assert strings() == whole
    assert [(n, s) for n, s, _ in whole] == [(i, s) for i, t in enumerate(texts) for s in range(len(t) - N + 1)]
    by_string = {}
    for n, s, a in whole:
        assert by_string.setdefault(texts[n][s : s + N], a) == a


def test_expansion_equals_direct_comparison():
    rnd = random.Random(7)
    for size in (60, 300, 3000):
        parts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(20, 70))) for _ in range(6)]
        data = "".join(rnd.choice(parts) for _ in range(size // 20)).encode()
        start = np.arange(len(data) - N + 1)
        owner = np.array([rnd.randint(0, 9) for _ in start])
        least = {}
        for s, o in zip(start.tolist(), owner.tolist()):
            least[data[s : s + N]] = min(o, least.get(data[s : s + N], o))
        expected = [least[data[s : s + N]] < o for s, o in zip(start.tolist(), owner.tolist())]
        found = suffix_dedup.repeated(np.frombuffer(data, np.uint8), start, owner, owner)
        assert found[0].tolist() == found[1].tolist() == expected


def test_rows_that_share_an_id_differ(make_docs):
    pairs = [(5, "p" * 70), (7, "k" * 10 + "p" * 60), (7, "p" * 55 + "m" * 90), (7, None), (9, "m" * 70)]
    rows = suffix_dedup.remove_repeats(make_docs(pairs)).select("doc_id", "n_bytes", "n_removed").collect()
    assert sorted(map(tuple, rows)) == [(5, 70, 0), (7, 0, 0), (7, 70, 60), (7, 145, 55), (9, 70, 70)]


def test_edge_cases(make_docs):
    pairs = [(5, None), (3, ""), (9, "q" * 200), (2, "q" * 60), (7, "short"), (8, "long " * 30_000), (1, "long " * 11)]
    assert result(make_docs(pairs, clash=True)) == brute(pairs)
    repeated = make_docs([(1, "w" * 80), (1, "w" * 80), (None, "w" * 80)])
    assert {v[1] for v in result(repeated).values()} == {0}
    assert result(make_docs([])) == {}
