import hashlib
import math
import re
from collections import defaultdict

import pytest

from concord.llm import mixing, registry


def md5(*parts):
    return hashlib.md5(":".join(str(p) for p in parts if p is not None).encode()).hexdigest()


def bisect(holds):
    lo, hi = 0.0, 1.0
    for _ in range(40):
        middle = (lo + hi) / 2
        lo, hi = (middle, hi) if holds(middle) else (lo, middle)
    return lo


def weights(tokens, budget, entropy, repeats):
    total = sum(tokens.values())
    share = {s: t / total for s, t in tokens.items()}

    def at(a):
        powers = {s: p**a for s, p in share.items()}
        return {s: x / sum(powers.values()) for s, x in powers.items()}

    even = bisect(lambda a: -sum(w * math.log(w) for w in at(a).values()) >= entropy * math.log(len(share)))
    few = 1 - bisect(lambda b: all(w * budget / (share[s] * total) <= repeats for s, w in at(1 - b).items()))
    return {s: round(w, 9) for s, w in at(round(max(even, few), 6)).items()}


def brute(rows, budget=None, entropy=0.95, repeats=4.0):
    sized = [(d, s or "", len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), md5("mix", d)) for d, t, s in rows]
    tokens, blocks = defaultdict(int), defaultdict(list)
    for d, s, n, place in sized:
        tokens[s] += n
        blocks[s, place[:3]].append((place, d, n))
    tokens = {s: n for s, n in sorted(tokens.items()) if n}
    if not tokens:
        return []
    budget = budget or sum(tokens.values())
    out = []
    for s, w in weights(tokens, budget, entropy, repeats).items():
        target = math.floor(w * budget)
        passes, rest = divmod(target, tokens[s])
        own = [b for (source, b) in blocks if source == s]
        for epoch in range(passes + 1):
            before = 0
            for rank, b in enumerate(sorted(own, key=lambda b: (md5("mix", s, epoch, b), b)), 1):
                size = sum(n for *_, n in blocks[s, b])
                room = size if epoch < passes else min(size, rest - before)
                upto = 0
                for _, d, n in sorted(blocks[s, b]) if room > 0 or room == size == 0 else ():
                    upto += n
                    if room == size or upto <= room:
                        out.append((d, s, n, epoch, b, rank, w))
                before += size
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "source", "tokens", "epoch", "block", "block_rank", "weight").collect()), key=repr)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in registry.documents(spark, "/root/testdata/sf0.01").select("doc_id", "text", "source").collect()]
    got = result(registry.op8_source_mixing(spark, "/root/testdata/sf0.01"))
    assert got == brute(rows)
    assert len(got) > 500


@pytest.mark.parametrize("budget", [None, 37, 5000])
def test_small_mixes(make_docs, budget):
    rows = [(i, "w " * (i % 9), ["a", "b", "c", None][min(i % 17, 3)]) for i in range(200)]
    docs = make_docs([r[:2] for r in rows], clash=True).drop("source")
    docs = docs.selectExpr("*", "cast(case doc_id % 17 when 0 then 'a' when 1 then 'b' when 2 then 'c' end as string) as source")
    assert result(mixing.mix(docs, budget)) == brute(rows, budget)


def test_edge_cases(make_docs, edge_pairs):
    got = result(mixing.mix(make_docs(edge_pairs, clash=True)))
    assert sum(r[2] for r in got) <= sum(len((t or "").split()) for _, t in edge_pairs)
    assert result(mixing.mix(make_docs([(1, None), (2, "")]))) == []


def test_many_sources(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 100)
    rows = [(i, "w " * (1 + i % 23), f"s{i % 700}") for i in range(2000)]
    docs = make_docs([r[:2] for r in rows]).drop("source").selectExpr("*", "concat('s', doc_id % 700) as source")
    assert result(mixing.mix(docs)) == brute(rows)


def test_a_budget_beyond_all_repeats_takes_natural_shares(make_docs):
    docs = make_docs([(1, "a b c"), (2, "d")]).drop("source").selectExpr("*", "concat('s', doc_id) as source")
    got = result(mixing.mix(docs, budget=40))
    assert [sum(r[1] == s for r in got) for s in ("s1", "s2")] == [10, 10]


def test_columns_can_be_kept(make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    assert {tuple(r) for r in mixing.mix(docs, keep=("text", "lang")).select("doc_id", "text", "lang").collect()} == {(1, "a b", "en"), (2, None, "en")}


def test_empty_table(make_docs):
    assert result(mixing.mix(make_docs([]))) == []


def test_null_and_repeated_sources_and_budgets_without_measure(spark):
    rows = [(1, "a b c", None), (2, "d e", ""), (3, "f", "x"), (3, "f", "x"), (4, "g h", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs, budget=50)
    assert sorted((r.doc_id, r.source, r.tokens, r.epoch, r.block, r.block_rank, r.weight) for r in found.collect()) == sorted(brute(rows, 50))
    with pytest.raises(ValueError, match="deals a source"):
        mixing.mix(docs, budget=10**10)
