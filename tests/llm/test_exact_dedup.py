import hashlib
from collections import defaultdict

from comparing import TESTDATA, compared

from concord.llm import exact_dedup, registry


def brute(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def result(docs, **limits):
    rows = exact_dedup.exact_duplicates(docs, **limits).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_query_equals_oracle(spark):
    ours, theirs, found, wanted = compared(spark, registry.op6_exact_dedup, registry.OP6_SQL, TESTDATA / "sf0.001")
    assert ours == theirs and found == wanted


def test_edge_cases(make_docs, edge_pairs):
    assert result(make_docs(edge_pairs, clash=True)) == brute(edge_pairs)


def test_heavy_and_light_groups_agree(make_docs):
    pairs = [(i, "hot" if i % 3 == 0 else f"text {i % 200}") for i in range(900)]
    assert result(make_docs(pairs), heavy_limit=2, tracked=50) == brute(pairs)
    assert result(make_docs(pairs), heavy_limit=500, tracked=1000) == brute(pairs)


def test_empty_table(make_docs):
    assert result(make_docs([])) == []
