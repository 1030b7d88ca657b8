import hashlib
import random

from comparing import TESTDATA, compared

from concord.llm import line_dedup, registry


def key(line):
    k = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)


def brute(pairs):
    holders = {}
    for i, t in pairs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(i)
    keep = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= 3}
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in keep or (i is not None and keep[key(x)] == i)]
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(docs):
    rows = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "text").collect()
    return sorted(((r[0], r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in rows), key=repr)


def test_query_equals_oracle(spark):
    ours, theirs, found, wanted = compared(spark, registry.op2_line_dedup, registry.OP2_SQL, TESTDATA / "sf0.001")
    assert ours == theirs and found == wanted


def test_random_lines(make_docs):
    rnd = random.Random(5)
    lines = [("Line %d with É and some words" % i)[: rnd.randint(15, 40)] for i in range(40)] + ["é" * 19, "é" * 20, "Ⱥ" * 20]
    pairs = [(i * 7, "\n".join(rnd.choice(["", "\t", " "]) + rnd.choice([str.upper, str.lower, str])(rnd.choice(lines)) + rnd.choice(["", "\r", "\x0b"]) for _ in range(rnd.randint(0, 8)))) for i in range(150)]
    assert result(make_docs(pairs, clash=True)) == brute(pairs)


def test_edge_cases(make_docs, edge_pairs):
    shared = "a line that many documents share"
    pairs = [*edge_pairs, (None, shared), (1, shared), (2, shared), (2, f"{shared}\n{shared}"), (3, shared)]
    assert result(make_docs(pairs, clash=True)) == brute(pairs)


def test_full_filters_change_nothing(make_docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "MIN_BITS", 64)
    monkeypatch.setattr(line_dedup, "MAX_BITS", 64)
    pairs = [(i, "\n".join(f"number {(i * k) % 50} of the lines here" for k in range(9))) for i in range(60)]
    assert result(make_docs(pairs)) == brute(pairs)


def test_empty_table(make_docs):
    assert result(make_docs([])) == []
