"""Each stage against plain Python on its own input, and what it makes of odd rows."""

import pytest
import test_decontaminate
import test_mixing

import corpus_pipeline
from concord.llm import registry, toxicity

SF = "/root/testdata/sf0.001"


def pairs_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def without_repeated_lines(pairs):
    """Keys of 20 characters in 3 documents stay in the largest one only."""
    blanks = " \t\n\x0b\x0c\r"
    lower = {c: c + 32 for c in range(65, 91)}
    holders = {}
    for d, t in pairs:
        for line in (t or "").split("\n"):
            holders.setdefault(line.strip(blanks).translate(lower), set()).add(d)
    gone = {k: max(d) for k, d in holders.items() if len(k) >= 20 and len(d) >= 3}
    return [(d, "\n".join(x for x in (t or "").split("\n") if gone.get(x.strip(blanks).translate(lower), d) == d)) for d, t in pairs]


def one_of_each_group(pairs, least=0.8):
    """The smallest id of each component of five-word shingle sets that are alike, all pairs compared."""

    def shingles(text):
        words = (text or "").encode().lower().split()
        return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    sets = {d: shingles(t) for d, t in pairs}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(d, t) for d, t in pairs if find(d) == d]


def test_each_stage_equals_plain_python(spark):
    docs = registry.documents(spark, SF)
    for name, stage in corpus_pipeline.STAGES:
        before, out = pairs_of(docs), stage(spark, docs, SF)
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))  # held against its definition in test_toxicity
            assert pairs_of(out) == [p for p, s in zip(before, model.scores([t for _, t in before])) if s < toxicity.THRESHOLD]
        elif name == "line dedup":
            assert pairs_of(out) == without_repeated_lines(before)
            assert out.where("n_chars <> length(text)").isEmpty()
        elif name == "simhash near-dedup":
            assert pairs_of(out) == one_of_each_group(before)
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            leaked = {d for d, _ in test_decontaminate.brute(before, items)}
            assert leaked and pairs_of(out) == [p for p in before if p[0] not in leaked]
        else:
            rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
            assert test_mixing.result(out) == test_mixing.brute(rows)
            assert set(pairs_of(out)) <= set(before)
            break
        assert out.columns == docs.columns and len(pairs_of(out)) <= len(before)
        docs = corpus_pipeline.staged(out, "test-stage")


def test_run_gives_a_corpus(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and {"doc_id", "source", "text", "epoch"} <= set(out.columns)


EDGE = [(5, None), (3, ""), (4, ""), (9, "one"), (8, "One"), (None, "one"), (9, "one"), (7, "x" * 100_000), (1, "a b c d e f g h i j k l " * 5000)]
LEFT = {
    "toxicity": [(1, EDGE[8][1]), (3, ""), (4, ""), (5, None), (7, "x" * 100_000), (8, "One"), (9, "one"), (9, "one"), (None, "one")],
    "line dedup": [(1, EDGE[8][1]), (3, ""), (4, ""), (5, ""), (7, "x" * 100_000), (8, "One"), (9, "one"), (9, "one"), (None, "one")],
    "simhash near-dedup": [(1, EDGE[8][1]), (3, ""), (7, "x" * 100_000), (8, "One")],
    "benchmark decontamination": [(1, EDGE[8][1]), (3, ""), (4, ""), (5, None), (7, "x" * 100_000), (8, "One"), (9, "one"), (9, "one"), (None, "one")],
}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_edge_cases(make_docs, spark, name, stage):
    out = pairs_of(stage(spark, make_docs(EDGE, clash=True), SF))
    if name in LEFT:
        assert out == sorted(LEFT[name], key=repr)
    else:
        assert set(out) <= set(EDGE) and (7, "x" * 100_000) in out
    assert stage(spark, make_docs([]), SF).collect() == []


def test_near_duplicate_stage_takes_similar_texts(make_docs, spark):
    words = [f"w{i}" for i in range(100)]
    kept = lambda pairs: [d for d, _ in pairs_of(corpus_pipeline.drop_near_duplicates(spark, make_docs(pairs), SF))]
    assert kept([(1, " ".join(words)), (2, " ".join([*words[:30], "other", *words[31:]])), (3, " ".join([*words[:50], *(f"x{i}" for i in range(50))]))]) == [1, 3]
    assert kept([(i, " ".join([*words[: 3 * i], "other", *words[3 * i + 1 :]])) for i in range(1, 30)]) == [1]
