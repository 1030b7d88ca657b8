import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, or with columns that clash with names the operators use."""

    def make(pairs, clash=False):
        rows = [(i, t, "en", "src0", len(t or "")) for i, t in pairs]
        docs = spark.createDataFrame(rows, SCHEMA)
        if clash:
            for name in ("fp", "root", "digest", "chunk", "group_size", "block", "task", "n_lines", "score", "spans", "copies", "tokens"):
                docs = docs.selectExpr("*", f"'x' as {name}")
        return docs

    return make


EDGE = [(5, None), (3, ""), (4, ""), (9, "one"), (8, "One"), (None, "one"), (9, "one"), (7, "x" * 100_000), (1, "a b c d e f g h i j k l " * 5000)]


@pytest.fixture
def edge_pairs():
    return EDGE
