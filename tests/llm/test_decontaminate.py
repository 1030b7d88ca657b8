import random
import re
from collections import Counter

from concord.llm import decontaminate, registry

BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def shingles(words):
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else Counter()


def words_of(text):
    return [w for w in BLANKS.split((text or "").lower()) if w]


def best_similarity(doc, item):
    """Greatest weighted similarity of a window of the item's length, by sliding it over the whole text."""
    want, n = shingles(item), len(item)
    best = 0.0
    for s in range(max(1, len(doc) - n + 1)):
        own = shingles(doc[s : s + n]) if len(item) >= 5 or len(doc[s : s + n]) == n else Counter()
        both = sum((own & want).values())
        union = sum(own.values()) + sum(want.values()) - both
        best = max(best, both / union if union else 0.0)
    return best


def brute(docs, items, least=0.8):
    out = {}
    for d, text in docs:
        words = words_of(text)
        for i, item in items:
            if d is not None and item and (s := best_similarity(words, words_of(item))) >= least:
                out[d, i] = round(s, 6)
    return out


def result(found):
    return {(r.doc_id, r.item_id): r.similarity for r in found.collect()}


def test_query_equals_brute_force(spark):
    """Each of the small table's documents against all items, by sliding windows."""
    docs = [tuple(r) for r in registry.documents(spark, "/root/testdata/sf0.001").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    known = {g for _, t in items for g in shingles(words_of(t))}
    near = [(d, t) for d, t in docs if known & set(shingles(words_of(t)))]  # a similar window shares a shingle
    wanted = brute(near, items)
    assert result(registry.op5_decontamination(spark, "/root/testdata/sf0.001")) == wanted
    assert wanted


def test_planted_passages(make_docs, spark):
    rnd = random.Random(6)
    text = lambda n: [rnd.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rnd.randint(0, 60)) for _ in range(n)]
    items = [(k, " ".join(text(rnd.randint(30, 70)))) for k in range(12)]
    docs = []
    for d in range(60):
        body, passage = text(rnd.randint(0, 150)), rnd.choice(items)[1].split()
        if d % 3 == 0:
            passage[rnd.randrange(len(passage))] = "changed"
        if d % 7 == 0:
            passage = [w.upper() for w in passage]
        at = rnd.randint(0, len(body))
        docs.append((d, rnd.choice([" ", "\n", "\t "]).join(body[:at] + (passage if d % 4 else []) + body[at:])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert result(decontaminate.leaks(make_docs(docs, clash=True), bench)) == brute(docs, items)


def test_edge_cases(make_docs, edge_pairs, spark):
    bench = spark.createDataFrame([(1, "one"), (2, None), (3, ""), (None, "one"), (4, "a b c d e f g h i j k l"), (1, "one")], "item_id long, text string")
    got = result(decontaminate.leaks(make_docs(edge_pairs, clash=True), bench))
    assert got == {(9, 1): 1.0, (8, 1): 1.0, (1, 4): 1.0}


def test_empty_tables(make_docs, spark):
    bench = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert decontaminate.leaks(make_docs([]), bench).collect() == []
    assert decontaminate.leaks(make_docs([(1, "one")]), bench.limit(0)).collect() == []


def test_reordered_passages(make_docs, spark):
    """Parts of an item in another order, which no shared shingle lines up with at the passage's start."""
    rnd = random.Random(8)
    word = lambda: f"w{rnd.randint(0, 5000)}"
    items = [(k, [word() for _ in range(n)]) for k, n in enumerate([60, 60, 90, 120, 45])]
    docs = []
    for k, item in items:
        for cuts in (2, 3):
            edges = [len(item) * c // cuts for c in range(cuts + 1)]
            parts = [item[a:b] for a, b in zip(edges, edges[1:])]
            around = [[word() for _ in range(n)] for n in (40, 70)]
            docs.append((len(docs), " ".join([*around[0], *(w for part in reversed(parts) for w in part), *around[1]])))
    bench = spark.createDataFrame([(k, " ".join(item)) for k, item in items], "item_id long, text string")
    wanted = brute(docs, [(k, " ".join(item)) for k, item in items])
    assert len(wanted) >= 6
    assert result(decontaminate.leaks(make_docs(docs, clash=True), bench)) == wanted


def test_blocks_find_all_within_the_radius_and_few_others(spark):
    from pyspark.sql import functions as F

    rnd = random.Random(8)
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    items = [rnd.getrandbits(64) for _ in range(60)]
    prints = []
    for i, x in enumerate(items):
        for bits in (0, 5, 12, decontaminate.RADIUS):
            y = x
            for b in rnd.sample(range(64), bits):
                y ^= 1 << b
            prints.append((len(prints), i, signed(y)))
    left = spark.createDataFrame(prints, "w long, i long, fp long").select("w", "i", decontaminate._blocks(F.col("fp")).alias("block"))
    right = spark.createDataFrame([(i, signed(x)) for i, x in enumerate(items)], "j long, fp long").select("j", decontaminate._blocks(F.col("fp"), decontaminate.NEAR).alias("block"))
    met = left.join(right, "block").select("w", "i", "j").distinct().collect()
    assert {r.w for r in met if r.i == r.j} == set(range(len(prints)))
    assert sum(r.i != r.j for r in met) < 0.3 * len(prints) * len(items)


def test_recall_on_the_larger_table(spark):
    """All pairs of documents and items with a shared shingle, by sliding windows, against what is found."""
    docs = [tuple(r) for r in registry.documents(spark, "/root/testdata/sf0.01").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").select("item_id", "text").collect()]
    holders = {}
    for i, t in items:
        for g in shingles(words_of(t)):
            holders.setdefault(g, set()).add(i)
    texts = dict(items)
    wanted = {}
    for d, t in docs:
        own = Counter(i for g in set(shingles(words_of(t))) for i in holders.get(g, ()))
        # two bags of m and m' shingles that are 0.8 similar share 4/9 of m + m'
        near = [(i, texts[i]) for i, n in own.items() if n >= 0.3 * len(shingles(words_of(texts[i])))]
        wanted |= brute([(d, t)], near) if near else {}
    found = result(registry.op5_decontamination(spark, "/root/testdata/sf0.01"))
    assert set(found.items()) <= set(wanted.items())
    assert len(found) >= 0.99 * len(wanted) > 20
