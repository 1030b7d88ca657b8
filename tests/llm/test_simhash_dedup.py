import random

import xxhash

from concord.llm import registry, simhash_dedup


def brute(pairs):
    prints = []
    for doc_id, text in pairs:
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints.append((doc_id, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    kinds = sorted({f for _, f in prints})
    parent = {f: f for f in kinds}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(kinds):
        for b in kinds[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                parent[root(b)] = root(a)
    least = {}
    for doc_id, f in prints:
        known = [x for x in (doc_id, least.get(root(f))) if x is not None]
        least[root(f)] = min(known) if known else None
    return sorted(((d, f"{f:016x}", least[root(f)]) for d, f in prints), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = registry.documents(spark, "/root/testdata/sf0.01").select("doc_id", "text").collect()
    got = found(registry.op1_simhash_dedup(spark, "/root/testdata/sf0.01"))
    assert got == brute([tuple(r) for r in docs])
    assert len({c for *_, c in got}) < len(got)


def test_edge_cases(make_docs, edge_pairs):
    assert found(simhash_dedup.near_duplicates(make_docs(edge_pairs, clash=True))) == brute(edge_pairs)


def test_empty_table(make_docs):
    assert found(simhash_dedup.near_duplicates(make_docs([]))) == []


def test_chunked_blocks_lose_no_link(spark):
    codes = sorted({1 << a | 1 << b for a in range(40) for b in range(40)} | {7 << 50})
    prints = spark.createDataFrame([(c,) for c in codes], "fp long")
    edges = simhash_dedup.links(prints, chunk_rows=50)
    from concord.operators.graph import components

    roots = dict(components(edges).collect())
    assert {roots.get(c, c) for c in codes if c < 1 << 40} == {min(codes)}
    assert 7 << 50 not in roots


def similar_brute(pairs, least=0.8):
    """Components over all pairs of texts whose sets of five-word shingles have a Jaccard similarity of at least ``least``."""
    sets = []
    for _, text in pairs:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    parent = list(range(len(pairs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if min(len(a), len(b)) >= least * max(len(a), len(b)) and 10 * len(a & b) >= round(10 * least) * len(a | b):
                parent[root(i)] = root(j)
    ids = {}
    for i, (d, _) in enumerate(pairs):
        ids.setdefault(root(i), []).append(d)
    smallest = {r: min((d for d in x if d is not None), default=None) for r, x in ids.items()}
    return sorted(((d, smallest[root(i)]) for i, (d, _) in enumerate(pairs)), key=repr)


def test_similar_texts_equal_brute_force(spark):
    docs = [tuple(r) for r in registry.documents(spark, "/root/testdata/sf0.01").select("doc_id", "text").collect()]
    assert found(simhash_dedup.similar_texts(registry.documents(spark, "/root/testdata/sf0.01"))) == similar_brute(docs)


def test_changed_words_are_found_in_chunks_too(make_docs):
    rnd = random.Random(5)
    docs = []
    for g in range(12):
        base = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.choice([12, 40, 150]))]
        for _ in range(rnd.choice([2, 3, 40])):
            text = list(base)
            for _ in range(rnd.randint(0, max(1, len(text) // 40))):
                text[rnd.randrange(len(text))] = f"new{rnd.randint(0, 400)}"
            docs.append((len(docs), " ".join(text)))
    wanted = similar_brute(docs)
    assert 12 < len({c for _, c in wanted}) < len(docs)
    assert found(simhash_dedup.similar_texts(make_docs(docs, clash=True))) == wanted
    assert found(simhash_dedup.similar_texts(make_docs(docs), chunk_rows=10, chunk_texts=10)) == wanted


def test_similar_texts_edge_cases(make_docs, edge_pairs):
    assert found(simhash_dedup.similar_texts(make_docs(edge_pairs, clash=True))) == similar_brute(edge_pairs)
    assert found(simhash_dedup.similar_texts(make_docs([]))) == []


def test_one_candidate_group_of_five_thousand_texts(make_docs):
    """Near copies of one text in ever other places, in small chunks: nothing is lost, and what is less similar stays apart."""
    words = [f"w{i}" for i in range(200)]
    near = [(i, " ".join([*words[: i % 190], f"new{i}", *words[i % 190 + 1 :]])) for i in range(1, 5001)]
    far = [(9000 + i, " ".join([*words[:60], *(f"x{i}-{k}" for k in range(140))])) for i in range(20)]
    roots = dict(tuple(r) for r in simhash_dedup.similar_texts(make_docs(near + far)).collect())
    assert {roots[i] for i, _ in near} == {1}
    assert all(roots[i] == i for i, _ in far)


def test_similar_texts_of_odd_tables(make_docs, edge_pairs):
    assert simhash_dedup.similar_texts(make_docs([])).collect() == []
    got = sorted(((r.doc_id, r.component_id) for r in simhash_dedup.similar_texts(make_docs([*edge_pairs, (1, edge_pairs[-1][1])], clash=True)).collect()), key=repr)
    assert got == sorted([(5, 3), (3, 3), (4, 3), (9, 8), (8, 8), (None, 8), (9, 8), (7, 7), (1, 1), (1, 1)], key=repr)


def stages_of(monkeypatch):
    """Rows of each table that the operator stages from now on, by name."""
    rows, staged = {}, simhash_dedup.staged

    def counted(df, name):
        table = staged(df, name)
        rows.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(simhash_dedup, "staged", counted)
    return rows


def test_texts_that_share_a_passage_are_no_candidates(make_docs, monkeypatch):
    """Else false links join into one group as a table grows, and each of its texts is copied once for 500 of the group."""
    rnd, rows = random.Random(8), stages_of(monkeypatch)
    passage = " ".join(f"p{i}" for i in range(12))
    docs = [(i, f"{passage} " + " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(48))) for i in range(3000)]
    near = [(9000, docs[7][1] + " end"), (9001, docs[8][1] + " end")]
    roots = dict(tuple(r) for r in simhash_dedup.similar_texts(make_docs(docs + near)).collect())
    assert {i for i, c in roots.items() if c != i} == {9000, 9001} and (roots[9000], roots[9001]) == (7, 8)
    assert sum(rows["candidate-members"]) <= 8


def test_copied_texts_are_compared_in_passes(make_docs, monkeypatch):
    """A pass copies no more than the texts take once, and all passes together find the same."""
    words, rows = [f"w{i}" for i in range(60)], stages_of(monkeypatch)
    docs = [(i, " ".join([*words[: i % 59], f"new{i}", *words[i % 59 + 1 :]])) for i in range(200)]
    roots = dict(tuple(r) for r in simhash_dedup.similar_texts(make_docs(docs), chunk_texts=10, pass_bytes=1).collect())
    assert len(rows["similar-pairs"]) == 20
    assert [roots[i] for i, _ in docs] == [c for _, c in similar_brute(docs)]
