import math

import numpy as np
import pytest
from comparing import TESTDATA, compared

from concord.llm import hard_negatives, registry

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, q string, part string, anchor string, score string, rank string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, *["x"] * 5) for i, v, y in rows], SCHEMA)


def plain(rows):
    """Every pair of rows by its definition, in row order."""
    size = max((len(v) for _, v, _ in rows if v), default=0)
    kept = []
    for i, v, y in rows:
        if v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v] + [0] * (size - len(v))
        kept.append((i, (y + 1) % 10 if i is not None and i % 7 == 0 else y, q))
    out = []
    place = lambda n: (kept[n][0] is None, kept[n][0] or 0)
    for a, (i, y, q) in enumerate(kept):
        if i is None or i % 100:
            continue
        score = {n: sum(x * z for x, z in zip(q, kept[n][2])) for n in range(len(kept))}
        order = sorted(score, key=lambda n: (-score[n], place(n)))
        for p in [n for n in order if n != a and kept[n][1] == y][:5]:
            fit = [n for n in order if kept[n][1] != y and 30 * score[p] <= 100 * score[n] <= 90 * score[p]]
            out += [(i, kept[p][0], k, kept[n][0], score[p], score[n]) for k, n in enumerate(fit[:10], 1)]
    return out


def same(spark, rows, **options):
    found = hard_negatives.mine(table(spark, rows), **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(plain(rows), key=repr)


def test_equals_oracle(spark):
    ours, theirs, found, wanted = compared(spark, registry.queries()["op13_hard_negatives"], registry.oracle_sql()["op13_hard_negatives"], TESTDATA / "sf0.01")
    assert ours == theirs and found == wanted and found


@pytest.mark.parametrize("part_rows", [50, 8192])
def test_random_vectors_with_ties_over_parts(spark, part_rows):
    rnd = np.random.default_rng(1)
    rows = [(int(i), np.round(rnd.normal(size=6), 1).tolist(), int(rnd.integers(3))) for i in rnd.permutation(400)]
    same(spark, rows, part_rows=part_rows)


def test_nulls_repeats_and_short_vectors(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (None, [0.9, 0.4], 1), (3, None, 1), (4, [1.0, None], 1), (5, [NAN, 1.0], 1), (6, [INF, 1.0], 1)]
    rows += [(8, [1.0], 1), (9, [0.5, 0.1], 2), (9, [0.5, 0.1], 2), (10, [0.6], None), (None, [0.4, 0.2], 3), (11, [], 2), (100, [-1.0, -1.0], 2), (12, [0.7, 0.3], 4)]
    same(spark, rows)


def test_one_vector_in_a_third_of_all_rows(spark):
    rows = [(i, [0.5, 0.25] if i % 3 else [0.1 * (i % 11), -0.2 * (i % 5)], i % 2) for i in range(300)]
    same(spark, rows, part_rows=64)


def test_empty_and_anchorless_tables(spark):
    assert hard_negatives.mine(table(spark, [])).collect() == []
    assert hard_negatives.mine(table(spark, [(1, [1.0], 1), (2, [1.0], 2)])).collect() == []


def test_components_too_large_are_named(spark):
    with pytest.raises(ValueError, match="beyond a long"):
        hard_negatives.mine(table(spark, [(0, [1e12], 1), (1, [1e12], 1)]))


def test_intervals_lose_no_pair():
    rnd = np.random.default_rng(3)
    anchors, rows = rnd.integers(-300, 300, (17, 9)), rnd.integers(-512, 512, (200, 9))
    exact = anchors @ rows.T
    low, high = np.quantile(exact, 0.9, axis=1).astype(np.int64), np.quantile(exact, 0.98, axis=1).astype(np.int64)
    a, r, score = hard_negatives.products(anchors, hard_negatives.planes_of(rows, 10), low, high, np.ones(exact.shape, bool))
    wanted = np.nonzero((exact >= low[:, None]) & (exact <= high[:, None]))
    assert sorted(zip(a, r)) == sorted(zip(*wanted)) and np.array_equal(score, exact[a, r])
