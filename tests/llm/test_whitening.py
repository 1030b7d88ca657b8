from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from concord.llm import registry, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string, component string, sums string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, *["y"] * 4) for i, v in rows], SCHEMA)


def integers(rows):
    good = [(i, [floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and isfinite(c) for c in v)]
    size = max((len(x) for _, x in good), default=0)
    return [(i, x + [1_000_000] * (size - len(x))) for i, x in good]


def held(found, rows, most=16):
    """The rows of ``whiten`` against rational arithmetic over the distinct vectors."""
    kept = integers(rows)
    fit = [np.array(x, object) for x in sorted({tuple(x) for _, x in kept})]
    n, sums = len(fit), sum(fit)
    gram = sum(np.outer(n * x - sums, n * x - sums) for x in fit)
    v = np.array([[float(Fraction(int(e), n**3)) for e in line] for line in gram])
    e, p = np.linalg.eigh(v)
    e, p = e[::-1], p[:, ::-1]
    k = min(most, int((e > 1e-12 * e[0]).sum()))
    assert len(found) == k * len(kept)
    signs = {}
    by_row = {}
    for r in found:
        by_row.setdefault((r.vec_id, r.exact_deviation), []).append(r)
    for i, x in kept:
        off = n * np.array(x, object) - sums
        deviation = int((off * off).sum())
        own = [r for r in by_row[(i, str(deviation))]]
        assert {r.n for r in own} == {n} and {r.deviation for r in own} == {deviation if deviation < 2**63 else None}
        for r in own:
            c = r.component - 1
            wanted = float((off / n).astype(float) @ p[:, c] / np.sqrt(e[c]))
            assert abs(r.explained / (e[c] / v.trace()) - 1) < 1e-4
            close = [s for s in (1, -1) if abs(s * r.whitened - wanted) < 1e-7 * max(1, abs(wanted))]
            assert close
            if abs(wanted) > 1e-3:
                assert signs.setdefault(c, close[0]) == close[0]
    assert len({r.identity_error for r in found}) <= 1 and all(r.identity_error <= 1e-4 for r in found)


def test_equals_rational_arithmetic(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    held(registry.op12_embedding_whitening(spark, "/root/testdata/sf0.01").collect(), rows)


def test_repeats_nulls_and_short_vectors(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, (rnd.normal(size=5) * [9, 7, 5, 3, 1]).tolist()) for i in range(60)]
    rows += [(7, rows[3][1])] * 30 + [(None, rows[4][1]), (100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [float("nan")] * 5), (103, [float("-inf")] * 5), (104, [1.0, 2.0]), (105, [])]
    held(whitening.whiten(table(spark, rows)).collect(), rows)


def test_flat_dimensions_have_no_component(spark):
    rows = [(i, [float(i % 13), 1.0, float(i % 7), 2.0 * (i % 13)]) for i in range(50)]
    found = whitening.whiten(table(spark, rows)).collect()
    assert {r.component for r in found} == {1, 2}
    held(found, rows)


def test_large_entries_stay_exact(spark):
    rows = [(i, [3e9 * (i % 17) + i, -2e10 * (i % 5), 1.0 * i]) for i in range(40)]
    found = whitening.whiten(table(spark, rows)).collect()
    assert any(r.deviation is None for r in found)
    held(found, rows, most=2)


def test_empty_single_and_useless(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, [])]):
        assert whitening.whiten(table(spark, rows)).collect() == []


@pytest.mark.parametrize("bits", [5, 30, 61, 90])
def test_limb_products_are_exact(bits):
    rnd = np.random.default_rng(bits)
    values = np.array([[int(a) << max(0, bits - 30) for a in line] for line in rnd.integers(-(2 ** min(bits, 30)), 2 ** min(bits, 30), (5000, 4))], object)
    if bits < 62:
        values = values.astype(np.int64)
    exact = values.astype(object).T @ values.astype(object)
    assert (whitening.exact_gram(values) == exact).all()
