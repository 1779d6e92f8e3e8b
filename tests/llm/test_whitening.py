"""Whitening against whole-number sums in plain Python."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from riskloom.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def integer(c):
    return math.floor(64 * float(c)) + 1_000_000


def brute(rows, components=16):
    """(vec_id, vector) -> {vec_id: (n, deviation, |whitened|)}, explained, by plain sums."""
    fine = [(i, [integer(c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = [list(x) for x in {tuple(x) for _, x in fine}]
    n, size = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(size)]
    cov = [[(n * sum(x[i] * x[j] for x in fit) - sums[i] * sums[j]) / (n * n) for j in range(size)] for i in range(size)]
    values, vectors = np.linalg.eigh(np.array(cov))
    order = np.argsort(-values)[:components]
    out = []
    for i, x in fine:
        moved = [n * a - s for a, s in zip(x, sums)]
        w = (np.array(moved, dtype=float) / n) @ vectors[:, order] / np.sqrt(values[order])
        out.append((i, n, sum(m * m for m in moved), np.abs(w)))
    return out, values[order] / np.trace(np.array(cov))


def test_query_equals_plain_sums(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want, explained = brute(rows)
    found = queries.op13_whitening(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == 16 * len(want)
    by = {(r.vec_id, r.component): r for r in found}
    for i, n, deviation, whitened in want:
        for k in range(16):
            r = by[i, k + 1]
            assert (r.n, r.deviation) == (n, deviation)
            assert r.whitened == pytest.approx(whitened[k], abs=1e-6) or -r.whitened == pytest.approx(whitened[k], abs=1e-6)
            assert r.explained == pytest.approx(explained[k], rel=1e-9)
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-9


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(1, 5), st.integers(0, 40), st.integers(0, 2**31))
def test_bit_planes_give_exact_products(rows, dimensions, bits, seed):
    numbers = np.random.default_rng(seed)
    x = numbers.integers(-(2**bits), 2**bits + 1, (rows, dimensions)) + 1_000_000
    sums, crossed = whitening.scattered(x)
    exact = x.astype(object)
    assert (crossed == exact.T @ exact).all() and (sums == exact.sum(axis=0)).all()
    for v in crossed.ravel():
        low, mid, high = whitening.limbs(int(v))
        assert low + (mid << 40) + (high << 80) == v and 0 <= low < 1 << 40 and 0 <= mid < 1 << 40


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.1, 0.5, 0.0], 1), (1, [0.1, 0.5, 0.0], 1), (2, [0.101, 0.5, 0.0], 1), (3, [-0.3, 0.25, 0.0], None),
        (None, [1.0, -1.0, 0.0], 2), (4, None, 2), (5, [], 2), (6, [0.1, None, 0.2], 2), (7, [nan, 0.1, 0.2], 2),
        (8, [inf, 0.1, 0.2], 2), (9, [0.5, 0.5], 2), (10, [1e300, 0.0, 0.0], 2), (11, [0.0, 0.0, 0.0], 3),
    ]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(4), components=16).collect()
    assert sorted((r.row.vec_id or 0) for r in found) == sorted([0, 1, 1, 2, 3, 11] * 3)
    assert {r.n for r in found} == {4}  # vectors 1 and 2 have the same integers
    assert all((r.whitened is None) == (r.component == 3) for r in found)
    assert sum(r.explained for r in found if r.row.vec_id == 3) == pytest.approx(1)
    assert all(r.identity_error < 1e-9 for r in found)


def test_few_rows(spark):
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25], 0)], SCHEMA)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(k, 1, 0, None, None, None) for k in (1, 2)]
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 0), (2, [], 0)], SCHEMA)).count() == 0


def test_large_integers_stay_exact(spark):
    rows = [(i, [float(2**50) * (i % 3), float(i)], 0) for i in range(5)]
    want, _ = brute([(i, v) for i, v, _ in rows])
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "row"), components=1).collect()
    for i, n, deviation, whitened in want:
        r = next(r for r in found if r.row.vec_id == i)
        assert r.n == n and r.deviation == (deviation if deviation < 2**63 else None)
        assert abs(r.whitened) == pytest.approx(whitened[0], rel=1e-9)
