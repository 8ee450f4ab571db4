"""Whitening against exact fractions and a plain eigendecomposition."""

import math
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from ledgerspark.llm import embedding_whitening as ew
from ledgerspark.llm import queries

SF = "/root/testdata/sf0.01"


def slow(rows):
    """rows: (key, vector) -> kept integer rows, n, S, V by exact fractions."""
    kept = [(k, [math.floor(256 * float(c)) for c in v]) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(dims)]
    centred = [[x[i] - Fraction(sums[i], n) for i in range(dims)] for x in fit]
    v = [[float(sum(c[i] * c[j] for c in centred) / n) for j in range(dims)] for i in range(dims)]
    return kept, n, sums, np.array(v)


def check(rows, got, components=4):
    kept, n, sums, v = slow(rows)
    value, vectors = np.linalg.eigh(v)
    value, vectors = value[::-1], vectors[:, ::-1]
    by = defaultdict(list)
    for r in got:
        by[r.component].append(r)
    assert sorted(by) == list(range(1, min(components, len(sums)) + 1))
    for component, found in by.items():
        e, axis = value[component - 1], vectors[:, component - 1]
        exact = Counter((k, n, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for k, x in kept)
        assert Counter((r.vec_id, r.n, r.deviation) for r in found) == exact
        assert all(abs(r.explained - e / np.trace(v)) < 1e-9 for r in found)
        want = defaultdict(list)
        for k, x in kept:
            want[k, sum((n * c - s) ** 2 for c, s in zip(x, sums))].append(float(np.dot([c - s / n for c, s in zip(x, sums)], axis)) / math.sqrt(e))
        have = defaultdict(list)
        for r in found:
            have[r.vec_id, r.deviation].append(r.whitened)
        sign = 1 if all(np.allclose(sorted(have[k]), sorted(w), atol=1e-6) for k, w in want.items()) else -1
        assert all(np.allclose(sorted(sign * z for z in have[k]), sorted(w), atol=1e-6) for k, w in want.items())
        assert all(r.identity_error < 1e-9 for r in found)


def test_query_equals_exact_fractions(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    got = queries.op12_embedding_whitening(spark, SF).collect()
    check(rows, got)


def test_hostile_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=5).round(3).tolist()) for i in range(40)]
    rows += [rows[3], rows[3], (None, rows[4][1]), (None, rng.normal(size=5).tolist()), (7, None), (8, [1.0, None, 2.0, 3.0, 4.0])]
    rows += [(9, [nan, 1.0, 1.0, 1.0, 1.0]), (10, [1.0, inf, 1.0, 1.0, 1.0]), (11, [-0.0, 0.0, -inf, 0.0, 0.0]), (12, [-0.0] * 5)]
    odd = [(13, [1.0, 2.0]), (14, [])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows + odd], "vec_id long, embedding array<double>, x string, n string").repartition(3)
    check(rows, ew.whiten(df, ew.fit(df)).collect())
    assert ew.fit(df.limit(0)) is None and ew.whiten(df.limit(0), None).count() == 0
    assert ew.fit(df.filter("embedding IS NULL")) is None


def test_without_variance(spark):
    """One distinct vector, vectors on one line, fewer dimensions than components, and an extra-large entry."""
    same = spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<float>")
    got = ew.whiten(same, ew.fit(same)).collect()
    assert len(got) == 6 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None) for r in got)
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "vec_id long, embedding array<float>")
    got = ew.whiten(line, ew.fit(line)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in got) and abs(got[0].explained - 1) < 1e-9
    large = spark.createDataFrame([(i, [1e30 if i == 4 else float(i), 1.0 * (i % 3)]) for i in range(9)], "vec_id long, embedding array<double>")
    got = ew.whiten(large, ew.fit(large)).collect()
    assert len(got) == 18 and all(r.deviation is None for r in got if r.vec_id == 4)


@pytest.mark.parametrize("most", [3, 1 << 20, 1 << 40, 1 << 60, 1 << 70])
def test_square_sums_are_exact(most):
    rng = np.random.default_rng(1)
    y = [[int(rng.integers(-(1 << 30), 1 << 30)) * most >> 30 for _ in range(6)] for _ in range(200)]
    m = np.array(y, np.int64 if most < 1 << 61 else object)
    want = [sum(r[i] ** 2 for r in y) for i in range(6)] + [sum((r[i] + r[j]) ** 2 for r in y) for i in range(6) for j in range(i + 1, 6)]
    assert list(ew.pair_squares(m)) == want
    assert all(sum(d << (ew.PLACE * p) for p, d in enumerate(ew.places(v))) == v for v in (*want, 0, -1, -(5**40), 5**40))
