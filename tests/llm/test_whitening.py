"""Whitening against numpy's eigenvalues of the exact covariance."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import registry, whitening

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, component string, whitened int"


def spectrum(kind, n):
    r = np.random.default_rng(1)
    turn = np.linalg.qr(r.standard_normal((n, n)))[0]
    values = {"spread": r.gamma(2, 1, n), "equal": np.repeat([5.0, 2.0, 1.0], [3, 10, n - 13]), "same": np.full(n, 7.5), "zero": np.zeros(n),
              "close": np.concatenate([1 + 1e-9 * np.arange(n - 20), np.linspace(2, 3, 20)]), "steep": 2.0 ** -np.arange(n),
              "low rank": np.concatenate([[4, 3, 3, 1], np.zeros(n - 4)])}[kind]
    matrix = turn @ np.diag(values) @ turn.T
    return (matrix + matrix.T) / 2


@pytest.mark.parametrize("n, most", [(34, 32), (60, 8)])
@pytest.mark.parametrize("kind", ["spread", "equal", "same", "zero", "close", "steep", "low rank"])
def test_components_of_spectra(kind, n, most):
    matrix = spectrum(kind, n)
    want = np.linalg.eigvalsh(matrix)[::-1]
    cut = whitening.intervals(matrix, most)
    good = min(most, int((want > whitening.FLOOR * max(want[0], 1e-9)).sum()))
    if not good:
        assert cut == []
        return
    found = np.concatenate([whitening.inside(matrix, *c).T for c in cut])
    assert len(found) == sum(c for _, _, c in cut)
    values, vectors = whitening.ritz(matrix, found.T)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    assert len(values) == good
    assert np.allclose(values, want[:good], atol=1e-13 * want[0])
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-13 * want[0]
    assert np.allclose(vectors.T @ vectors, np.eye(good), atol=1e-13)


def test_counts_are_those_of_eigenvalues():
    r = np.random.default_rng(2)
    for n in (1, 2, 3, 17):
        a = r.integers(-3, 4, (n, n)).astype(float)
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        diagonal, off = whitening.tridiagonal(a)
        shifts = np.concatenate([(values[1:] + values[:-1]) / 2, [values[0] - 1, values[-1] + 1]])
        shifts = shifts[np.abs(shifts[:, None] - values).min(axis=1) > 1e-9]
        assert whitening.counts_below(diagonal, off, shifts).tolist() == [(values < s).sum() for s in shifts]


def exact(vectors):
    """Sums and covariance of the whole numbers, as fractions rounded once."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    at = [[n * c - s for c, s in zip(row, sums)] for row in x]
    size = len(sums)
    cov = np.array([[float(Fraction(sum(row[i] * row[j] for row in at), n ** 3)) for j in range(size)] for i in range(size)])
    return x, sums, [sum(c * c for c in row) for row in at], cov


def check(rows, vectors, ids, most=32):
    x, sums, deviations, cov = exact(vectors)
    n, values = len(x), np.linalg.eigvalsh(cov)[::-1]
    good = min(most, int((values > whitening.FLOOR * values[0]).sum()))
    assert len(rows) == n * good
    by = {}
    for r in rows:
        by.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    table = []
    for key, row in zip(ids, deviations):
        assert sorted(by[key]) == list(range(1, good + 1))
        table.append([by[key][k + 1][0]["whitened"] for k in range(good)])
        assert all(r["deviation"] == row and r["n"] == n for k in by[key].values() for r in k)
        assert all(by[key][k + 1][0]["explained"] == pytest.approx(values[k] / cov.trace(), rel=1e-9) for k in range(good))
    z = np.array(table)
    assert np.abs(z.T @ z / n - np.eye(good)).max() < 1e-8
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-8
    # Back in the entries: each component is an eigenvector.
    apart = np.array([[c - s / n for c, s in zip(row, sums)] for row in x])
    axes = apart.T @ z / n / np.sqrt(values[:good])
    assert np.abs(cov @ axes - axes * values[:good]).max() < 1e-9 * values[0]


def test_query_equals_exact_covariance(spark):
    rows = registry.op11_whitening(spark, SF).collect()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(rows, [r["embedding"] for r in table], [r["vec_id"] for r in table])


def test_awkward_rows(spark):
    r = np.random.default_rng(5)
    good = [[float(c) for c in r.normal(0, 3, 5)] for _ in range(40)]
    rows = [(i, v, "x", 1) for i, v in enumerate(good)]
    bad = [(100, None, None, None), (101, [1.0, None, 2.0, 3.0, 4.0], None, None), (102, [float("nan")] * 5, None, None),
           (103, [1.0, 2.0, float("inf"), 3.0, 4.0], None, None), (104, [], None, None)]
    df = spark.createDataFrame(rows + bad, VECTORS).repartition(4)
    got = whitening.whiten(df, whitening.fit(df)).collect()
    kept = {x["vec_id"]: x["embedding"] for x in df.collect() if x["vec_id"] < 100}
    check(got, [kept[i] for i in sorted(kept)], sorted(kept))
    twice = spark.createDataFrame(rows + rows + [(None, good[0], None, None)], VECTORS)
    again = whitening.whiten(twice, whitening.fit(twice, most=2))
    assert again.count() == 81 * 2 and again.where(F.col("vec_id").isNull()).count() == 2


def test_few_rows(spark):
    for rows in ([], [(1, None, None, None)], [(1, [1.0, 2.0], None, None)], [(1, [1.0, 2.0], None, None)] * 3):
        df = spark.createDataFrame(rows, VECTORS)
        out = whitening.whiten(df, whitening.fit(df))
        assert out.collect() == [] and out.columns[0] == "vec_id"
    lengths = spark.createDataFrame([(1, [1.0, 2.0], None, None), (2, [1.0], None, None)], VECTORS).repartition(2)
    with pytest.raises(Exception, match="several lengths"):
        whitening.fit(lengths)


def test_large_entries_stay_exact(spark):
    r = np.random.default_rng(6)
    vectors = [[float(c) for c in np.float32(r.normal(0, 1, 3) * [1e9, 1, 1e5])] for _ in range(30)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    rows, sums = whitening._sums(df.select(F.col("embedding")), 64, 1_000_000)
    x, want, _, cov = exact(vectors)
    assert (rows, sums) == (30, want)
    assert (whitening._covariance(df.select("embedding"), rows, sums, 64, 1_000_000) == cov).all()
