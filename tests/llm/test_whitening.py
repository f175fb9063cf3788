import math
import random

import numpy as np
import pytest

from lodestrata.llm import whitening

from tests.helpers import rows

SCHEMA = "vec_id long, embedding array<float>, component string, n string"


def expected(vectors, k):
    """numpy's own decomposition of the same integers, and the deviations by Python's integers."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    cov = centred.T @ centred / n
    values, parts = np.linalg.eigh(cov)
    values, parts = values[::-1][:k], parts[:, ::-1][:, :k]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    return centred @ parts / np.sqrt(values), values / np.trace(cov), deviation


def table(seed, n=300, d=12):
    r = np.random.default_rng(seed)
    return (r.standard_normal((n, d)) @ r.standard_normal((d, d)) * 0.2 + r.standard_normal(d)).astype(np.float32)


def test_against_numpy(spark):
    vectors = table(1)
    data = [(i, v.tolist(), "x", "y") for i, v in enumerate(vectors)]
    odd = [(900, None, "", ""), (901, [], "", ""), (902, [None] + [0.0] * 11, "", ""), (903, [math.nan] * 12, "", ""), (904, [math.inf] + [0.0] * 11, "", ""), (905, [1e30] + [0.0] * 11, "", ""), (906, [1.0, 2.0], "", "")]
    found = whitening.whiten(spark, spark.createDataFrame(data + odd, SCHEMA).repartition(7)).collect()
    white, explained, deviation = expected(vectors, 8)
    assert len(found) == 300 * 8 and {r["vec_id"] for r in found} == set(range(300))
    by = {(r["vec_id"], r["component"]): r for r in found}
    for c in range(8):
        mine = np.array([by[i, c + 1]["whitened"] for i in range(300)])
        sign = np.sign(mine @ white[:, c])
        assert np.abs(sign * mine - white[:, c]).max() < 1e-9
        assert abs(by[0, c + 1]["explained"] / explained[c] - 1) < 1e-10
    assert all(r["deviation"] == deviation[r["vec_id"]] == int(r["deviation_exact"]) and r["n"] == 300 for r in found)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-10


def test_ties_repeats_and_low_rank(spark):
    flat = [(None, [0.5, 0.5, 0.5], "", "")] * 4
    assert rows(whitening.whiten(spark, spark.createDataFrame(flat, SCHEMA))) == []
    assert rows(whitening.whiten(spark, spark.createDataFrame([], SCHEMA))) == []
    line = [(i, [i / 8, i / 4, 1.0], "", "") for i in range(5)] * 2
    found = rows(whitening.whiten(spark, spark.createDataFrame(line, SCHEMA)))
    assert len(found) == 10 and {r[1] for r in found} == {1} and abs(found[0][5] - 1) < 1e-12
    with pytest.raises(ValueError):
        whitening.whiten(spark, spark.createDataFrame(line, SCHEMA).withColumnRenamed("vec_id", "n2").selectExpr("n2 AS whitened", "embedding"), key="whitened")


def test_equal_variances_have_orthogonal_components(spark):
    square = [(i, [float(np.cos(i * np.pi / 2)), float(np.sin(i * np.pi / 2)), 0.0], "", "") for i in range(40)]
    found = whitening.whiten(spark, spark.createDataFrame(square, SCHEMA)).collect()
    assert {r["component"] for r in found} == {1, 2} and found[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("kind", ["random", "clusters", "blocks", "wide range", "diagonal", "one"])
def test_eigenvectors(kind):
    r = np.random.default_rng(5)
    q, _ = np.linalg.qr(r.standard_normal((40, 40)))
    values = {"random": r.random(40), "clusters": np.r_[[3.0] * 6, 2.0 + 1e-13 * np.arange(4), [1.0] * 30], "wide range": 10.0 ** -np.arange(40)}.get(kind)
    m = q @ np.diag(values) @ q.T if values is not None else None
    if kind == "blocks":
        m = np.kron(np.eye(10), [[2.0, 1.0, 0, 0], [1.0, 2.0, 0, 0], [0, 0, 5.0, 1e-3], [0, 0, 1e-3, 5.0]])
    elif kind == "diagonal":
        m = np.diag(np.arange(40.0))
    elif kind == "one":
        m = np.array([[4.0]])
    m = (m + m.T) / 2
    found, vectors = whitening.principal(m, 8)
    true = np.linalg.eigvalsh(m)[::-1][: len(found)]
    assert len(found) == min(8, len(m)) and np.abs(found - true).max() < 1e-13 * 40 * true[0]
    assert np.abs(m @ vectors - vectors * found).max() < 1e-13 * 40 * true[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12


def test_sturm_counts():
    r = np.random.default_rng(2)
    d, e = r.standard_normal(30), r.standard_normal(29)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = r.standard_normal(50) * 3
    assert whitening.sturm_count(d, e, at).tolist() == [int((values < t).sum()) for t in at]


def test_exact_sums_of_squares():
    r = random.Random(3)
    for most in (10, 1 << 33, 1 << 47, 1 << 60):
        y = np.array([[r.randrange(-most, most) for _ in range(9)] for _ in range(20)], np.int64)
        assert whitening.squared_length(y) == [sum(int(v) ** 2 for v in row) for row in y]
    assert whitening._scaled(np.array([[1 << 40]]), 1 << 30, [5])[0, 0] == (1 << 70) - 5
