"""Whitening against exact covariances in plain Python."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import whitening as W
from quarry.sources.tables import table

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>"


def exact(vectors):
    """Fit list, its sums, and its covariance in fractions."""
    fit = sorted({tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in v) for v in vectors})
    n, d = len(fit), len(fit[0])
    S = [sum(x[i] for x in fit) for i in range(d)]
    V = [[Fraction(sum((n * x[i] - S[i]) * (n * x[j] - S[j]) for x in fit), n**3) for j in range(d)] for i in range(d)]
    return fit, S, np.array([[float(v) for v in row] for row in V])


def test_equals_exact_covariance(spark):
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(6, 6))
    data = [(i, (rng.normal(size=6) @ mix).astype("f4").tolist()) for i in range(300)]
    data += [(1000 + i, data[7][1]) for i in range(150)]  # a third of the rows are copies
    data += [(7, None), (8, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (9, [float("nan")] * 6), (None, data[3][1]), (10, [float("inf")] * 6)]
    rows = spark.createDataFrame(data, SCHEMA).repartition(5)
    fit, S, V = exact([v for _, v in data[:300]])
    got = W.whitening_digest(rows).toPandas()
    assert len(got) == 451 * 6 and set(got.n) == {len(fit)}
    values = np.sort(np.linalg.eigvalsh(V))[::-1]
    first = got[got.vec_id == 7].sort_values("component")
    np.testing.assert_allclose(first.explained, values / V.trace(), rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    for i in (0, 7, 1003):
        x = [math.floor(64 * c) + 1000000 for c in data[i][1]] if i < 300 else [math.floor(64 * c) + 1000000 for c in data[7][1]]
        mine = got[got.vec_id == i]
        assert set(mine.deviation) == {sum((len(fit) * a - s) ** 2 for a, s in zip(x, S))}
    # projections on orthonormal eigenvectors: whitened inner products are the Mahalanobis form
    X = np.array([[float(Fraction(a) - Fraction(s, len(fit))) for a, s in zip(x, S)] for x in fit])
    Z = got[got.vec_id < 300].pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    order = [fit.index(tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in data[i][1])) for i in range(300)]
    want = X[order] @ np.linalg.inv(V) @ X[order].T
    np.testing.assert_allclose(Z @ Z.T, want, atol=1e-7)


def test_components_are_eigenvectors(spark):
    rows = table(spark, SF, "embeddings")
    model = W.fit_whitening(rows)
    _, _, V = exact([r["embedding"] for r in rows.collect()])
    assert model.components == 16 and model.identity_error < 1e-9
    np.testing.assert_allclose(V @ model.directions, model.directions * model.eigenvalues, atol=1e-10)
    np.testing.assert_allclose(model.directions.T @ model.directions, np.eye(16), atol=1e-12)
    assert (np.diff(model.eigenvalues) <= 0).all()


def test_defined_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert W.whitening_digest(empty).count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)
    assert W.whitening_digest(one).count() == 0 and W.fit_whitening(one).n == 1
    flat = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (2, [3.0, 2.0])], SCHEMA)  # one dimension never varies
    got = W.whitening_digest(flat).orderBy("vec_id").collect()
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], r["explained"]) for r in got] == [(1, 1, 2, 128**2, 1.0)] + [(2, 1, 2, 128**2, 1.0)] * 2
    assert [round(r["whitened"], 9) for r in got] == [-1, 1, 1] or [round(r["whitened"], 9) for r in got] == [1, -1, -1]
    named = flat.withColumn("whitened", F.lit("mine")).withColumn("deviation", F.lit("mine")).withColumn("both", F.lit(1)).withColumn("x", F.lit(1))
    kept = W.fit_whitening(named).transform(named)
    assert kept.columns == ["vec_id", "embedding", "whitened", "deviation", "both", "x", "deviation_", "whitened_"]
    assert kept.where("whitened = 'mine' AND deviation = 'mine' AND size(whitened_) = 1").count() == 3
    with pytest.raises(ValueError, match="entries"):
        W.fit_whitening(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA))
    with pytest.raises(ValueError, match="beyond"):
        W.fit_whitening(spark.createDataFrame([(1, [1e30]), (2, [1.0])], SCHEMA))


def test_large_numbers_stay_exact(spark):
    model = W.Whitening(10**10, (1000000, 1000000), (3, 10**10 - 1), np.eye(2), np.ones(2), np.ones(2), 0.0)
    X = np.array([[1000000 + 5, 1000000], [1000000, 1000000 + 1]])
    small = W.Whitening(1000, (1000000, 1000000), (3, 999), np.eye(2), np.ones(2), np.ones(2), 0.0)
    S = [1000 * 1000000 + 3, 1000 * 1000000 + 999]
    assert small.deviations(X) == [sum((1000 * int(a) - s) ** 2 for a, s in zip(x, S)) for x in X]
    assert model.deviations(X) == [None, 3**2 + 1]
