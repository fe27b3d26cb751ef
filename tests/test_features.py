"""Feature preparation, batching and scoring properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import arrays
from quarry.operators import batching, evaluate, features
from quarry.plans import catalog
from tests.conftest import SF_SMALL


def _labelled(spark):
    return catalog.labelled(spark, SF_SMALL)


def test_one_hot_then_argmax_is_identity(spark):
    df = features.one_hot_labels(_labelled(spark), 10)
    bad = df.where(arrays.argmax("label_onehot") != F.col("label")).count()
    assert bad == 0


def test_reshape_then_flatten_is_identity(spark):
    df = features.flatten_grid(features.reshape_grid(_labelled(spark), 8, 8), "grid", "flat")
    assert df.where(F.col("flat") != F.col("features")).count() == 0


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 0.0],)], "a array<double>")
    assert df.select(arrays.argmax("a")).first()[0] == 1


def test_split_is_repeatable_and_partition_independent(spark):
    df = _labelled(spark)
    a = {r[0]: r[1] for r in features.train_test_split(df, "vec_id").select("vec_id", "split").collect()}
    b = {r[0]: r[1] for r in features.train_test_split(df.repartition(3), "vec_id").select("vec_id", "split").collect()}
    assert a == b
    assert 0.1 < sum(v == "test" for v in a.values()) / len(a) < 0.3


def test_batches_partition_the_set(spark):
    df = batching.assign_batches(_labelled(spark).select("vec_id"), "vec_id", 64)
    n = df.count()
    assert df.select("vec_id").distinct().count() == n
    exact = batching.assign_batches_exact(_labelled(spark).select("vec_id"), "vec_id", 64)
    sizes = sorted(r[1] for r in exact.groupBy("batch").count().collect())
    assert sum(sizes) == n and all(s == 64 for s in sizes[1:])


def test_repeat_epochs_is_a_row_expansion(spark):
    df = batching.repeat_epochs(spark.range(10), 3)
    assert df.count() == 30
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_scores_match_numpy(spark):
    rng = np.random.default_rng(3)
    W, b = rng.normal(size=(4, 5)), rng.normal(size=4)
    X = rng.normal(size=(20, 5))
    df = spark.createDataFrame([(i, X[i].tolist(), int(i % 4)) for i in range(20)], "id int, features array<double>, label int")
    model = evaluate.LinearModel(W, b)
    got = np.array([r["z"] for r in evaluate.with_scores(df, model).orderBy("id").collect()])
    np.testing.assert_allclose(got, X @ W.T + b, rtol=1e-12)
    p = np.array([r["p"] for r in evaluate.with_probabilities(df, model).orderBy("id").collect()])
    Z = X @ W.T + b
    P = np.exp(Z - Z.max(1, keepdims=True))
    np.testing.assert_allclose(p, P / P.sum(1, keepdims=True), rtol=1e-12)
    loss = evaluate.cross_entropy(df, model).first()["loss"]
    lse = np.log(np.exp(Z).sum(1))
    assert loss == pytest.approx(np.mean(lse - Z[np.arange(20), np.arange(20) % 4]), rel=1e-12)


def test_loss_has_no_log_zero_hole(spark):
    # a huge margin makes softmax underflow to 0 for the true class
    model = evaluate.LinearModel(np.array([[1000.0], [-1000.0]]), np.zeros(2))
    df = spark.createDataFrame([(0, [1.0], 1)], "id int, features array<double>, label int")
    loss = evaluate.cross_entropy(df, model).first()["loss"]
    assert loss == pytest.approx(2000.0)
