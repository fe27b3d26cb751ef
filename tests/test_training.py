"""Runs that stop and go on, their metric logs, and the feed-forward network."""

import numpy as np
import pytest

from quarry.operators import evaluate, learn, network, progress
from quarry.sources.versions import Versions


def _toy(spark, n=240, k=3, d=6, seed=1):
    rng = np.random.default_rng(seed)
    X, y = rng.normal(size=(n, d)), rng.integers(0, k, n)
    rows = [(i, X[i].tolist(), int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, features array<double>, label int").repartition(3).cache()


class Failing(learn.Softmax):
    """Fails at the given step of this call."""

    left = None

    def partials(self, theta):
        if Failing.left is not None:
            Failing.left -= 1
            if Failing.left < 0:
                raise RuntimeError("lost")
        return super().partials(theta)

    def __repr__(self):
        return "Softmax"


def _run(rows, tmp, spark, objective, **more):
    metrics = progress.MetricLog(spark, tmp + "/metrics", "a")
    checkpoints = progress.Checkpoints(spark, tmp + "/checkpoints")
    model, _ = learn.train(rows, "id", objective, 60, 3, replicas=2, n_batches=4, log_every=1, metrics=metrics, checkpoints=checkpoints, **more)
    return model, metrics, checkpoints


@pytest.mark.parametrize("optimizer,every", [("sgd", None), ("adam", 3)])
def test_a_run_that_fails_goes_on_as_if_it_had_not(spark, tmp_dir, optimizer, every):
    rows = _toy(spark)
    settings = {"optimizer": optimizer, "lr": 0.05, "checkpoint_every": every}
    whole, log, _ = _run(rows, tmp_dir + "/whole", spark, Failing(3, 6), **settings)
    Failing.left = 6  # steps 0..5 are taken, the seventh fails in the second epoch
    with pytest.raises(RuntimeError, match="lost"):
        _run(rows, tmp_dir + "/torn", spark, Failing(3, 6), **settings)
    Failing.left = None
    torn = progress.Checkpoints(spark, tmp_dir + "/torn/checkpoints")
    assert torn.versions.latest() == (4 if every is None else 6)
    logged = progress.MetricLog(spark, tmp_dir + "/torn/metrics", "a").read()
    assert {r["step"] for r in logged.collect()} == set(range(6))  # written while it went on
    again, relog, checkpoints = _run(rows, tmp_dir + "/torn", spark, Failing(3, 6), **settings)
    np.testing.assert_allclose(again.W, whole.W, rtol=0, atol=1e-12)
    np.testing.assert_allclose(again.b, whole.b, rtol=0, atol=1e-12)
    a, b = sorted(map(tuple, log.read().collect())), sorted(map(tuple, relog.read().collect()))
    assert len(a) == len(b) == 12 * 2
    for x, y in zip(a, b):
        assert x[:3] == y[:3] and x[3] == pytest.approx(y[3], abs=1e-12)
    assert checkpoints.versions.latest() == 12 and len(checkpoints.versions.complete()) <= progress.KEPT
    # a finished run takes no step more; more epochs go on
    done, _, _ = _run(rows, tmp_dir + "/torn", spark, Failing(3, 6), **settings)
    np.testing.assert_array_equal(done.W, again.W)


def test_a_checkpoint_of_another_run_is_an_error(spark, tmp_dir):
    rows = _toy(spark)
    _run(rows, tmp_dir, spark, learn.Softmax(3, 6), stop_after=4)
    for other in ({"lr": 0.5}, {"seed": 9}, {"optimizer": "adam"}):
        with pytest.raises(ValueError, match="another run"):
            _run(rows, tmp_dir, spark, learn.Softmax(3, 6), **other)
    with pytest.raises(ValueError, match="rows"):
        _run(rows.limit(200), tmp_dir, spark, learn.Softmax(3, 6))


def test_only_committed_versions_are_read(spark, tmp_dir):
    import os

    versions = Versions(spark, tmp_dir + "/v")
    assert versions.latest() is None
    one = spark.createDataFrame([(1,)], "x int")
    versions.write(1, t=one)
    os.makedirs(tmp_dir + "/v/v000000000000000007/t")  # a writer that died
    one.write.parquet(tmp_dir + "/v/v000000000000000005/t")
    os.makedirs(tmp_dir + "/v/notes")
    assert versions.complete() == [1]
    versions.write(5, t=spark.createDataFrame([(5,)], "x int"))
    assert versions.latest() == 5 and [r["x"] for r in versions.read(5, "t").collect()] == [5]
    versions.write(5, t=spark.createDataFrame([(6,)], "x int"))
    assert [r["x"] for r in versions.read(5, "t").collect()] == [6]
    for v in (8, 9, 10):
        versions.write(v, t=one)
    versions.keep_last(2)
    assert versions.complete() == [9, 10]
    checkpoints = progress.Checkpoints(spark, tmp_dir + "/c")
    assert checkpoints.load() is None
    checkpoints.save(3, {"theta": np.array([0.1, -1e-300, np.pi]), "m": np.zeros(2)}, {"a": 1})
    os.remove(tmp_dir + "/c/v000000000000000003/_COMMITTED")
    assert checkpoints.load() is None
    checkpoints.save(2, {"theta": np.array([0.1, -1e-300, np.pi])}, {"a": 1})
    step, arrays, about = checkpoints.load()
    assert step == 2 and arrays["theta"].tolist() == [0.1, -1e-300, np.pi] and about == {"a": 1}


def test_metric_log_keeps_runs_apart(spark, tmp_dir):
    first, second = (progress.MetricLog(spark, tmp_dir + "/m", r) for r in ("one", "two"))
    assert first.read().count() == 0
    first.write(0, {"loss": 1.0})
    second.write(0, {"loss": 2.0, "accuracy": 0.5})
    first.write(0, {"loss": 1.5})  # the step taken again
    assert [tuple(r) for r in first.read().collect()] == [("one", 0, "loss", 1.5)]
    assert second.read().count() == 2
    with pytest.raises(ValueError):
        progress.MetricLog(spark, tmp_dir, "a/b")


# -- the network ---------------------------------------------------------------------


def _loss(theta, objective, X, y):
    A = X
    layers = objective.model(theta).layers
    for n, (W, b) in enumerate(layers):
        A = A @ W.T + b
        if n < len(layers) - 1:
            A = np.where(A > 0, A, 0)
    P = np.exp(A) / np.exp(A).sum(axis=1, keepdims=True)
    return -np.log(P[np.arange(len(y)), y]).sum()


@pytest.mark.parametrize("sizes", [(5, 7, 6, 4), (5, 3), (4, 8, 3)])
def test_gradient_equals_finite_differences(sizes):
    rng = np.random.default_rng(3)
    objective = network.FeedForward(sizes)
    X, y = rng.normal(size=(30, sizes[0])), rng.integers(0, sizes[-1], 30)
    theta = rng.normal(scale=0.6, size=objective.size)
    g, loss, ok = network.loss_gradient(objective.model(theta), X, y)
    assert loss.sum() == pytest.approx(_loss(theta, objective, X, y), rel=1e-12)
    step = 1e-6
    for i in range(objective.size):
        e = np.zeros(objective.size)
        e[i] = step
        want = (_loss(theta + e, objective, X, y) - _loss(theta - e, objective, X, y)) / (2 * step)
        assert g[i] == pytest.approx(want, rel=1e-5, abs=1e-6)
    assert ok.tolist() == (objective.model(theta).logits(X).argmax(axis=1) == y).tolist()


def test_network_steps_match_numpy(spark, tmp_dir):
    rows = _toy(spark)
    objective = network.FeedForward((6, 8, 5, 3))
    start = network.Network.random(objective.sizes, seed=4)
    batched = learn.prepare_batches(rows, "id", 4, "0/0", path=tmp_dir + "/b")
    data = batched.rows.select("id", "features", "label", "batch").toPandas()
    X, y, batch = np.stack(data.features), data.label.to_numpy(), data.batch.to_numpy()
    theta, m, v = objective.flat(start), 0.0, 0.0
    for s in range(4):
        g = 0
        for b in learn.step_batches(s, 2, 4):
            part, _, _ = network.loss_gradient(objective.model(theta), X[batch == b], y[batch == b])
            g = g + part / (batch == b).sum() / 2
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.01 * np.sqrt(1 - 0.999 ** (s + 1)) / (1 - 0.9 ** (s + 1)) * m / (np.sqrt(v) + 1e-7)
    got, _ = learn.train(rows, "id", objective, 60, 1, replicas=2, n_batches=4, lr=0.01, optimizer="adam", epsilon=1e-7, init=start)
    np.testing.assert_allclose(objective.flat(got), theta, rtol=0, atol=1e-10)


def test_network_learns_what_a_linear_model_cannot(spark):
    rng = np.random.default_rng(6)
    X = rng.uniform(-1, 1, (600, 2))
    y = (X[:, 0] * X[:, 1] > 0).astype(int)
    rows = spark.createDataFrame([(i, X[i].tolist(), int(y[i])) for i in range(600)], "id long, features array<double>, label int").cache()
    objective = network.FeedForward((2, 24, 12, 2))
    model, _ = learn.train(rows, "id", objective, 150, 12, n_batches=4, lr=0.02, optimizer="adam", init=network.Network.random(objective.sizes, 1))
    right = evaluate.accuracy_counts(rows, model).first()["accuracy"]
    linear, _ = learn.train_sync(rows, "id", 2, 2, 150, 6, n_batches=4, lr=0.1, optimizer="adam")
    assert right > 0.93 > 0.7 > evaluate.accuracy_counts(rows, linear).first()["accuracy"]


def test_network_weights_round_trip(spark):
    model = network.Network.random((4, 6, 3), seed=2)
    back = network.Network.from_frame(model.to_frame(spark).repartition(3))
    assert back.sizes == (4, 6, 3)
    for (W, b), (V, c) in zip(model.layers, back.layers):
        np.testing.assert_array_equal(W, V)
        np.testing.assert_array_equal(b, c)
    rows = _toy(spark, 50, k=3, d=4)
    pred = [r["pred"] for r in evaluate.batch_score(rows, back).orderBy("id").collect()]
    X = np.stack([r["features"] for r in rows.orderBy("id").collect()])
    assert pred == model.logits(X).argmax(axis=1).tolist()
    with pytest.raises(ValueError):
        network.FeedForward((4, 5, 3)).flat(model)
