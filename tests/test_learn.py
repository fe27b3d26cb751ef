"""Training against a numpy brute force on a small fixture."""

import numpy as np
import pytest

from quarry.operators import learn
from quarry.operators.evaluate import LinearModel


def _data(spark, n=120, d=6, k=3, seed=5):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d))
    y = rng.integers(0, k, size=n)
    df = spark.createDataFrame(
        [(i, X[i].tolist(), int(y[i])) for i in range(n)], "id long, features array<double>, label int"
    )
    return df, X, y


def _grad(theta, X, y):
    Xb = np.concatenate([X, np.ones((len(y), 1))], axis=1)
    Z = Xb @ theta.T
    P = np.exp(Z - Z.max(1, keepdims=True))
    P /= P.sum(1, keepdims=True)
    P[np.arange(len(y)), y] -= 1
    return P.T @ Xb / len(y)


@pytest.mark.parametrize("optimizer", ["sgd", "adam"])
def test_sync_sgd_matches_numpy(spark, tmp_dir, optimizer):
    df, X, y = _data(spark)
    nb, R, steps, lr = 4, 2, 5, (0.1 if optimizer == "sgd" else 0.01)
    batched = learn.prepare_batches(df, "id", nb, path=tmp_dir + "/b")
    bmap = {r["id"]: r["batch"] for r in batched.rows.select("id", "batch").collect()}
    batch = np.array([bmap[i] for i in range(len(y))])
    model, _ = learn.sgd_sync(batched, 3, 6, steps, replicas=R, lr=lr, optimizer=optimizer)
    theta = np.zeros((3, 7))
    m = np.zeros_like(theta)
    v = np.zeros_like(theta)
    for s in range(steps):
        ids = learn.step_batches(s, R, nb)
        g = sum(_grad(theta, X[batch == b], y[batch == b]) for b in ids) / len(ids)
        if optimizer == "sgd":
            theta = theta - lr * g
        else:
            t = s + 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            theta = theta - lr * np.sqrt(1 - 0.999**t) / (1 - 0.9**t) * m / (np.sqrt(v) + 1e-8)
    np.testing.assert_allclose(model.W, theta[:, :6], rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(model.b, theta[:, 6], rtol=1e-9, atol=1e-12)


def test_averaged_sgd_matches_numpy(spark):
    from pyspark.sql import functions as F

    from quarry.functions.keys import stable_bucket

    df, X, y = _data(spark)
    w = learn.sgd_averaged(df, "id", 3, 6, n_shards=3, n_batches=2, lr=0.1)
    keys = df.select("id", stable_bucket("id", 3, 0).alias("s"), stable_bucket("id", 2, "0+1").alias("b")).collect()
    shard = np.array([r["s"] for r in sorted(keys, key=lambda r: r["id"])])
    bat = np.array([r["b"] for r in sorted(keys, key=lambda r: r["id"])])
    thetas = []
    for s in sorted(set(shard)):
        theta = np.zeros((3, 7))
        for b in range(2):
            sel = (shard == s) & (bat == b)
            if sel.any():
                theta = theta - 0.1 * _grad(theta, X[sel], y[sel])
        thetas.append(theta)
    avg = sum(thetas) / len(thetas)
    got = {(r["class"], r["feature"]): r["weight"] for r in w.collect()}
    for c in range(3):
        for j in range(6):
            assert got[(c, j)] == pytest.approx(avg[c, j], rel=1e-9, abs=1e-12)
        assert got[(c, -1)] == pytest.approx(avg[c, 6], rel=1e-9, abs=1e-12)
    assert F is not None


def test_restore_or_init(spark, tmp_dir):
    path = tmp_dir + "/w"
    assert not learn.load_or_init(spark, path, 3, 4).W.any()
    model = LinearModel(np.arange(12.0).reshape(3, 4), np.array([1.0, 2.0, 3.0]))
    learn.save_weights(model, spark, path)
    back = learn.load_or_init(spark, path, 3, 4)
    np.testing.assert_array_equal(back.W, model.W)
    np.testing.assert_array_equal(back.b, model.b)


def test_bad_checkpoint_raises(spark, tmp_dir):
    import os

    path = tmp_dir + "/broken"
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        learn.load_or_init(spark, path, 3, 4)


def test_metric_log_appends(spark, tmp_dir):
    path = tmp_dir + "/m"
    learn.append_metrics(spark, [(0, "loss", 1.0)], path)
    df = learn.append_metrics(spark, [(2, "loss", 0.5)], path)
    assert sorted(tuple(r) for r in df.collect()) == [(0, "loss", 1.0), (2, "loss", 0.5)]


def _toy(spark, n=400, k=3, d=6, seed=1):
    import numpy as np

    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=d).tolist(), int(rng.integers(k))) for i in range(n)]
    return spark.createDataFrame(rows, "id long, features array<double>, label int")


def test_layout_is_stored_and_a_batch_is_split_over_tasks(spark, tmp_dir):
    import glob

    from quarry.session import scoped_conf

    batched = learn.prepare_batches(_toy(spark, 4000).repartition(4), "id", 8, path=tmp_dir + "/b", max_dirs=2)
    again = learn.open_batches(spark, tmp_dir + "/b")
    assert (again.n_batches, again.per_block) == (8, 4)
    a, _ = learn.sgd_sync(again, 3, 6, 8, replicas=2)
    b, _ = learn.sgd_sync(learn.prepare_batches(_toy(spark, 4000), "id", 8), 3, 6, 8, replicas=2)
    assert abs(a.W - b.W).max() < 1e-12
    with scoped_conf(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        learn.prepare_batches(_toy(spark, 4000).repartition(4), "id", 1, path=tmp_dir + "/one")
    assert len(glob.glob(tmp_dir + "/one/rows/block=0/*.parquet")) > 1
    batched.delete()
    assert not glob.glob(tmp_dir + "/b")


def test_empty_batches_and_wrong_labels_are_errors(spark):
    import pytest

    few = learn.prepare_batches(_toy(spark, 2), "id", 50)
    with pytest.raises(ValueError):
        learn.sgd_sync(few, 3, 6, 50)
    with pytest.raises(ValueError):
        learn.sgd_sync(few, 3, 6, 1, replicas=51)
    df = _toy(spark, 50)
    for bad in ("-1", "3", "NULL"):
        wrong = learn.prepare_batches(df.selectExpr("id", "features", f"CAST({bad} AS int) AS label"), "id", 1)
        with pytest.raises(Exception, match="label"):
            learn.sgd_sync(wrong, 3, 6, 1)


def test_partial_rows_are_bounded_per_task():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(2)
    k, d = 3, 6
    parts = [
        pa.record_batch([pa.array(rng.normal(size=(50, d)).tolist()), pa.array(rng.integers(0, k, 50), pa.int32()), pa.array(rng.integers(0, 4, 50), pa.int32())], names=["x", "y", "b"])
        for _ in range(20)
    ]
    out = list(learn._partial_gradients(np.zeros((k, d)), np.zeros(k))(iter(parts)))
    assert sum(x.num_rows for x in out) == 4 * (k * (d + 1) + 3)


def test_step_limit_and_epochs(spark):
    df = _toy(spark, 100)
    _, log = learn.train_sync(df, "id", 3, 6, 30, 2, n_batches=3, log_every=1)
    assert learn.step_limit(100, 30, 2) == 6 and {s for s, *_ in log} == set(range(6))
    one = {tuple(r) for r in learn.sgd_averaged(df, "id", 3, 6, 2, 2, epochs=1).collect()}
    assert one == {tuple(r) for r in learn.sgd_averaged(df, "id", 3, 6, 2, 2, epochs=5, max_steps=2).collect()}
    assert learn.sgd_averaged(df, "id", 3, 6, epochs=2).count() == 21


def test_restore_checks_the_shape(spark, tmp_dir):
    import pytest

    learn.save_weights(learn.LinearModel.zeros(3, 4), spark, tmp_dir + "/w")
    assert learn.load_or_init(spark, tmp_dir + "/w", 3, 4).k == 3
    with pytest.raises(ValueError):
        learn.load_or_init(spark, tmp_dir + "/w", 10, 64)
