"""Training of a softmax (multinomial logistic) classifier on Spark.

Synchronous data-parallel SGD (the reference's replicated workers with a
gradient aggregator): every step reads the ``replicas`` batches it needs,
each Spark task turns its Arrow batches into partial gradient sums with
numpy and emits them once, Spark adds the partials up and averages over the
replicas, and the driver applies one small update. Step
``s`` uses batches ``(s·R + r) mod nb`` for ``r < R``; its gradient is the
mean over replicas of each batch's mean gradient, as a synchronous replica
aggregator computes it.

The driver only ever holds model-sized arrays (``k × (d + 1)`` weights,
Adam moments, one gradient); examples never leave the
executors. Prepared batches are written once, partitioned by ``batch``,
under the shared checkpoint folder, so each step's filter prunes to the
files of its own batches instead of scanning the whole set.

What is fitted is an objective: a number of parameters in one flat vector, and
the body that turns Arrow batches into partial gradients (:class:`Softmax` here,
``FeedForward`` in :mod:`quarry.operators.network`). :func:`train` saves its state
as it goes and goes on from the newest complete checkpoint; its metrics are
written step by step.

Shard-local SGD with weight averaging (re-aim of the reference's
independent workers): each shard runs plain SGD over its own batches in
one streaming pass (rows sorted by ``(shard, batch)``), then the per-shard
weights are averaged and the next epoch starts from them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import stable_bucket
from ..session import drop_path, scoped_conf, scratch_path
from ..sources import files
from .evaluate import BIAS, LinearModel
from .progress import Checkpoints, MetricLog

# Fixed values of the reference scripts.
LEARNING_RATE = 0.025
ADAM_RATE = 1e-3
ADAM_BETA1 = 0.9
ADAM_BETA2 = 0.999
ADAM_EPSILON = 1e-8

_COUNT = -1  # gradient index reserved for the example count
_LOSS = -2   # ... for the summed loss
_OK = -3     # ... for the number of correct predictions


def _softmax_rows(Z: np.ndarray) -> np.ndarray:
    Z = Z - Z.max(axis=1, keepdims=True)
    E = np.exp(Z)
    return E / E.sum(axis=1, keepdims=True)


def log_sum_exp(Z: np.ndarray) -> np.ndarray:
    m = Z.max(axis=1)
    return m + np.log(np.exp(Z - m[:, None]).sum(axis=1))


def emitted_sums(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Summed gradients of each mini-batch, followed by its count, loss and hits, as ``(batch, idx, g, n)`` rows."""
    for batch, found in sums.items():
        idx = np.concatenate([np.arange(len(found) - 3), [_COUNT, _LOSS, _OK]]).astype(np.int32)
        columns = [np.full(len(idx), batch, np.int32), idx, found, np.full(len(idx), found[-3])]
        yield pa.record_batch([pa.array(c) for c in columns], names=["batch", "idx", "g", "n"])


def dense_rows(column, d: int) -> np.ndarray:
    """An Arrow list column as an ``n x d`` matrix: one reshape of its flat values."""
    sizes = column.value_lengths()
    if column.null_count or sizes.null_count or set(sizes.unique().to_pylist()) - {d}:
        raise ValueError(f"every feature vector needs {d} values")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def class_labels(column, k: int) -> np.ndarray:
    """Integer labels; one that is missing or not in ``0..k-1`` is an error."""
    if column.null_count:
        raise ValueError("a label is missing")
    y = column.to_numpy(zero_copy_only=False).astype(np.int64)
    if len(y) and not (0 <= y.min() and y.max() < k):
        raise ValueError(f"labels must be in 0..{k - 1}; found {y.min()}..{y.max()}")
    return y


def _partial_gradients(W: np.ndarray, b: np.ndarray):
    """mapInArrow body over ``(features, label, batch)``: the task's summed
    gradients of the cross-entropy with counts, losses and hits, emitted once
    per mini-batch at the end of the task."""
    k, d = W.shape

    def fn(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for part in it:
            if not part.num_rows:
                continue
            X, y = dense_rows(part.column(0), d), class_labels(part.column(1), k)
            Z = X @ W.T + b
            rows = np.arange(len(y))
            loss = log_sum_exp(Z) - Z[rows, y]
            ok = Z.argmax(axis=1) == y
            D = _softmax_rows(Z)
            D[rows, y] -= 1.0
            batches = part.column(2).to_numpy(zero_copy_only=False)
            for bid in np.unique(batches).tolist():
                sel = batches == bid
                # index c*(d+1)+j, j=d is the bias
                full = np.concatenate([D[sel].T @ X[sel], D[sel].sum(axis=0)[:, None]], axis=1).ravel()
                found = np.concatenate([full, [sel.sum(), loss[sel].sum(), ok[sel].sum()]])
                sums[bid] = sums[bid] + found if bid in sums else found
        yield from emitted_sums(sums)

    return fn


@dataclass(frozen=True)
class Softmax:
    """Softmax regression: for each class its ``d`` weights, then its bias."""

    k: int
    d: int

    @property
    def size(self) -> int:
        return self.k * (self.d + 1)

    def start(self) -> np.ndarray:
        return np.zeros(self.size)

    def flat(self, model: LinearModel) -> np.ndarray:
        if (model.k, model.d) != (self.k, self.d):
            raise ValueError(f"a {model.k} x {model.d} model; {self.k} x {self.d} was asked for")
        return np.concatenate([model.W, model.b[:, None]], axis=1).ravel()

    def model(self, theta: np.ndarray) -> LinearModel:
        full = theta.reshape(self.k, self.d + 1)
        return LinearModel(full[:, : self.d], full[:, self.d])

    def partials(self, theta: np.ndarray):
        model = self.model(theta)
        return _partial_gradients(model.W, model.b)


@dataclass(frozen=True)
class BatchSet:
    """A prepared training set: its rows, number of batches, and how many
    batches a folder holds (read back from the table itself)."""

    rows: DataFrame
    n_batches: int
    per_block: int
    path: str

    def part(self, ids: Sequence[int]) -> DataFrame:
        """The rows of some batches, reading their folders only."""
        blocks = sorted({i // self.per_block for i in ids})
        return self.rows.where(F.col("block").isin(blocks) & F.col("batch").isin(sorted(set(ids))))

    def delete(self) -> None:
        drop_path(self.rows.sparkSession, self.path)


_BATCH_META = "n_batches int, per_block int"


def prepare_batches(
    df: DataFrame,
    id_col: str,
    n_batches: int,
    seed: int | str = 0,
    path: str | None = None,
    max_dirs: int = 1024,
) -> BatchSet:
    """Assign repeatable hash batches and write the set once under the shared
    folder, in folders of neighbouring batches (at most ``max_dirs``) and
    sorted by ``batch`` inside each file, so a step reads one or two folders
    and skips row groups by their statistics. Rows are range-partitioned by
    ``(batch, hash of id)``: a batch larger than a task is split over several.
    The layout is stored beside the rows (:func:`open_batches`)."""
    spark = df.sparkSession
    out = path or scratch_path(spark, "batches")
    per_block = max(1, math.ceil(n_batches / max_dirs))
    spread = _free_name(df, "spread")
    prepared = (
        df.withColumn("batch", stable_bucket(id_col, n_batches, seed).cast("int"))
        .withColumn("block", (F.col("batch") / F.lit(per_block)).cast("int"))
        .withColumn(spread, F.xxhash64(id_col))
        .repartitionByRange("batch", spread)
        .sortWithinPartitions("batch")
        .drop(spread)
    )
    files.write_table(prepared, out + "/rows", partition_by=["block"])
    files.write_table(spark.createDataFrame([(n_batches, per_block)], _BATCH_META), out + "/layout")
    return open_batches(spark, out)


def open_batches(spark: SparkSession, path: str) -> BatchSet:
    """A set written by :func:`prepare_batches`, with the layout it was written in."""
    layout = spark.read.schema(_BATCH_META).parquet(path + "/layout").first()
    return BatchSet(spark.read.parquet(path + "/rows"), layout["n_batches"], layout["per_block"], path)


def _free_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def step_batches(step: int, replicas: int, n_batches: int) -> list[int]:
    return [(step * replicas + r) % n_batches for r in range(replicas)]


def step_limit(n_rows: int, batch_size: int, epochs: int) -> int:
    """The reference's stop rule: ``(n_rows // batch_size) · epochs`` global
    steps (a synchronous step consumes ``replicas`` batches)."""
    return (n_rows // batch_size) * epochs


def _step_gradient(batched: BatchSet, objective, theta: np.ndarray, ids: list[int], features: str, label: str):
    """Mean over the replicas of each batch's mean gradient, with the batches'
    metrics. Spark averages; one row a parameter and 3 more reach the driver,
    whatever the number of replicas. A batch without rows is an error."""
    part = batched.part(ids).select(F.col(features).cast("array<double>"), F.col(label).cast("int"), "batch")
    partial = part.mapInArrow(objective.partials(theta), "batch int, idx int, g double, n double")
    per_batch = partial.groupBy("batch", "idx").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
    rows = (
        per_batch.groupBy("idx")
        .agg(F.avg(F.col("g") / F.col("n")).alias("mean"), F.sum("g").alias("total"), F.count("*").alias("batches"))
        .toArrow()
    )
    idx, mean, total, batches = (rows.column(c).to_numpy() for c in ("idx", "mean", "total", "batches"))
    own = {i: int(np.flatnonzero(idx == i)[0]) for i in (_COUNT, _LOSS, _OK) if (idx == i).any()}
    if not own or batches[own[_COUNT]] != len(set(ids)):
        raise ValueError(f"of batches {sorted(set(ids))} only {batches[own[_COUNT]] if own else 0} have rows")
    grad = np.zeros(objective.size)
    grad[idx[idx >= 0]] = mean[idx >= 0]
    n = total[own[_COUNT]]
    return grad, {"loss": float(total[own[_LOSS]] / n), "accuracy": float(total[own[_OK]] / n), "examples": float(n)}


@dataclass
class _Optimizer:
    """Plain SGD or Adam on the parameters; keeps its moments and step count."""

    kind: str
    lr: float
    beta1: float = ADAM_BETA1
    beta2: float = ADAM_BETA2
    epsilon: float = ADAM_EPSILON
    steps: int = 0
    m: np.ndarray | float = 0.0
    v: np.ndarray | float = 0.0

    def update(self, theta: np.ndarray, g: np.ndarray) -> np.ndarray:
        self.steps += 1
        if self.kind == "sgd":
            return theta - self.lr * g
        if self.kind != "adam":
            raise ValueError(f"unknown optimizer {self.kind!r}")
        self.m = self.beta1 * self.m + (1 - self.beta1) * g
        self.v = self.beta2 * self.v + (1 - self.beta2) * g * g
        rate = self.lr * math.sqrt(1 - self.beta2**self.steps) / (1 - self.beta1**self.steps)
        return theta - rate * self.m / (np.sqrt(self.v) + self.epsilon)


def _run_steps(batched, objective, theta, optimizer, steps, replicas, features, label, after):
    """The given steps of one prepared set, numbered from its first one; calls
    ``after(step, theta, metrics)`` with the metrics of before the update.
    Returns the new parameters."""
    if replicas > batched.n_batches:
        raise ValueError(f"{replicas} replicas need as many batches; there are {batched.n_batches}")
    spark = batched.rows.sparkSession
    # The per-step aggregate is model-sized (replicas × (parameters + 3) rows
    # after map-side combine), so a few reducers suffice, and there is
    # nothing for adaptive execution to re-plan; both are scoped to the loop.
    reducers = max(1, min(spark.sparkContext.defaultParallelism, math.ceil(replicas * (objective.size + 3) / 50_000)))
    with scoped_conf(spark, "spark.sql.shuffle.partitions", str(reducers), spark__sql__adaptive__enabled="false"):
        for s in steps:
            g, metrics = _step_gradient(batched, objective, theta, step_batches(s, replicas, batched.n_batches), features, label)
            theta = optimizer.update(theta, g)
            after(s, theta, metrics)
    return theta


def sgd_sync(
    batched: BatchSet,
    k: int,
    d: int,
    steps: int,
    replicas: int = 1,
    lr: float = LEARNING_RATE,
    optimizer: str = "sgd",
    features: str = "features",
    label: str = "label",
    init: LinearModel | None = None,
    log_every: int = 0,
) -> tuple[LinearModel, list[tuple[int, str, float]]]:
    """Synchronous SGD (or Adam) for ``steps`` steps from ``init`` (zeros) on
    one prepared set, whose batches are visited in turn.

    Returns the model and metric rows ``(step, metric, value)`` logged every
    ``log_every`` steps, measured on the step's batches before its update.
    """
    objective = Softmax(k, d)
    theta = objective.flat(init) if init else objective.start()
    log: list[tuple[int, str, float]] = []

    def after(step, _, metrics):
        if log_every and step % log_every == 0:
            log.extend([(step, "loss", metrics["loss"]), (step, "accuracy", metrics["accuracy"])])

    theta = _run_steps(batched, objective, theta, _Optimizer(optimizer, lr), range(steps), replicas, features, label, after)
    return objective.model(theta), log


def train(
    df: DataFrame,
    id_col: str,
    objective,
    batch_size: int,
    epochs: int,
    replicas: int = 1,
    lr: float = LEARNING_RATE,
    optimizer: str = "sgd",
    epsilon: float = ADAM_EPSILON,
    seed: int | str = 0,
    n_batches: int | None = None,
    features: str = "features",
    label: str = "label",
    init=None,
    log_every: int = 0,
    metrics: MetricLog | None = None,
    checkpoints: Checkpoints | None = None,
    checkpoint_every: int | None = None,
    stop_after: int | None = None,
):
    """Whole synchronous training of an objective: :func:`step_limit` steps in
    ``epochs`` epochs, each on batches dealt anew from ``(seed, epoch)``. An
    epoch's prepared rows are deleted when it ends.

    With ``checkpoints`` the state is saved at the end of each epoch, or every
    ``checkpoint_every`` steps, and at the end; a run whose folder holds a
    complete checkpoint goes on from the newest one. A checkpoint of other data
    (by number of rows), settings or parameters is an error; more epochs than
    before are not. ``stop_after`` ends the run after so many steps in all.

    Returns the model and the metric rows ``(step, metric, value)`` of this
    call's steps, logged every ``log_every`` steps; with ``metrics`` each is also
    written as soon as its step is done, before the checkpoint that covers it.
    """
    n = df.count()
    limit = step_limit(n, batch_size, epochs)
    per_epoch = limit // epochs if epochs else 0
    batches = n_batches or max(1, math.ceil(n / batch_size))
    state = _Optimizer(optimizer, lr, epsilon=epsilon)
    theta, done = (objective.flat(init) if init else objective.start()), 0
    about = {
        "objective": repr(objective), "rows": n, "batch_size": batch_size, "n_batches": batches, "replicas": replicas,
        "seed": str(seed), "optimizer": [optimizer, lr, state.beta1, state.beta2, epsilon],
    }
    found = checkpoints.load() if checkpoints else None
    if found:
        done, arrays, saved = found
        if saved != about:
            differ = sorted(c for c in {*saved, *about} if saved.get(c) != about.get(c))
            raise ValueError(f"the checkpoint is of another run; it differs in {', '.join(differ)}")
        theta, state.steps = arrays["theta"], done
        state.m, state.v = arrays["m"], arrays["v"]
    log: list[tuple[int, str, float]] = []
    last = limit if stop_after is None else min(limit, stop_after)

    def save(step, theta):
        moments = {name: np.broadcast_to(getattr(state, name), theta.shape) for name in ("m", "v")}
        checkpoints.save(step, {"theta": theta, **moments}, about)

    while done < last:
        epoch = done // per_epoch
        first, end = epoch * per_epoch, min(last, (epoch + 1) * per_epoch)

        def after(s, theta, found, first=first):
            step = first + s
            if log_every and step % log_every == 0:
                values = {name: found[name] for name in ("loss", "accuracy")}
                log.extend((step, name, v) for name, v in values.items())
                if metrics:
                    metrics.write(step, values)
            finished = step + 1
            at_end = finished == limit or finished % per_epoch == 0
            if checkpoints and (at_end or checkpoint_every and finished % checkpoint_every == 0):
                save(finished, theta)

        batched = prepare_batches(df, id_col, batches, f"{seed}/{epoch}")
        try:
            steps = range(done - first, end - first)
            theta = _run_steps(batched, objective, theta, state, steps, replicas, features, label, after)
        finally:
            batched.delete()
        done = end
    return objective.model(theta), log


def train_sync(df: DataFrame, id_col: str, k: int, d: int, batch_size: int, epochs: int, **more) -> tuple[LinearModel, list[tuple[int, str, float]]]:
    """:func:`train` of a softmax regression of ``k`` classes on ``d`` features."""
    return train(df, id_col, Softmax(k, d), batch_size, epochs, **more)


def _local_sgd(start: np.ndarray, lr: float, max_steps: int | None):
    """mapInArrow body for shard-local SGD over ``(features, label, shard,
    batch)`` rows sorted by shard and batch: one update per completed
    mini-batch, whose gradient is summed as its rows arrive."""
    k, d = start.shape[0], start.shape[1] - 1

    def fn(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        theta = shard = batch = None
        steps, grad, count = 0, np.zeros_like(start), 0

        def finish():
            nonlocal theta, steps, grad, count
            if count and (max_steps is None or steps < max_steps):
                theta = theta - lr * grad / count
                steps += 1
            grad, count = np.zeros_like(start), 0

        def weights():
            c, j = np.meshgrid(np.arange(k), np.arange(d + 1), indexing="ij")
            columns = (np.full(c.size, shard), c.ravel(), np.where(j == d, BIAS, j).ravel())
            return pa.record_batch(
                [*[pa.array(x.astype(np.int32)) for x in columns], pa.array(theta.ravel())],
                names=["shard", "class", "feature", "weight"],
            )

        for part in it:
            if not part.num_rows:
                continue
            X, y = dense_rows(part.column(0), d), class_labels(part.column(1), k)
            shards, batches = (part.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            change = np.flatnonzero((shards[1:] != shards[:-1]) | (batches[1:] != batches[:-1])) + 1
            for a, z in zip([0, *change.tolist()], [*change.tolist(), len(y)]):
                if shards[a] != shard:
                    if shard is not None:
                        finish()
                        yield weights()
                    shard, batch, steps, theta = int(shards[a]), int(batches[a]), 0, start
                elif batches[a] != batch:
                    finish()
                    batch = int(batches[a])
                Xb = np.concatenate([X[a:z], np.ones((z - a, 1))], axis=1)
                P = _softmax_rows(Xb @ theta.T)
                P[np.arange(z - a), y[a:z]] -= 1.0
                grad += P.T @ Xb
                count += z - a
        if shard is not None:
            finish()
            yield weights()

    return fn


#: Default sizes from which shards and their batches are counted.
SHARD_ROWS = 1_000_000
BATCH_ROWS = 10_000


def sgd_averaged(
    df: DataFrame,
    id_col: str,
    k: int,
    d: int,
    n_shards: int | None = None,
    n_batches: int | None = None,
    lr: float = LEARNING_RATE,
    seed: int | str = 0,
    features: str = "features",
    label: str = "label",
    epochs: int = 1,
    init: LinearModel | None = None,
    max_steps: int | None = None,
) -> DataFrame:
    """Shard-local SGD with weight averaging → weight table ``(class, feature,
    weight)``. Shard ``= bucket(id, n_shards, seed)``; in epoch ``e`` the batch
    within the shard is ``bucket(id, n_batches, seed + e + 1)``, and a shard
    visits its batches in increasing order. After each epoch the weights are
    averaged and every shard starts the next one from them. Without given
    counts, shards have about ``SHARD_ROWS`` rows and batches ``BATCH_ROWS``.
    ``max_steps`` stops each shard after so many updates in all.

    A shard is one sequential pass in one task (that is the algorithm); a
    mini-batch's gradient is summed as it streams by, so nothing is buffered.
    """
    if n_shards is None or n_batches is None:
        n = df.count()
        n_shards = n_shards or max(1, math.ceil(n / SHARD_ROWS))
        n_batches = n_batches or max(1, math.ceil(n / n_shards / BATCH_ROWS))
    model = init or LinearModel.zeros(k, d)
    out = model.to_frame(df.sparkSession)
    for epoch in range(epochs):
        left = None if max_steps is None else max_steps - epoch * n_batches
        if left is not None and left <= 0:
            break
        if epoch:
            model = LinearModel.from_frame(out)  # model-sized
        theta = np.concatenate([model.W, model.b[:, None]], axis=1)
        shard = stable_bucket(id_col, n_shards, seed).cast("int")
        batch = stable_bucket(id_col, n_batches, f"{seed}+{epoch + 1}").cast("int")
        prepared = (
            df.select(
                F.col(features).cast("array<double>").alias("x"), F.col(label).cast("int").alias("y"),
                shard.alias("shard"), batch.alias("batch"),
            )
            .repartitionById(int(n_shards), F.col("shard"))  # a shard's id is its task
            .sortWithinPartitions("shard", "batch")
        )
        per_shard = prepared.mapInArrow(_local_sgd(theta, lr, left), "shard int, class int, feature int, weight double")
        out = per_shard.groupBy("class", "feature").agg(F.avg("weight").alias("weight"))
    return out


# -- model persistence -------------------------------------------------------


def save_weights(model: LinearModel, spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
    files.write_table(model.to_frame(spark), path, mode=mode)


def load_or_init(spark: SparkSession, path: str, k: int, d: int) -> LinearModel:
    """Restore a saved weight table if ``path`` exists, else zeros. A table of
    another shape than ``k x d``, and any failure other than a missing path,
    is an error."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return LinearModel.zeros(k, d)
    model = LinearModel.from_frame(spark.read.parquet(path))
    if (model.k, model.d) != (k, d):
        raise ValueError(f"{path} holds a {model.k} x {model.d} model; {k} x {d} was asked for")
    return model


def append_metrics(spark: SparkSession, rows: list[tuple[int, str, float]], path: str) -> DataFrame:
    """Append ``(step, metric, value)`` rows to a Parquet metric log."""
    df = spark.createDataFrame(rows, "step bigint, metric string, value double")
    files.write_table(df, path, mode="append")
    return spark.read.parquet(path)

