"""Scoring and evaluation of a linear (softmax) classifier, or of any model
that gives ``logits`` for a matrix of feature rows.

A linear model is a small weight table ``(class int, feature int, weight double)``
with ``feature = -1`` for the bias. It is read once (model-sized, a few
thousand rows at most) and shipped with the task closure. Scoring is a
narrow per-partition step (one BLAS product per Arrow batch) and every
metric is one global aggregate with partial aggregation per partition.

Losses use log-sum-exp: ``loss = lse(z) − z[label]``. This has no
``log(0)`` point, where Spark would return NULL and ``avg`` would silently
drop the row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import arrays

BIAS = -1


class LinearModel:
    """Weights ``W[c][j]`` and bias ``b[c]`` of a k-class linear model."""

    def __init__(self, W: np.ndarray, b: np.ndarray):
        self.W = np.asarray(W, dtype=np.float64)
        self.b = np.asarray(b, dtype=np.float64)

    @property
    def k(self) -> int:
        return self.W.shape[0]

    @property
    def d(self) -> int:
        return self.W.shape[1]

    def logits(self, X: np.ndarray) -> np.ndarray:
        """Scores of feature rows, before the softmax."""
        return X @ self.W.T + self.b

    @classmethod
    def zeros(cls, k: int, d: int) -> LinearModel:
        return cls(np.zeros((k, d)), np.zeros(k))

    @classmethod
    def from_rule(cls, k: int, d: int, rule) -> LinearModel:
        """Weights from ``rule(c, j)``; ``j = -1`` gives the bias."""
        W = np.array([[rule(c, j) for j in range(d)] for c in range(k)], dtype=np.float64)
        b = np.array([rule(c, BIAS) for c in range(k)], dtype=np.float64)
        return cls(W, b)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c, j, float(self.W[c, j])) for c in range(self.k) for j in range(self.d)]
        rows += [(c, BIAS, float(self.b[c])) for c in range(self.k)]
        return spark.createDataFrame(rows, "class int, feature int, weight double")

    @classmethod
    def from_frame(cls, weights: DataFrame) -> LinearModel:
        """Read a weight table (model-sized) into driver arrays."""
        rows = weights.select("class", "feature", "weight").collect()
        k = 1 + max(r["class"] for r in rows)
        d = 1 + max(r["feature"] for r in rows)
        W = np.zeros((k, d))
        b = np.zeros(k)
        for r in rows:
            if r["feature"] == BIAS:
                b[r["class"]] = r["weight"]
            else:
                W[r["class"], r["feature"]] = r["weight"]
        return cls(W, b)


def _arrow_scores(
    df: DataFrame, model: LinearModel, features: str, label: str | None, outputs: dict, drop_features: bool = False
):
    """Append per-row model outputs computed with numpy on Arrow batches.

    Dense scoring is matrix work: one BLAS product per Arrow batch beats a
    per-row higher-order function by several times (measured 6.6x on 400k
    rows x 64 features). ``outputs`` maps new column name → kind, kind in
    ``z`` (scores), ``p`` (probabilities), ``pred`` (argmax, first on ties),
    ``loss`` (lse − z[label]) and ``ok`` (pred == label as int). With
    ``drop_features`` the feature arrays are not sent back to the JVM.
    """
    kinds = dict(outputs)
    types = {"z": T.ArrayType(T.DoubleType()), "p": T.ArrayType(T.DoubleType()), "pred": T.IntegerType(),
             "loss": T.DoubleType(), "ok": T.IntegerType()}
    kept = [f for f in df.schema.fields if not (drop_features and f.name == features)]
    schema = T.StructType(kept + [T.StructField(n, types[k]) for n, k in kinds.items()])

    def fn(it):
        for pdf in it:
            if pdf.empty:
                for n in kinds:
                    pdf[n] = []
                yield pdf.drop(columns=[features]) if drop_features else pdf
                continue
            X = np.stack(pdf[features].to_numpy()).astype(np.float64)
            Z = model.logits(X)
            m = Z.max(axis=1, keepdims=True)
            E = np.exp(Z - m)
            s = E.sum(axis=1, keepdims=True)
            for n, k in kinds.items():
                if k == "z":
                    pdf[n] = list(Z)
                elif k == "p":
                    pdf[n] = list(E / s)
                elif k == "pred":
                    pdf[n] = Z.argmax(axis=1).astype(np.int32)
                elif k == "loss":
                    y = _checked_labels(pdf[label], Z.shape[1])
                    pdf[n] = (m[:, 0] + np.log(s[:, 0])) - Z[np.arange(len(y)), y]
                elif k == "ok":
                    y = pdf[label].to_numpy().astype(np.int64)
                    pdf[n] = (Z.argmax(axis=1) == y).astype(np.int32)
            yield pdf.drop(columns=[features]) if drop_features else pdf

    return df.mapInPandas(fn, schema)


def _checked_labels(labels, k: int) -> np.ndarray:
    """Integer labels of a loss; one that is missing or not in ``0..k-1`` is an error."""
    if labels.isna().any():
        raise ValueError("a label is missing")
    y = labels.to_numpy().astype(np.int64)
    if len(y) and not (0 <= y.min() and y.max() < k):
        raise ValueError(f"labels must be in 0..{k - 1}; found {y.min()}..{y.max()}")
    return y


def with_scores(df: DataFrame, model: LinearModel, features: str = "features", out: str = "z") -> DataFrame:
    """Add class scores ``z = x·W + b`` (array of k doubles)."""
    return _arrow_scores(df, model, features, None, {out: "z"})


def with_probabilities(df: DataFrame, model: LinearModel, features: str = "features", out: str = "p") -> DataFrame:
    """Add class probabilities (max-shifted softmax)."""
    return _arrow_scores(df, model, features, None, {out: "p"})


def batch_score(
    df: DataFrame, model: LinearModel, features: str = "features", out: str = "pred", drop_features: bool = False
) -> DataFrame:
    """Scaled row → predicted class (argmax, lowest class on ties)."""
    return _arrow_scores(df, model, features, None, {out: "pred"}, drop_features)


def _row_losses(df: DataFrame, model: LinearModel, features: str, label: str, onehot: str | None, keep=()):
    """Per-row ``_loss`` and ``_ok``. The integer-label form computes the loss
    in numpy; the one-hot form evaluates ``lse(z) − Σ y·z`` on the score
    array with built-in functions."""
    if onehot is None:
        slim = df.select(features, label, *keep)
        return _arrow_scores(slim, model, features, label, {"_loss": "loss", "_ok": "ok"}, drop_features=True)
    slim = df.select(features, label, onehot, *keep)
    scored = _arrow_scores(slim, model, features, label, {"_z": "z", "_ok": "ok"}, drop_features=True)
    yz = F.aggregate(
        F.zip_with(F.col(onehot), F.col("_z"), lambda y, zz: y * zz), F.lit(0.0).cast("double"),
        lambda acc, v: acc + v,
    )
    return scored.select("*", (arrays.logsumexp("_z") - yz).alias("_loss"))


def cross_entropy(
    df: DataFrame, model: LinearModel, features: str = "features", label: str = "label", onehot: str | None = None
) -> DataFrame:
    """Mean cross-entropy over all rows: one row ``(loss, n)``."""
    r = _row_losses(df, model, features, label, onehot)
    return r.agg(F.avg("_loss").alias("loss"), F.count(F.lit(1)).alias("n"))


def accuracy_counts(df: DataFrame, model: LinearModel, features: str = "features", label: str = "label") -> DataFrame:
    """``(correct, total, accuracy)`` in one global aggregate."""
    r = _row_losses(df, model, features, label, None)
    return r.agg(
        F.sum("_ok").cast("bigint").alias("correct"),
        F.count(F.lit(1)).alias("total"),
    ).select("correct", "total", (F.col("correct") / F.col("total")).alias("accuracy"))


def evaluate_model(
    df: DataFrame,
    model: LinearModel,
    features: str = "features",
    label: str = "label",
    by: Sequence[str] = ("split",),
) -> DataFrame:
    """Loss and accuracy per group (default per split)."""
    r = _row_losses(df, model, features, label, None, keep=tuple(by))
    return r.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("_loss").alias("loss"),
        F.avg(F.col("_ok").cast("double")).alias("accuracy"),
    )
