"""Converged classifiers from ``pyspark.ml`` (distributed L-BFGS / tree
aggregation inside MLlib): softmax regression and a feed-forward network
with the reference's dense head (120 → 84 → k). MLlib's hidden units are
sigmoid, not ReLU; results are checked by
:func:`class_mass` and :func:`beats_prior`, not bit-equality.

Both train on the ``train`` split and score every row, adding ``pred``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _vectors(df: DataFrame, features: str) -> DataFrame:
    return df.withColumn("_vec", array_to_vector(F.col(features)))


def softmax_regression(
    df: DataFrame, features: str = "features", label: str = "label", max_iter: int = 100, reg: float = 0.0,
    tol: float = 1e-6, keep_probability: bool = False,
) -> DataFrame:
    data = _vectors(df, features)
    est = LogisticRegression(
        featuresCol="_vec", labelCol=label, family="multinomial", regParam=reg, maxIter=max_iter, tol=tol,
        predictionCol="_pred",
    )
    model = est.fit(data.where(F.col("split") == "train"))
    out = model.transform(data).withColumn("pred", F.col("_pred").cast("int"))
    if keep_probability:
        out = out.withColumn("p", vector_to_array("probability"))
    return out.drop("_vec", "_pred", "rawPrediction", "probability")


def class_mass(scored: DataFrame) -> DataFrame:
    """``(class, mass)``: the probabilities ``p`` of each class, summed over the rows."""
    each = scored.select(F.posexplode("p").alias("class", "p"))
    return each.groupBy("class").agg(F.sum("p").alias("mass"))


def beats_prior(scored: DataFrame, label: str = "label") -> DataFrame:
    """``(split, n, beats_prior)``: whether ``pred`` is right more often than the most frequent label is met."""
    each = scored.groupBy("split", label).agg(
        F.count("*").alias("n"), F.sum((F.col("pred") == F.col(label)).cast("bigint")).alias("right")
    )
    return each.groupBy("split").agg(F.sum("n").alias("n"), (F.sum("right") > F.max("n")).alias("beats_prior"))


def mlp_classifier(
    df: DataFrame,
    hidden: Sequence[int] = (120, 84),
    k: int = 10,
    features: str = "features",
    label: str = "label",
    max_iter: int = 100,
    seed: int = 1,
) -> DataFrame:
    data = _vectors(df, features)
    d = len(df.select(features).first()[0])
    est = MultilayerPerceptronClassifier(
        featuresCol="_vec", labelCol=label, layers=[d, *hidden, k], maxIter=max_iter, seed=seed,
        predictionCol="_pred",
    )
    model = est.fit(data.where(F.col("split") == "train"))
    out = model.transform(data)
    return out.withColumn("pred", F.col("_pred").cast("int")).drop("_vec", "_pred", "rawPrediction", "probability")
