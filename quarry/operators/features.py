"""Labelled-example preparation: split, size, scale, encode, reshape.

Input is a labelled table ``(id, features array<float>, label int)``. The
train/test split is a repeatable MD5 bucket of the id (``randomSplit``
depends on partitioning, so it is not repeatable across cluster shapes).
All steps are narrow projections except ``split_counts`` (one tiny
aggregate with map-side combine).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays
from ..functions.keys import stable_percent


def train_test_split(df: DataFrame, id_col: str = "id", test_pct: int = 20, seed: int | str = 0) -> DataFrame:
    """Add ``split`` = ``'test'`` for ``test_pct`` % of ids, else ``'train'``."""
    is_test = stable_percent(id_col, seed) < F.lit(int(test_pct))
    return df.withColumn("split", F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def split_counts(df: DataFrame, batch_size: int = 128) -> DataFrame:
    """``(split, n, n_batches = floor(n / batch_size))``."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n")).select(
        "split", "n", F.floor(F.col("n") / F.lit(int(batch_size))).cast("bigint").alias("n_batches")
    )


def scale_features(df: DataFrame, col: str = "features", divisor: float = 255.0) -> DataFrame:
    return df.withColumn(col, arrays.scale(col, divisor))


def one_hot_labels(df: DataFrame, k: int = 10, label: str = "label", out: str = "label_onehot") -> DataFrame:
    return df.withColumn(out, arrays.one_hot(label, k))


def reshape_grid(df: DataFrame, rows: int, width: int, col: str = "features", out: str = "grid") -> DataFrame:
    return df.withColumn(out, arrays.reshape(col, rows, width))


def flatten_grid(df: DataFrame, col: str = "grid", out: str = "features") -> DataFrame:
    return df.withColumn(out, arrays.flatten_grid(col))


def unstack_steps(df: DataFrame, grid: str = "grid", id_col: str = "id") -> DataFrame:
    """Sequence → one row per time step ``(id, step, vec)``."""
    return df.select(id_col, F.posexplode(grid).alias("step", "vec"))


def last_step(df: DataFrame, grid: str = "grid", out: str = "last") -> DataFrame:
    return df.withColumn(out, arrays.last_step(grid))


def argmax_class(df: DataFrame, col: str, out: str = "cls") -> DataFrame:
    return df.withColumn(out, arrays.argmax(col))


def long_form(df: DataFrame, id_col: str, col: str, index: str = "i", value: str = "v") -> DataFrame:
    """Array column → one row per element ``(id, index, value)``."""
    return df.select(id_col, F.posexplode(col).alias(index, value))
