"""Array-column expressions for labelled examples (all JVM-side).

Feature vectors are ``array<float|double>`` columns. Everything here is a
higher-order function over one row, so it runs inside whole-stage codegen
with no Python worker. Model parameters (a few thousand doubles at most)
enter as literal arrays: their size is fixed by the model, not the data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def scale(features: Column | str, divisor: float = 255.0) -> Column:
    """Element-wise ``x / divisor`` in double precision (pixel → [0, 1])."""
    return F.transform(_c(features), lambda x: x.cast("double") / F.lit(float(divisor)))


def as_double(features: Column | str) -> Column:
    return F.transform(_c(features), lambda x: x.cast("double"))


def one_hot(label: Column | str, k: int) -> Column:
    """Integer label → length-``k`` double vector with a single 1.0."""
    lab = _c(label)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda c: (c == lab).cast("double"))


def reshape(features: Column | str, rows: int, width: int) -> Column:
    """Flat row-major vector → ``rows × width`` grid (array of arrays)."""
    a = _c(features)
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.slice(a, i * width + 1, width))


def flatten_grid(grid: Column | str) -> Column:
    return F.flatten(_c(grid))


def last_step(grid: Column | str) -> Column:
    """``outputs[-1]``: the last time step of a sequence."""
    return F.element_at(_c(grid), -1)


def array_sum(a: Column | str) -> Column:
    return F.aggregate(_c(a), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def argmax(a: Column | str) -> Column:
    """0-based index of the largest element, first index on ties."""
    arr = _c(a)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def logsumexp(z: Column | str) -> Column:
    """``log Σ exp z`` computed as ``m + log Σ exp(z − m)`` (no overflow,
    no ``log(0)``). The max enters the lambda as an array argument, so it is
    evaluated once per row, not once per element."""
    arr = _c(z)
    m = F.array_max(arr)
    shifted = F.zip_with(arr, F.array_repeat(m, F.size(arr)), lambda x, mm: F.exp(x - mm))
    return m + F.log(F.aggregate(shifted, F.lit(0.0).cast("double"), lambda acc, x: acc + x))
