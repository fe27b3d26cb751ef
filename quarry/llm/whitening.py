"""Whitening of embeddings by the polarisation identity.

Entries become whole numbers, ``x = floor(scale * c) + offset``, so that every
sum is exact. The *fit list* holds each distinct vector of them once: copies of
a vector, be they a third of all rows, are merged before the shuffle and weigh
as one.

Covariances come from variances alone. With ``d = x - floor(mean)`` each task adds
up ``(2 d_i)**2`` for every dimension and ``(d_i + d_j)**2`` for every pair of
dimensions; the fraction of the mean that the whole number leaves is put right
in exact integers on the driver, which gives the numerators

    n**2 var(i)     = n * sum(d_i**2) - r_i**2
    n**2 var(i + j) = n * sum((d_i + d_j)**2) - (r_i + r_j)**2,   r = sum(d)

and ``cov(i, j) = (var(i + j) - var(i) - var(j)) / 2``. The matrix goes to
``eigh``; the driver only ever holds one number per pair of dimensions.

Defined cases: a row whose vector is null or holds a null or non-finite entry is
left out; any other row stays, repeated rows and rows without id included. No
rows, or a single distinct vector, leave no component, so no component rows.
Components whose eigenvalue is nil (to double precision) can't be whitened and
are not returned. Vectors of different lengths, and entries beyond ``ENTRY_LIMIT``,
are errors. A deviation beyond a 64-bit integer is null. A taken default column
name is lengthened by underscores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import written
from .texts import free_name

#: Fixed values of the whole-number form.
SCALE = 64
OFFSET = 1_000_000
#: Entries of the whole-number form have at most this size; larger ones are an error.
ENTRY_LIMIT = 1 << 40
#: Components returned.
COMPONENTS = 16
#: Rows whose pair sums are formed at once inside a task.
RUN_ROWS = 1024


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def whole_numbers(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """``floor(scale * c) + offset`` of every entry; entries far beyond the limit stop just past it."""
    far = float(4 * ENTRY_LIMIT)
    one = lambda c: F.floor(F.least(F.greatest(c.cast("double") * scale, F.lit(-far)), F.lit(far)))
    return F.transform(vector, lambda c: (one(c) + offset).cast("bigint"))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """An Arrow list column of ``d`` long entries a row as an ``n x d`` matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


def _exact_sums(per_batch, width: int):
    """mapInArrow body: adds ``per_batch(matrix)`` up as Python integers, one row an entry at the end of the task."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = per_batch(batch.column(0)).astype(object)
                total = found if total is None else total + found
        if total is not None:
            values = pa.array([int(v) for v in total], pa.decimal128(38, 0))
            yield pa.record_batch([pa.array(np.arange(width, dtype=np.int32)), values], names=["i", "s"])

    return fn


def _collected_sums(fit: DataFrame, per_batch, width: int) -> list[int]:
    rows = fit.mapInArrow(_exact_sums(per_batch, width), "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    found = {r["i"]: int(r["s"]) for r in rows}
    return [found[i] for i in range(width)]


def _pair_squares(base: np.ndarray, d: int, span: int):
    """Sums of ``(d_i + d_j)**2`` over the rows of a batch, for ``i <= j``, row-wise."""
    safe = (2 * span) ** 2 * RUN_ROWS < 1 << 62

    def per_batch(column):
        D = matrix(column, d) - base
        total = np.zeros(d * (d + 1) // 2, object)
        for at in range(0, len(D), RUN_ROWS):
            part = D[at : at + RUN_ROWS] if safe else D[at : at + RUN_ROWS].astype(object)
            sums = []
            for i in range(d):
                both = part[:, i : i + 1] + part[:, i:]
                sums.append((both * both).sum(axis=0))
            total = total + np.concatenate(sums).astype(object)
        return total

    return per_batch


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: the fit list's size and sums, and the components' directions."""

    n: int
    base: tuple[int, ...]       # whole part of the mean of each dimension
    rest: tuple[int, ...]       # sum of x - base over the fit list
    directions: np.ndarray      # d x components, unit columns
    eigenvalues: np.ndarray     # of the components
    explained: np.ndarray       # their shares of the trace
    identity_error: float       # largest entry of whitened's covariance over the fit list, less the identity

    @property
    def components(self) -> int:
        return len(self.eigenvalues)

    def project(self, X: np.ndarray) -> np.ndarray:
        """Whitened coordinates of whole-number rows."""
        centred = (X - np.array(self.base)) - np.array(self.rest, np.float64) / max(self.n, 1)
        return centred @ self.directions / np.sqrt(self.eigenvalues)

    def deviations(self, X: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of ``(n x - S)**2`` of each row, exact; None beyond 64 bits."""
        D = X - np.array(self.base)
        span = max(int(np.abs(D).max(initial=0)), 1)
        wide = span * max(span, self.n) * len(self.base) >= 1 << 62
        D, rest = (D.astype(object), np.array(self.rest, object)) if wide else (D, np.array(self.rest))
        squares, cross = (D * D).sum(axis=1).tolist(), (D @ rest).tolist()
        own = sum(r * r for r in self.rest)
        values = [self.n * self.n * a - 2 * self.n * b + own for a, b in zip(squares, cross)]
        return [v if v < 1 << 63 else None for v in values]

    def transform(self, rows: DataFrame, vector_col: str = "embedding", out: str = "whitened", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
        """Rows with a usable vector, with ``out`` (array of doubles, one a component) and ``deviation``."""
        d, model = len(self.base), self
        rows = rows.where(usable(F.col(vector_col)))
        out = free_name(rows, out)
        deviation = free_name(rows.withColumn(out, F.lit(0)), "deviation")

        @F.arrow_udf("struct<deviation bigint, whitened array<double>>")
        def apply(x: pa.Array) -> pa.Array:
            X = matrix(x, d) if d else np.zeros((len(x), 0), np.int64)
            Z = model.project(X)
            ends = pa.array(np.arange(len(X) + 1, dtype=np.int32) * model.components)
            return pa.StructArray.from_arrays(
                [pa.array(model.deviations(X), pa.int64()), pa.ListArray.from_arrays(ends, pa.array(Z.ravel()))], ["deviation", "whitened"]
            )

        both = free_name(rows, "both")
        done = rows.withColumn(both, apply(whole_numbers(F.col(vector_col), scale, offset)))
        return done.select(*[F.col(f"`{c}`") for c in rows.columns], F.col(f"{both}.deviation").alias(deviation), F.col(f"{both}.whitened").alias(out))


def _covariance(n: int, rest: list[int], squares: list[int], d: int) -> np.ndarray:
    """The covariance matrix from the sums over pairs; every division is of exact integers."""
    numerator, at = {}, 0
    for i in range(d):
        for j in range(i, d):
            numerator[i, j] = n * squares[at] - (rest[i] + rest[j]) ** 2
            at += 1
    variance = [numerator[i, i] // 4 for i in range(d)]  # of 2 d_i
    V = np.zeros((d, d))
    for (i, j), both in numerator.items():
        V[i, j] = V[j, i] = variance[i] / n**2 if i == j else (both - variance[i] - variance[j]) / (2 * n**2)
    return V


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity."""
    c, d = model.components, len(model.base)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(c * c + c)
        for batch in batches:
            Z = model.project(matrix(batch.column(0), d))
            total += np.concatenate([(Z.T @ Z).ravel(), Z.sum(axis=0)])
        yield pa.record_batch([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "s"])

    rows = fit.mapInArrow(fn, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    total = np.array([r["s"] for r in sorted(rows, key=lambda r: r["i"])]) / model.n
    mean = total[c * c :]
    return float(np.abs(total[: c * c].reshape(c, c) - np.outer(mean, mean) - np.eye(c)).max())


def fit_whitening(rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Whitening:
    """Fit on the distinct usable vectors of ``rows``. Three passes over the
    fit list, which is written once: sums, pair sums, check of the identity."""
    x = whole_numbers(F.col(vector_col), scale, offset).alias("x")
    fit = written(rows.where(usable(F.col(vector_col))).select(x).distinct(), "whitening_fit")
    about = fit.agg(
        F.count("*").alias("n"), F.min(F.size("x")).alias("short"), F.max(F.size("x")).alias("d"),
        F.min(F.array_min("x")).alias("low"), F.max(F.array_max("x")).alias("high"),
    ).first()
    n, d = about["n"], about["d"] or 0
    if n and about["short"] != d:
        raise ValueError(f"vectors have {about['short']} to {d} entries")
    if d and max(-about["low"], about["high"]) > ENTRY_LIMIT:
        raise ValueError(f"entries {about['low']}..{about['high']} go beyond {ENTRY_LIMIT}")
    empty = np.zeros(0)
    if not n or not d:
        return Whitening(n, (), (), np.zeros((0, 0)), empty, empty, 0.0)
    sums = _collected_sums(fit, lambda column: matrix(column, d).sum(axis=0), d)
    base = [s // n for s in sums]
    rest = [s - n * b for s, b in zip(sums, base)]
    span = max(about["high"] - about["low"], 1)
    squares = _collected_sums(fit, _pair_squares(np.array(base), d, span), d * (d + 1) // 2)
    V = _covariance(n, rest, squares, d)
    values, vectors = np.linalg.eigh(V)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > d * np.finfo(np.float64).eps * max(values.max(), 0.0)]
    directions = vectors[:, order]
    largest = np.abs(directions).argmax(axis=0)
    directions = directions * np.sign(directions[largest, np.arange(len(order))])  # one sign for all rows
    model = Whitening(n, tuple(base), tuple(rest), directions, values[order], values[order] / np.trace(V) if len(order) else empty, 0.0)
    if not model.components:
        return model
    return Whitening(n, model.base, model.rest, directions, model.eigenvalues, model.explained, _identity_error(fit, model))


def whitening_digest(rows: DataFrame) -> DataFrame:
    """One row per remaining row and component: see :mod:`quarry.llm.whitening`."""
    rows = rows.select("vec_id", "embedding")
    model = fit_whitening(rows)
    explained = F.array(*[F.lit(float(e)) for e in model.explained]) if model.components else F.array().cast("array<double>")
    each = model.transform(rows).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )
