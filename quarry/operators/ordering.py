"""Total ordering, position columns and ordered heads.

``total_sort`` is the export-sort job: ascending on the given keys, string
keys compare by UTF-8 bytes (so ``'10' < '9'``), nulls first. Spark plans it
as a sampled range exchange plus a local sort, and the part files in order
form the total order. A per-row tie-break (the row's id within its input
split, unique and repeatable for the same input) lets the range partitioner
split a hot key — even one row repeated a third of the time — over many
tasks instead of one; ties have no defined order in the reference, so any
tie-break is correct.

``with_position`` numbers rows 1..N in a total order without the
single-task ``row_number()`` window: sort, count rows per sorted partition
(one tiny row per partition), turn the counts into prefix offsets and
broadcast them (size bounded by the partition count).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import persist

_ID_SHIFT = 33  # monotonically_increasing_id = partition << 33 | row-in-partition


def _cols(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def total_sort(df: DataFrame, keys: Sequence[str | Column], tie_break: bool = True) -> DataFrame:
    """Globally sorted frame (ascending, nulls first)."""
    order = [c.asc_nulls_first() for c in _cols(keys)]
    if not tie_break:
        return df.orderBy(*order)
    return df.withColumn("_tie", F.monotonically_increasing_id()).orderBy(*order, F.col("_tie")).drop("_tie")


def with_position(df: DataFrame, keys: Sequence[str | Column], name: str = "pos") -> DataFrame:
    """Add a 1-based ``name`` column numbering rows in ``keys`` order.

    The keys should give a total order; tied rows get consecutive positions
    in an unspecified order. Cost: one range shuffle plus a tiny aggregate.
    """
    order = [c.asc_nulls_first() for c in _cols(keys)]
    sorted_df = persist(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .orderBy(*order, F.col("_tie"))
        .drop("_tie")
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the window below runs on a table whose size is
    # the partition count, never the data size.
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias(
            "_off"
        ),
    )
    local_idx = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), _ID_SHIFT)
    return sorted_df.join(F.broadcast(offsets), "_pid").select(
        *df.columns, (F.col("_off") + local_idx + 1).cast("bigint").alias(name)
    )


def _neighbours(kind: pa.DataType):
    """mapInArrow body over ``(pid, value)`` of a sorted frame: every row with the
    next one of its partition, and one row with the partition's first and last
    value (``edge`` true), which meet their neighbours elsewhere."""
    names = ["edge", "pid", "a", "b"]

    def rows(edge, pid, a, b):
        n = len(a)
        return pa.record_batch([pa.array([edge] * n, pa.bool_()), pa.array([pid] * n, pa.int32()), a, b], names=names)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = pid = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(1).cast(kind)
            if first is None:
                first, pid = values[:1], batch.column(0)[0].as_py()
                before = values[:-1]
                after = values[1:]
            else:
                before, after = pa.concat_arrays([last, values[:-1]]), values
            last = values[-1:]
            yield rows(False, pid, before, after)
        if first is not None:
            yield rows(True, pid, first, last)

    return fn


def successor_pairs(
    df: DataFrame, keys: Sequence[str | Column], value: str, src: str = "src", dst: str = "dst"
) -> DataFrame:
    """``(value at position i, value at position i+1)`` in ``keys`` order:
    a scale-safe ``lead()`` over a global order. One sort; neighbours are paired
    as each sorted partition streams by, and the ends of the partitions, one row
    each, are paired after that."""
    order = [c.asc_nulls_first() for c in _cols(keys)]
    kind = to_arrow_type(df.schema[value].dataType)
    named = df.select(*_cols(keys), F.col(value).alias("_v"), F.monotonically_increasing_id().alias("_tie"))
    each = named.orderBy(*order, F.col("_tie")).select(F.spark_partition_id().alias("pid"), F.col("_v"))
    typ = df.schema[value].dataType.simpleString()
    found = persist(each.mapInArrow(_neighbours(kind), f"edge boolean, pid int, a {typ}, b {typ}"))
    # one row a partition, so its single-task window never grows with the data
    after = F.lead("a").over(Window.orderBy("pid"))
    ends = found.where("edge").select("pid", F.col("b").alias("from"), after.alias("to"), F.lead("pid").over(Window.orderBy("pid")).alias("next"))
    return found.where("NOT edge").select(F.col("a").alias(src), F.col("b").alias(dst)).unionByName(
        ends.where("next IS NOT NULL").select(F.col("from").alias(src), F.col("to").alias(dst))
    )


def head(df: DataFrame, keys: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows in ``keys`` order (top-k per partition, then merge)."""
    order = [c.asc_nulls_first() for c in _cols(keys)]
    return df.orderBy(*order).limit(n)
