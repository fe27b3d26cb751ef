"""Shuffle, repeat, batch and shard labelled examples.

* Shuffle: a full, repeatable shuffle keyed by ``md5(seed ‖ epoch ‖ id)``
  (stronger than a bounded shuffle buffer, and the same on any cluster).
* Two-level shuffle: rows belong to blocks by a hash of their id; an epoch permutes
  the blocks, and the rows within each. One hash exchange and a sort within the
  blocks; a row's place is the count of the rows in the blocks before its own plus
  its place in the block. No range exchange and nothing kept between epochs; rows
  of one block stay neighbours in every epoch.
* Shuffle buffer: rows stream through a bounded buffer in each task and leave it in
  random order, with no exchange at all: the reference's own input pipeline.
* Repeat: one copy per epoch through ``explode(sequence(...))`` — a row
  expansion, not a join; epochs are never physically materialised.
* Batch: either a hash bucket (near-equal sizes, no ordering pass; the
  default at scale) or exact fixed-size batches from a scale-safe position
  column (one range shuffle + a tiny per-partition count).
* Shard: a visible ``shard`` column plus ``repartition`` on it, so each
  worker task sees its slice; evaluation uses the unsharded frame.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import stable_bucket, stable_key
from .ordering import with_position


def shuffle_key(id_col: str, epoch: Column | int = 0, seed: int | str = 0) -> Column:
    ep = epoch if isinstance(epoch, Column) else F.lit(int(epoch))
    return stable_key(F.concat(ep.cast("string"), F.lit(":"), F.col(id_col).cast("string")), seed)


def shuffle_epoch(df: DataFrame, id_col: str, epoch: int = 0, seed: int | str = 0) -> DataFrame:
    """Add ``pos`` (1..N): the example's place in the epoch's shuffled order
    (ties on the key broken by id)."""
    keyed = df.withColumn("_k", shuffle_key(id_col, epoch, seed))
    return with_position(keyed, ["_k", id_col]).drop("_k")


#: Rows of a block of the two-level shuffle: what one task sorts.
ROWS_PER_BLOCK = 1_000_000
#: Rows of the shuffle buffer (fixed value of the reference's input pipeline).
BUFFER_ROWS = 10_000


def _own_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def shuffle_blocks(
    df: DataFrame, id_col: str, epoch: int = 0, seed: int | str = 0, n_blocks: int | None = None, name: str = "pos"
) -> DataFrame:
    """Add ``name`` (1..N): the example's place in the epoch's two-level order.

    ``id_col`` should be near-unique, so that blocks are of one size; rows that
    share an id get neighbouring places in no defined order. Without ``n_blocks``
    the rows are counted and blocks hold about ``ROWS_PER_BLOCK``.
    """
    blocks = n_blocks or max(1, math.ceil(df.count() / ROWS_PER_BLOCK))
    block, key = _own_name(df, "block"), _own_name(df, "key")
    dealt = df.withColumn(block, stable_bucket(id_col, blocks, f"{seed}/block"))
    # one row a block: the single-task window below never grows with the rows
    sizes = dealt.groupBy(block).agg(F.count("*").alias("rows"))
    in_order = Window.orderBy(stable_key(block, f"{seed}/block/{epoch}"), block)
    before = sizes.select(block, (F.sum("rows").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")).alias(key))
    within = Window.partitionBy(block).orderBy(shuffle_key(id_col, epoch, seed), id_col)
    placed = dealt.join(F.broadcast(before), block).withColumn(name, (F.col(key) + F.row_number().over(within)).cast("bigint"))
    return placed.select(*df.columns, name)


def _through_buffer(size: int, seed: int, epoch: int):
    """mapInArrow body: rows leave a buffer of ``size`` rows in random order, the
    same for the same seed, epoch and split. Each new row takes the place of a
    random one, which leaves; at the end the rows left go in random order."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, epoch, TaskContext.get().partitionId()])
        held: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            if held is None or held.num_rows < size:
                room = size - (held.num_rows if held else 0)
                held = new[:room] if held is None else pa.concat_tables([held, new[:room]])
                new = new[room:]
            if new.num_rows:
                slots = rng.integers(0, size, new.num_rows)
                # a row that leaves is the one put last into its slot
                order = np.argsort(slots, kind="stable")
                same = np.concatenate([[False], slots[order][1:] == slots[order][:-1]])
                leaves = slots.copy()
                leaves[order[same]] = size + order[np.flatnonzero(same) - 1]
                stays = np.arange(size)
                stays[slots] = size + np.arange(new.num_rows)  # the last one put in wins
                both = pa.concat_tables([held, new]).combine_chunks()
                yield from both.take(leaves).to_batches()
                held = both.take(stays)
        if held is not None and held.num_rows:
            yield from held.combine_chunks().take(rng.permutation(held.num_rows)).to_batches()

    return fn


def shuffle_buffer(df: DataFrame, size: int = BUFFER_ROWS, seed: int = 0, epoch: int = 0) -> DataFrame:
    """Each split's rows in the order in which they leave a bounded shuffle buffer.

    Nothing is exchanged and a task never holds more than the buffer and one Arrow
    batch. The order is repeatable for the same input splits, seed and epoch; a row
    leaves at most ``size - 1`` places before its own, so a buffer smaller than a
    split mixes near rows only, as the reference's does.
    """
    if size < 1:
        raise ValueError("the buffer needs a row")
    return df.mapInArrow(_through_buffer(size, seed, epoch), df.schema)


def batches_of(df: DataFrame, position: str, batch_size: int, name: str = "batch") -> DataFrame:
    """Add ``name`` (bigint): exact batches by a 1-based place; the last may be partial."""
    return df.withColumn(name, F.expr(f"(`{position}` - 1) div {int(batch_size)}").cast("bigint"))


def repeat_epochs(df: DataFrame, epochs: int) -> DataFrame:
    """Dataset × ``epochs`` with an ``epoch`` column (0-based)."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(int(epochs) - 1))))


def n_batches(n_rows: int, batch_size: int) -> int:
    return max(1, math.ceil(n_rows / batch_size))


def assign_batches(
    df: DataFrame, id_col: str, batch_size: int, seed: int | str = 0, n_rows: int | None = None
) -> DataFrame:
    """Hash-bucket batches: ``ceil(n / batch_size)`` buckets, expected size
    ``batch_size``. ``n_rows`` may be passed to skip the count job."""
    n = df.count() if n_rows is None else n_rows
    nb = n_batches(n, batch_size)
    return df.withColumn("batch", stable_bucket(id_col, nb, seed).cast("int"))


def assign_batches_exact(df: DataFrame, id_col: str, batch_size: int, epoch: int = 0, seed: int | str = 0) -> DataFrame:
    """Exact batches of ``batch_size`` in the epoch's shuffled order; the
    last batch may be partial."""
    pos = shuffle_epoch(df, id_col, epoch, seed)
    return pos.withColumn("batch", F.floor((F.col("pos") - 1) / F.lit(int(batch_size))).cast("int"))


def shard_by_key(df: DataFrame, key: str, n_shards: int, seed: int | str = 0, colocate: bool = False) -> DataFrame:
    """Add ``shard`` in ``[0, n_shards)``.

    By default the shard is a logical slice: a worker reads its shard with
    a filter and Spark still spreads it over many tasks. ``colocate=True``
    hash-partitions on ``shard``, which puts each shard's rows in one task;
    use it only for per-shard sequential algorithms, with ``n_shards`` large
    enough that a shard is task-sized. The key should be near-unique (an
    example id), so shards are balanced.
    """
    out = df.withColumn("shard", stable_bucket(key, n_shards, seed).cast("int"))
    return out.repartition("shard") if colocate else out
