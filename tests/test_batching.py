"""Shuffles that need no global sort."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import batching
from quarry.session import scoped_conf
from tests.test_plans import _node_names


def test_two_level_order_is_a_permutation_and_repeatable(spark):
    df = spark.range(0, 5000, 1, 7).withColumn("block", F.lit("mine")).withColumn("key", F.lit(1))
    one = {r["id"]: r["pos"] for r in batching.shuffle_blocks(df, "id", epoch=1, n_blocks=9).collect()}
    assert sorted(one.values()) == list(range(1, 5001))
    again = {r["id"]: r["pos"] for r in batching.shuffle_blocks(df.repartition(3), "id", epoch=1, n_blocks=9).collect()}
    assert again == one
    other = {r["id"]: r["pos"] for r in batching.shuffle_blocks(df, "id", epoch=2, n_blocks=9).collect()}
    assert sum(other[i] == one[i] for i in one) < 50
    out = batching.shuffle_blocks(df, "id")  # counted; one block
    assert out.columns == ["id", "block", "key", "pos"] and out.where("block = 'mine'").agg(F.max("pos")).first()[0] == 5000
    assert batching.shuffle_blocks(spark.range(0), "id").count() == 0
    batches = batching.batches_of(out, "pos", 64).groupBy("batch").count().collect()
    assert sorted(r["batch"] for r in batches) == list(range(79)) and sorted(r["count"] for r in batches)[:2] == [8, 64]


def test_two_level_order_needs_no_range_exchange_and_no_cache(spark):
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    with scoped_conf(spark, "spark.sql.adaptive.enabled", "false"):
        out = batching.shuffle_blocks(spark.range(0, 1000, 1, 4), "id", n_blocks=5)
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "InMemory" not in plan
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


def plain_buffer(rows, size, rng, runs):
    """A buffer that draws once for each run of rows that met a full buffer."""
    held, out, rows, at = [], [], list(rows), 0
    for n in runs:
        run = rows[at : at + n]
        at += n
        while run and len(held) < size:
            held.append(run.pop(0))
        if run:
            for row, slot in zip(run, rng.integers(0, size, len(run))):
                out.append(held[slot])
                held[slot] = row
    return out + [held[i] for i in rng.permutation(len(held))] if held else out


@pytest.mark.parametrize("size,batch", [(1, 10), (37, 10), (37, 100), (500, 64), (10_000, 64)])
def test_buffer_equals_plain_python(spark, size, batch):
    df = spark.range(0, 1000, 1, 3).select("id", F.spark_partition_id().alias("split"))
    splits = {}
    for r in df.collect():
        splits.setdefault(r["split"], []).append(r["id"])
    with scoped_conf(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(batch)):
        got = [(r["split"], r["id"]) for r in batching.shuffle_buffer(df, size, seed=5, epoch=2).collect()]
        same = [(r["split"], r["id"]) for r in batching.shuffle_buffer(df, size, seed=5, epoch=2).collect()]
        other = [(r["split"], r["id"]) for r in batching.shuffle_buffer(df, size, seed=5, epoch=3).collect()]
    assert got == same and (got != other or size == 1)
    for split, rows in splits.items():
        runs = [len(rows[i : i + batch]) for i in range(0, len(rows), batch)]
        want = plain_buffer(rows, size, np.random.default_rng([5, 2, split]), runs)
        mine = [i for s, i in got if s == split]
        assert mine == want and sorted(mine) == rows
        came = {x: i for i, x in enumerate(rows)}
        assert all(left > came[x] - size for left, x in enumerate(mine))


def test_buffer_moves_nothing_and_keeps_every_kind_of_row(spark):
    rows = [(i, None if i % 3 else "é" * (i % 5), [i, None], {"a": i}) for i in range(200)] + [(7, "x", [], {"a": 1})] * 50
    df = spark.createDataFrame(rows, "id int, s string, l array<int>, st struct<a: int>").repartition(2)
    out = batching.shuffle_buffer(df, 16)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, df.collect()))
    assert batching.shuffle_buffer(df.limit(0)).count() == 0
    assert "Exchange" not in _node_names(batching.shuffle_buffer(spark.range(10), 4))
    with pytest.raises(ValueError):
        batching.shuffle_buffer(df, 0)
