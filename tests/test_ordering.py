"""Export sort and position column semantics."""

import os

from pyspark.sql import functions as F

from quarry.operators import ordering
from quarry.sources import files


def test_export_sort_string_order_nulls_first(spark, tmp_dir):
    a = os.path.join(tmp_dir, "in", "a.csv")
    b = os.path.join(tmp_dir, "in", "b.csv")
    os.makedirs(os.path.dirname(a))
    with open(a, "w") as f:
        f.write('cca2,timestamp,x\nUS,10,1\nUS,9,2\n,5,3\n"",7,4\nIN,,5\n')
    with open(b, "w") as f:
        f.write("cca2,timestamp,x\nus,1,6\nIN,9,7\nBR,3,8\n")
    df = files.read_csv_strings(spark, os.path.join(tmp_dir, "in"))
    assert dict(df.dtypes) == {"cca2": "string", "timestamp": "string", "x": "string"}
    out = os.path.join(tmp_dir, "out")
    files.write_csv(ordering.total_sort(df, ["cca2", "timestamp"]), out)
    back = files.read_csv_strings(spark, out)
    assert back.count() == 8
    # part files in name order form the total order
    rows = []
    for name in sorted(os.listdir(out)):
        if name.endswith(".csv"):
            with open(os.path.join(out, name)) as f:
                rows += [ln.rstrip("\n").split(",") for ln in f.readlines()[1:]]
    keys = [(r[0] or None, r[1] or None) for r in rows]
    assert keys == [(None, "5"), (None, "7"), ("BR", "3"), ("IN", None), ("IN", "9"),
                    ("US", "10"), ("US", "9"), ("us", "1")]


def test_sink_refuses_existing_path(spark, tmp_dir):
    df = spark.createDataFrame([("a",)], "v string")
    files.write_csv(df, os.path.join(tmp_dir, "x"))
    import pytest

    with pytest.raises(Exception):
        files.write_csv(df, os.path.join(tmp_dir, "x"))


def test_total_sort_plan_is_range_partitioned(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("t").alias("t"))
    plan = ordering.total_sort(df, ["k", "t"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan
    assert "SinglePartition" not in plan


def test_position_matches_row_number(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("k"))
    got = {r["k"]: r["pos"] for r in ordering.with_position(df, ["k"]).collect()}
    want = {k: i + 1 for i, k in enumerate(sorted(got))}
    assert got == want
    plan = ordering.with_position(df, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan


def test_successor_pairs(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "ts int, u string")
    assert sorted(tuple(r) for r in ordering.successor_pairs(df, ["ts"], "u").collect()) == [("a", "b"), ("b", "c")]


def test_successor_pairs_across_batches_and_partitions(spark):
    import random

    from quarry.session import scoped_conf

    rows = [(i, f"u{i % 7}" if i % 11 else None) for i in range(500)]
    want = sorted(((a[1], b[1]) for a, b in zip(rows, rows[1:])), key=repr)
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "ts int, u string").repartition(5)
    with scoped_conf(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "13", spark__sql__adaptive__enabled="false"):
        got = [tuple(r) for r in ordering.successor_pairs(df, ["ts"], "u").collect()]
    assert sorted(got, key=repr) == want
    assert ordering.successor_pairs(df.limit(1), ["ts"], "u").count() == 0
    assert ordering.successor_pairs(df.limit(0), ["ts"], "u").count() == 0


def test_head_is_ordered_limit(spark):
    df = spark.range(0, 1000, 1, 5).select((999 - F.col("id")).alias("k"))
    assert [r["k"] for r in ordering.head(df, ["k"], 5).collect()] == [0, 1, 2, 3, 4]


def test_hot_duplicate_key_is_split_across_partitions(spark, tmp_dir):
    # one (key, key) pair repeated for a third of the rows
    hot = spark.range(0, 30000, 1, 8).select(F.lit("k").alias("a"), F.lit("t").alias("b"))
    rest = spark.range(0, 60000, 1, 8).select(F.col("id").cast("string").alias("a"), F.lit("t").alias("b"))
    out = os.path.join(tmp_dir, "sorted")
    # keep AQE from merging the (small) range partitions back into one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordering.total_sort(hot.unionByName(rest), ["a", "b"]).write.parquet(out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per_file = spark.read.parquet(out).groupBy(F.input_file_name().alias("f")).count().collect()
    assert sum(r["count"] for r in per_file) == 90000
    assert max(r["count"] for r in per_file) < 30000


def test_export_is_a_monotone_permutation_across_part_files(spark, tmp_dir):
    from quarry.sources.tables import table
    from tests.conftest import SF_SMALL

    ev = table(spark, SF_SMALL, "events").select(
        F.col("event_type").alias("cca2"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("event_id").cast("string").alias("event_id"),
    )
    out = os.path.join(tmp_dir, "sorted")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_csv(ordering.total_sort(ev.repartition(5), ["cca2", "timestamp"]), out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(n for n in os.listdir(out) if n.endswith(".csv"))
    assert len(parts) > 1
    rows = []
    for name in parts:
        with open(os.path.join(out, name), encoding="utf-8") as f:
            rows += [ln.rstrip("\n").split(",") for ln in f.readlines()[1:]]
    keys = [((r[0] or None) is not None, (r[0] or "").encode(), (r[1] or "").encode()) for r in rows]
    assert keys == sorted(keys)
    assert sorted(r[2] for r in rows) == sorted(str(r[0]) for r in ev.select("event_id").collect())
