"""Session helpers: shared scratch space, scoped settings, sizing."""

import pytest

from quarry.operators import rank
from quarry.session import checkpoint_dir, scoped_conf, scratch_path


def test_scratch_paths_live_under_the_checkpoint_folder(spark):
    base = checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base) and b.startswith(base) and a != b


def test_scoped_conf_restores_even_on_error(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError):
        with scoped_conf(spark, "spark.sql.shuffle.partitions", "3", spark__sql__adaptive__enabled="false"):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
            assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
            raise RuntimeError("boom")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_graph_partitions_grow_with_edges(spark):
    par = spark.sparkContext.defaultParallelism
    assert rank.graph_partitions(spark, 10) == 1
    assert rank.graph_partitions(spark, 10_000_000) == max(5, par)
    assert rank.graph_partitions(spark, 10**12) == 500_000


def test_pagerank_restores_session_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    rank.pagerank(df, rounds=2).collect()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_stable_key_uses_sixty_bits(spark):
    from pyspark.sql import functions as F

    from quarry.functions.keys import stable_bucket, stable_key

    df = spark.range(20_000)
    assert df.select(F.max(stable_bucket("id", 1 << 29))).first()[0] > 1 << 28
    assert df.select(stable_key("id")).distinct().count() == 20_000
