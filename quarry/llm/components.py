"""Connected components of a link table, as Spark jobs.

Alternating star contraction: each round first links every node's larger
neighbours to its smallest neighbour ("large star"), then links each node's
smaller neighbours to the smallest of them ("small star"). Links only ever
shrink towards the component's smallest node; the number of rounds grows with
the logarithm of the longest chain. Each round is one grouped minimum and one
join; its result is written to the shared checkpoint folder, so a lost
executor costs at most one round. Nothing but a count of changes reaches the
driver. A hub's neighbours are joined, not gathered: the skewed side of that
join is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet in the shared scratch folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` (a > b, both directions known from it) contracted once."""
    if large:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        moved = (
            links.withColumnRenamed("a", "u").join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("x"))
            .select("x.a", "x.b").where("a > b")
        )
    return moved.distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)`` (integer ids, any
    order, repeats and self-links allowed, no nulls): root is the smallest node reachable.
    No links give no rows."""
    now = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        after = written(_star(written(_star(now, True), "large"), False), "small")
        mark = after.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        now = after
        if mark == seen:
            break
        seen = mark
    ends = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(ends)
