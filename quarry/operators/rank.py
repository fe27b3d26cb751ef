"""Fixed-round PageRank over a distinct edge list.

Semantics (un-normalised, as in the reference job):

* initial ranks: 1.0 for every node **with out-links**;
* each round: ``contrib(dst) = Σ rank(src) / deg(src)`` over distinct edges,
  an *inner* join, so a node without out-links sends nothing on;
* ``rank(dst) = 0.15 + 0.85 · contrib(dst)`` and the new rank set holds only
  nodes that received a contribution (no floor row for the others);
* no convergence test: exactly ``rounds`` rounds.

Physical plan, designed for a skewed web-scale graph (:mod:`quarry.operators.blocks`):

* The distinct edges are counted, their nodes numbered, and the edges packed by
  the block of their source into ``P`` or more parts, each of them one row of
  arrays, persisted. A hub's block is spread over as many parts as its edges ask for.
* A round is one cogroup of the parts with the sums sent to them, and one
  exchange of such sums: packed arrays, one row for each pair of part and block,
  a target's sum formed in the part first (which absorbs hot targets).
* The rounds are chained in one plan and cut every ``cut_every`` rounds by writing
  the sums in flight to the shared scratch folder; an older cut is deleted when the
  next one is committed. A lost executor costs at most so many rounds.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, persist, scoped_conf, scratch_path
from . import blocks
from .links import edge_set, out_degree

# Fixed values of the reference job.
DAMPING = 0.85
ROUNDS = 10

# Sizing of the packed graph: about this many distinct edges per part, but
# never fewer parts than the cluster's parallelism while each would still
# hold at least MIN_EDGES_PER_PARTITION edges.
EDGES_PER_PARTITION = 2_000_000
MIN_EDGES_PER_PARTITION = 100_000
#: Rounds chained in one plan before the sums are written.
CUT_EVERY = 10


def graph_partitions(spark, n_edges: int) -> int:
    """Partition count for a graph of ``n_edges`` distinct edges: grows with
    the data (``E / 2M``), uses the whole cluster when that is worthwhile."""
    parallel = spark.sparkContext.defaultParallelism
    by_size = math.ceil(n_edges / EDGES_PER_PARTITION)
    by_cores = min(parallel, math.ceil(n_edges / MIN_EDGES_PER_PARTITION))
    return max(1, by_size, by_cores)


def _base(damping: float) -> float:
    """``1 - damping`` as the literal the reference writes (0.15, not
    0.15000000000000002)."""
    return float(f"{1.0 - damping:.12g}")


def rank_init(edges: DataFrame) -> DataFrame:
    """``(node, rank=1.0)`` for every node with out-links."""
    return edges.select(F.col("src").alias("node")).distinct().select(
        "node", F.lit(1.0).alias("rank")
    )


def rank_contribs(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """Per-edge contributions ``(src, dst, contrib = rank(src)/deg(src))``.

    Reference-shaped single step (degree joined on the node side, not per
    edge), used for inspection and the round-one report. Both joins are
    plain shuffle joins; a hub source's partition is split by AQE's skew
    handling (the iterative :func:`pagerank` spreads hubs over parts instead,
    because its packed edges stay where they are).
    """
    deg = out_degree(edges)
    send = ranks.withColumnRenamed("node", "src").join(deg, "src").select(
        "src", (F.col("rank") / F.col("deg")).alias("share")
    )
    return edges.join(send, "src").select("src", "dst", F.col("share").alias("contrib"))


def rank_step(edges: DataFrame, ranks: DataFrame, damping: float = DAMPING) -> DataFrame:
    """One round: inner join, keyed sum by target, affine update."""
    return (
        rank_contribs(edges, ranks)
        .groupBy("dst")
        .agg(F.sum("contrib").alias("s"))
        .select(
            F.col("dst").alias("node"),
            (F.lit(_base(damping)) + F.lit(damping) * F.col("s")).alias("rank"),
        )
    )


def pagerank(
    edges: DataFrame,
    rounds: int = ROUNDS,
    damping: float = DAMPING,
    cut_every: int = CUT_EVERY,
    partitions: int | None = None,
    edges_per_part: int | None = None,
) -> DataFrame:
    """``(node, rank)`` after exactly ``rounds`` rounds.

    ``edges`` needs string columns ``src`` and ``dst``; duplicates and pairs with
    a null are removed first. ``cut_every=0`` never cuts. The result lies in the
    shared scratch folder and everything else is released.
    """
    spark = edges.sparkSession
    distinct = persist(edge_set(edges.where("src IS NOT NULL AND dst IS NOT NULL")))
    if not rounds:
        return rank_init(distinct)
    parts = partitions or graph_partitions(spark, distinct.count())
    graph = blocks.blocked(distinct, parts, edges_per_part)
    base = _base(damping)

    def update(sums):
        return base + damping * sums

    out, cuts = scratch_path(spark, "ranks"), []
    # Parts and sums meet on keys dealt to exactly n_parts partitions, so the
    # rounds run with that setting; adaptive execution has nothing to re-plan
    # (one row a pair of part and block) and would submit every stage apart.
    with scoped_conf(spark, "spark.sql.shuffle.partitions", str(graph.n_parts), spark__sql__adaptive__enabled="false"):
        sums = blocks.first_sums(graph, last=rounds == 1)
        for done in range(1, rounds):
            if cut_every and done % cut_every == 0:
                cuts.append(scratch_path(spark, "sums"))
                sums.write.parquet(cuts[-1])
                sums = spark.read.schema(blocks.SUMS).parquet(cuts[-1])
                for old in cuts[:-1]:  # read for the last time by the cut just committed
                    drop_path(spark, old)
                cuts = cuts[-1:]
            sums = blocks.next_sums(graph, sums, update, last=done == rounds - 1)
        blocks.node_values(graph, sums, update, "rank").write.parquet(out)
    graph.release()
    distinct.unpersist()
    for old in cuts:
        drop_path(spark, old)
    return spark.read.schema("node string, rank double").parquet(out)
