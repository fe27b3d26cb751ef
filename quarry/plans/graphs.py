"""Graphs and link files derived from the provided tables.

* Graph T: two-way part–supplier graph from ``lineitem`` — ``'p'‖partkey``
  ↔ ``'s'‖suppkey``; every node has in- and out-links.
* Graph O: the one-way half ``p → s`` (sources never receive rank, targets
  never send: the dangling case).
* Graph M: ``p → s`` for every line, back only for first lines, so some
  parts only send, some suppliers only receive and a core goes round.
* Graph U: user transitions in ``events`` — each event's user links to the
  user of the next event by time (``ts`` is unique per row).
* Link lines: text lines in link-file syntax built from ``lineitem`` so the
  cleaning rules see comments, wrong arity, namespaces and padding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import successor_pairs
from ..sources.tables import table


def _part(col: str):
    return F.concat(F.lit("p"), F.col(col).cast("string"))


def _supp(col: str):
    return F.concat(F.lit("s"), F.col(col).cast("string"))


def graph_one_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(_part("l_partkey").alias("src"), _supp("l_suppkey").alias("dst"))


def graph_two_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_ways(spark, sf_dir, F.lit(True))


def graph_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``p -> s`` for every line, ``s -> p`` for first lines only."""
    return _both_ways(spark, sf_dir, F.col("l_linenumber") == 1)


def _both_ways(spark: SparkSession, sf_dir: str, back) -> DataFrame:
    """Forward edges, and backward ones where ``back`` holds, from one scan."""
    p, s = _part("l_partkey"), _supp("l_suppkey")
    forth = F.struct(p.alias("src"), s.alias("dst"))
    pair = F.array(forth, F.struct(s.alias("src"), p.alias("dst")))
    edges = F.when(back, pair).otherwise(F.array(forth))
    return table(spark, sf_dir, "lineitem").select(F.explode(edges).alias("e")).select("e.src", "e.dst")


def graph_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        "ts", F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("u")
    )
    return successor_pairs(ev, ["ts"], "u")


def link_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic link-file line per ``lineitem`` row (``value`` column).

    Line shapes by ``l_linenumber`` (1..7): plain pair in upper case;
    comment; NBSP/space-padded ``Category:`` source; one field; three
    fields; ``Talk:`` namespace; ``Category:`` target with further colons
    and a space-padded comment marker (data, not a comment).
    """
    li = table(spark, sf_dir, "lineitem")
    p = F.col("l_partkey").cast("string")
    s = F.col("l_suppkey").cast("string")
    o = F.col("l_orderkey").cast("string")
    tab = F.lit("\t")
    n = F.col("l_linenumber")
    line = (
        F.when(n == 1, F.concat(F.lit("P"), p, tab, F.lit("S"), s))
        .when(n == 2, F.concat(F.lit("#P"), p, tab, F.lit("S"), s))
        .when(n == 3, F.concat(F.lit("\u2003 Category:Part "), p, tab, F.lit("S"), s, F.lit(" \u00a0\u3000")))
        .when(n == 4, F.concat(F.lit("P"), p))
        .when(n == 5, F.concat(F.lit("P"), p, tab, tab, F.lit("S"), s))
        .when(n == 6, F.concat(F.lit("Talk:P"), p, tab, F.lit("S"), s))
        .otherwise(F.concat(F.lit(" #O"), o, tab, F.lit("Category:Flag:"), F.col("l_returnflag")))
    )
    return li.select(line.alias("value"))
