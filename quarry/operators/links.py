"""Link-file cleaning and edge-set construction.

A link file holds one ``src<TAB>dst`` pair per line. Cleaning is a single
projection + filter of built-in expressions (no Python worker), so it fuses
into the scan stage; the edge set is one distinct aggregate with map-side
combine, which also absorbs a line repeated a third of the file.

Semantics kept from the reference job:

* a line whose *raw* text starts with ``#`` is a comment (tested before
  stripping, so ``" #x"`` is data);
* the line is stripped of Python whitespace at both ends, then split on tab;
  exactly two fields must remain (empty middle fields count);
* each field must either start with ``Category:`` (case-sensitive, tested
  before lower-casing; later colons are then allowed) or contain no colon;
* surviving lines are lower-cased; inner spaces are kept.

Spark's text reader splits lines at ``\\n``, ``\\r\\n`` and a lone ``\\r``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import py_strip, split_keep_empty
from .ordering import with_position

# Fixed values that must equal the reference job's behaviour.
COMMENT_PREFIX = "#"
ALLOWED_NAMESPACE = "Category:"
NAMESPACE_MARK = ":"


def link_fields(line: Column) -> Column:
    """Stripped, tab-split fields of a raw line (before lower-casing)."""
    return split_keep_empty(py_strip(line), "\t")


def clean_links(lines: DataFrame, column: str = "value") -> DataFrame:
    """Raw lines → ``(src, dst)`` rows, duplicates kept.

    The stripped, split fields are projected once and then filtered, so the
    strip regex runs once per line.
    """
    line = F.col(column)
    fields = lines.select(line.startswith(COMMENT_PREFIX).alias("_comment"), link_fields(line).alias("_p"))
    parts = F.col("_p")
    namespace_ok = F.forall(
        parts, lambda p: p.startswith(ALLOWED_NAMESPACE) | ~p.contains(NAMESPACE_MARK)
    )
    return fields.where(~F.col("_comment") & (F.size(parts) == 2) & namespace_ok).select(
        F.lower(parts.getItem(0)).alias("src"), F.lower(parts.getItem(1)).alias("dst")
    )


def edge_set(edges: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)`` pairs; self-loops kept."""
    return edges.select("src", "dst").dropDuplicates(["src", "dst"])


def out_degree(edges: DataFrame) -> DataFrame:
    """``(src, deg)`` over distinct edges (partial + final hash aggregate)."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))


def adjacency_lists(edges: DataFrame, chunk_len: int) -> DataFrame:
    """User-facing ``(src, chunk, dsts)``: each source's sorted targets, cut
    in chunks of ``chunk_len`` (the last one may be shorter); the chunks in
    order are the whole list. The same rule holds for every source.

    A report form, not an input to ranking (which stays in edge-list form).
    Distinct edges are numbered in ``(src, dst)`` order by a range sort; a
    target's place in its list is its number less that of the source's first
    edge, so a hub's list is cut without ever standing in one task.
    """
    if chunk_len < 1:
        raise ValueError("chunk_len must be positive")
    numbered = with_position(edges, ["src", "dst"])
    first = numbered.groupBy("src").agg(F.min("pos").alias("first"))
    chunk = F.floor((F.col("pos") - F.col("first")) / F.lit(int(chunk_len))).cast("bigint")
    return (
        numbered.join(first, "src")
        .select("src", "dst", chunk.alias("chunk"))
        .groupBy("src", "chunk")
        .agg(F.sort_array(F.collect_list("dst")).alias("dsts"))
    )
