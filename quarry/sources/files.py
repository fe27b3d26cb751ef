"""Readers and writers for the reference's file formats.

* CSV with a header and **no** type inference: every column is a nullable
  string; a blank field and a quoted empty field both read as null.
* Text lines: one ``value`` string per line; paths may be globs, lists or
  folders (Hadoop path semantics).
* CSV sink with one header per part file; by default it fails when the
  target exists (``errorifexists``), as a plain ``write.csv`` does.
* Rank export: the promised two-column CSV, or one tab-joined text column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv_strings(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Header CSV, all columns string (no ``inferSchema``)."""
    paths = [path] if isinstance(path, str) else list(path)
    return (
        spark.read.format("csv")
        .option("header", "true")
        .option("inferSchema", "false")
        .load(paths)
    )


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text-line scan → ``DataFrame[value: string]``."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header CSV sink; nulls are written as empty fields."""
    df.write.mode(mode).option("header", "true").csv(path)


def write_lines(df: DataFrame, path: str, column: str = "value", mode: str = "errorifexists") -> None:
    """Single string column → text files."""
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def rank_lines(ranks: DataFrame, digits: int | None = None) -> DataFrame:
    """``node<TAB>rank`` as one text column (the text form of a rank export)."""
    rank = F.col("rank")
    rank_txt = F.format_string(f"%.{digits}f", rank) if digits is not None else rank.cast("string")
    return ranks.select(F.concat_ws("\t", F.col("node"), rank_txt).alias("value"))


def write_ranks(ranks: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Rank export: ``csv`` (``node,rank`` with header) or ``text``."""
    if fmt == "csv":
        # node names keep their padding (the sort job's CSV trims, as the reference's does)
        keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        ranks.select("node", "rank").write.mode(mode).options(header="true", **keep).csv(path)
    elif fmt == "text":
        write_lines(rank_lines(ranks), path, mode=mode)
    else:
        raise ValueError(f"unknown rank export format {fmt!r}")


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    """Parquet table sink (weights, metrics, prepared batches)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
