"""Experiment sheets: stacked, pivoted blocks of sweep results → tidy rows.

A sheet is a CSV text file made of blocks. Each block is a title row (only
the first cell filled), a header row (first cell blank or a label, then the
sweep settings), series rows (``MODEL (MEASURE)`` then one value per
setting) and blank separator rows. Values may carry an ``s`` unit suffix,
settings may be products such as ``28*4``, and empty cells mean "not
measured" (no tidy row, not zero); a filled cell that isn't a number keeps
its row and its text. The file may start with a byte-order mark.

Line order is recovered without a single-task window: each line keeps its
file, the start offset of its input split and its position inside the split
(``monotonically_increasing_id`` is ordered within a task). The running
block number is the number of titles seen so far: a window over one
split (bounded by the split size) plus a per-split prefix offset computed on
a table with one row per split. Blocks are told apart by file and number, so
equal titles don't merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import persist

_BOM = "\ufeff"
# Fixed pattern of a series name: "MODEL (MEASURE)".
SERIES_PATTERN = r"^(.*?)\s*\((.*)\)\s*$"
VALUE_PATTERN = r"^\s*([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)\s*s?\s*$"


def read_sheet_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text lines with their order keys ``(file, blk, mid, value)``."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("blk"),
        F.monotonically_increasing_id().alias("mid"),
        F.regexp_replace("value", f"^{_BOM}", "").alias("value"),
    )


def _cells(value: Column) -> Column:
    """A line's cells (as many as it has), quotes taken off."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), value), F.lit(r',("(?:[^"]++|"")*+"[^,]*+|[^,]*+)'), F.lit(1))
    inner = lambda x: F.replace(F.regexp_extract(x, r'^"((?:[^"]++|"")*+)"', 1), F.lit('""'), F.lit('"'))
    return F.transform(raw, lambda x: F.when(x.startswith('"'), inner(x)).otherwise(x))


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def parse_sheet(lines: DataFrame) -> DataFrame:
    """Raw long form ``(file, block, experiment, series, setting_text,
    value_text)`` for every filled value cell of every series row.

    A title is the first row that isn't blank after a blank row, or in the
    file; the next row is the header, the rows up to a blank row are series.
    Blank rows inside a split are numbered by a window over the split; what
    passes between splits is one row for each: its number of blocks and
    whether it begins and ends inside one.
    """
    cells = lines.select("file", "blk", "mid", _cells(F.col("value")).alias("cells"))
    marked = cells.withColumn("is_blank", F.forall("cells", _blank))
    in_split = Window.partitionBy("file", "blk").orderBy("mid")
    before = F.lag("is_blank").over(in_split)
    local = marked.withColumn("_starts", ~F.col("is_blank") & before).withColumn("_first", before.isNull())
    per_split = local.groupBy("file", "blk").agg(
        F.max_by("is_blank", "mid").alias("_ends_blank"),
        F.min_by("is_blank", "mid").alias("_begins_blank"),
        F.count_if(F.coalesce("_starts", F.lit(False))).alias("_n"),
    )
    by_file = Window.partitionBy("file").orderBy("blk")
    entered = per_split.withColumn("_opens", ~F.col("_begins_blank") & F.coalesce(F.lag("_ends_blank").over(by_file), F.lit(True)))
    total = F.sum(F.col("_n") + F.col("_opens").cast("bigint")).over(by_file.rowsBetween(Window.unboundedPreceding, -1))
    offsets = entered.select("file", "blk", "_opens", F.coalesce(total, F.lit(0)).alias("_off"))
    joined = local.join(offsets, ["file", "blk"])
    is_title = F.when(F.col("_first"), F.col("_opens")).otherwise(F.col("_starts"))
    numbered = joined.withColumn("is_title", is_title).withColumn(
        "block", F.col("_off") + F.sum(F.col("is_title").cast("int")).over(in_split.rowsBetween(Window.unboundedPreceding, 0))
    )
    numbered = persist(numbered.where(~F.col("is_blank")).select("file", "block", "is_title", F.struct("blk", "mid").alias("_key"), "cells"))

    body_key = F.when(~F.col("is_title"), F.col("_key"))
    # One aggregate per block: its title, and its header = the first
    # non-title row (min_by skips the rows whose ordering value is null).
    blocks = numbered.groupBy("file", "block").agg(
        F.min_by(F.col("cells")[0], F.when(F.col("is_title"), F.col("_key"))).alias("experiment"),
        F.min(body_key).alias("_hkey"),
        F.min_by("cells", body_key).alias("_hcells"),
    )
    series = numbered.where(~F.col("is_title")).join(blocks, ["file", "block"]).where(F.col("_key") > F.col("_hkey"))
    pairs = series.select(
        "file",
        "block",
        "experiment",
        F.col("cells")[0].alias("series"),
        F.posexplode(F.arrays_zip(F.col("_hcells").alias("h"), F.col("cells").alias("v"))).alias("pos", "hv"),
    ).where(F.col("pos") > 0)
    return pairs.select(
        "file",
        "block",
        F.trim("experiment").alias("experiment"),
        F.trim("series").alias("series"),
        F.trim(F.col("hv.h")).alias("setting_text"),
        F.trim(F.col("hv.v")).alias("value_text"),
    ).where(~_blank(F.col("value_text")))


def parse_setting(text: Column) -> Column:
    """``'28*4'`` → 112.0; a bare number → itself; anything else → null."""
    parts = F.split(text, r"\*")
    return F.aggregate(parts, F.lit(1.0).cast("double"), lambda acc, x: acc * F.trim(x).try_cast("double"))


def parse_value(text: Column) -> Column:
    """``'3642s'`` → 3642.0; ``'151.65'`` → 151.65; other text → null."""
    num = F.regexp_extract(text, VALUE_PATTERN, 1)
    return F.when(num == "", F.lit(None).cast("double")).otherwise(num.try_cast("double"))


#: What tells two sheets' blocks apart, whatever their titles.
BLOCK = ("file", "block")


def tidy(raw: DataFrame) -> DataFrame:
    """``(file, block, experiment, series, model, measure, setting, value,
    value_text)`` with parsed numbers; series named ``MODEL (MEASURE)`` are
    split in two. A filled cell that isn't a number keeps its row, with a null
    value."""
    model = F.regexp_extract("series", SERIES_PATTERN, 1)
    measure = F.regexp_extract("series", SERIES_PATTERN, 2)
    return raw.select(
        *BLOCK,
        "experiment",
        "series",
        F.when(model == "", F.col("series")).otherwise(model).alias("model"),
        F.when(model == "", F.lit(None).cast("string")).otherwise(measure).alias("measure"),
        parse_setting(F.col("setting_text")).alias("setting"),
        parse_value(F.col("value_text")).alias("value"),
        "value_text",
    )


def read_sweeps(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return tidy(parse_sheet(read_sheet_lines(spark, path)))


def speedup(t: DataFrame) -> DataFrame:
    """``value(first setting) / value`` per series (first = lowest setting with a value)."""
    base = t.where("value IS NOT NULL").groupBy(*BLOCK, "series").agg(F.min_by("value", "setting").alias("_base"))
    return t.join(base, [*BLOCK, "series"], "left").withColumn("speedup", F.col("_base") / F.col("value")).drop("_base")


def best_setting(t: DataFrame) -> DataFrame:
    """Setting with the least value per series, lowest setting on ties; a series without a number has none."""
    best = F.min_by(F.struct("setting", "value"), F.when(F.col("value").isNotNull(), F.struct("value", "setting")))
    return t.groupBy(*BLOCK, "experiment", "series", "model", "measure").agg(best.alias("_b")).select(
        *BLOCK, "experiment", "series", "model", "measure",
        F.col("_b.setting").alias("best_setting"), F.col("_b.value").alias("best_value"),
    )


def model_ratio(t: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """``value(model_a) / value(model_b)`` at equal block, measure and
    setting, in one grouped pass (conditional aggregates, no self-join)."""
    a = F.max(F.when(F.col("model") == model_a, F.col("value")))
    b = F.max(F.when(F.col("model") == model_b, F.col("value")))
    return (
        t.where(F.col("model").isin(model_a, model_b))
        .groupBy(*BLOCK, "experiment", "measure", "setting")
        .agg(a.alias("value_a"), b.alias("value_b"))
        .where(F.col("value_a").isNotNull() & F.col("value_b").isNotNull())
        .withColumn("ratio", F.col("value_a") / F.col("value_b"))
    )


def setting_label(x: float) -> str:
    """Column name of a setting, exact to the last digit."""
    text = str(int(x)) if float(x).is_integer() and abs(x) < 1e16 else repr(float(x))
    return "s_" + text.replace(".", "_").replace("-", "m").replace("+", "")


def pivot(t: DataFrame, settings: Sequence[float]) -> DataFrame:
    """Long → wide: one row per block and series, one column per listed
    setting (a listed setting without a value is null). A setting that isn't
    listed has no column."""
    columns = [F.first(F.when(F.col("setting") == float(s), F.col("value")), ignorenulls=True).alias(setting_label(float(s))) for s in settings]
    return t.groupBy(*BLOCK, "experiment", "series").agg(*columns)
