"""An experiment sheet derived from ``lineitem`` (the sweep queries' input).

One block per return flag: title ``Flag F (avg price, by line number)``, a
header of line numbers (even ones written as products ``2*k``), then per
line status a ``STATUS (price)`` series whose values carry an ``s`` suffix
and a ``STATUS (qty)`` series without unit; a missing combination is an
empty cell. Blocks are separated by blank rows and the file starts with a
byte-order mark, like a spreadsheet export.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import persist, scratch_path
from ..sources import files
from ..sources.tables import table


def sheet_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[int], str, DataFrame]:
    li = table(spark, sf_dir, "lineitem")
    # One row per (flag, status, line number): aggregate-sized, reused by
    # every block below, so it is cached rather than recomputed per branch.
    agg = persist(
        li.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
            F.avg("l_extendedprice").alias("price"), F.avg("l_quantity").alias("qty")
        )
    )
    # Pivot values: the distinct line numbers (a handful), listed explicitly.
    settings = sorted(r[0] for r in agg.select("l_linenumber").distinct().collect())
    n = len(settings)
    header_cells = [f"2*{s // 2}" if s % 2 == 0 else str(s) for s in settings]

    def series(measure: str, text):
        wide = (
            agg.groupBy("l_returnflag", "l_linestatus")
            .pivot("l_linenumber", settings)
            .agg(F.first(text))
        )
        cells = [F.coalesce(F.col(str(s)), F.lit("")) for s in settings]
        return wide.select(
            F.col("l_returnflag").alias("flag"),
            F.lit(2 if measure == "price" else 3).alias("ord"),
            F.col("l_linestatus").alias("sub"),
            F.concat_ws(",", F.concat(F.col("l_linestatus"), F.lit(f" ({measure})")), *cells).alias("value"),
        )

    flags = agg.select(F.col("l_returnflag").alias("flag")).distinct()
    title = flags.select(
        "flag", F.lit(0).alias("ord"), F.lit("").alias("sub"),
        F.concat(F.lit('"Flag '), F.col("flag"), F.lit(' (avg price, by line number)"'), F.lit("," * n)).alias("value"),
    )
    header = flags.select(
        "flag", F.lit(1).alias("ord"), F.lit("").alias("sub"), F.lit("," + ",".join(header_cells)).alias("value")
    )
    blank = flags.select("flag", F.lit(4).alias("ord"), F.lit("").alias("sub"), F.lit("," * n).alias("value"))
    price = series("price", F.concat(F.col("price").cast("string"), F.lit("s")))
    qty = series("qty", F.col("qty").cast("string"))
    lines = title.unionByName(header).unionByName(price).unionByName(qty).unionByName(blank)
    first_flag = agg.agg(F.min("l_returnflag")).first()[0]
    return lines, settings, first_flag, agg


def write_sheet(spark: SparkSession, sf_dir: str) -> tuple[str, list[int]]:
    """Write the sheet as one ordered text file; returns its folder. The
    sheet has one line per (flag, status, measure): aggregate-sized, so a
    single ordered output file is cheap."""
    lines, settings, first_flag, agg = sheet_lines(spark, sf_dir)
    bom_first = (F.col("flag") == F.lit(first_flag)) & (F.col("ord") == 0)
    text = lines.select(
        "flag", "ord", "sub",
        F.when(bom_first, F.concat(F.lit("\ufeff"), F.col("value"))).otherwise(F.col("value")).alias("value"),
    ).orderBy("flag", "ord", "sub").coalesce(1)
    path = scratch_path(spark, "sheet")
    files.write_lines(text, path)
    agg.unpersist()
    return path, settings


def write_two_sheets(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Two sheets of one block with the same title: quantities summed per
    line number and status, the second sheet with twice the values, ``n/a`` at
    the first setting and a series of empty cells."""
    li = table(spark, sf_dir, "lineitem")
    sums = {
        (r[0], r[1]): int(r[2])
        for r in li.groupBy("l_linestatus", "l_linenumber").agg(F.sum("l_quantity").cast("bigint")).collect()  # a handful
    }
    statuses, numbers = sorted({s for s, _ in sums}), sorted({n for _, n in sums})
    paths = []
    for name, factor in (("sheet_a", 1), ("sheet_b", 2)):
        rows = ['"Quantities, by ""line"""', ",".join(["", *map(str, numbers)])]
        for s in statuses:
            cells = [str(factor * sums[s, n]) + "s" if (s, n) in sums else "" for n in numbers]
            rows.append(",".join([f"{s} (sum)", *(["n/a", *cells[1:]] if factor == 2 else cells)]))
        if factor == 2:
            rows.insert(3, ",".join(["none (sum)", *[""] * len(numbers)]))
        path = scratch_path(spark, name)
        files.write_lines(spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, value string").coalesce(1).sortWithinPartitions("i"), path)
        paths.append(path)
    return paths[0], paths[1]
