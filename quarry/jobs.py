"""The reference's two Spark jobs as end-to-end entry points.

    spark-submit --py-files quarry.zip submit.py sort <input_dir> <output_dir>
    spark-submit --py-files quarry.zip submit.py pagerank <input> <output_dir> [--rounds 10] [--format csv|text]

Resources (cores, memory) come from ``spark-submit``; nothing is fixed here.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .operators import links, ordering, rank
from .sources import files

SORT_KEYS = ("cca2", "timestamp")  # fixed sort keys of the reference job


def sort_job(spark: SparkSession, input_dir: str, output_dir: str, keys=SORT_KEYS) -> None:
    """Header CSV (all strings) → total order on ``keys`` → header CSV."""
    df = files.read_csv_strings(spark, input_dir)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"input lacks sort column(s) {missing}; has {df.columns}")
    files.write_csv(ordering.total_sort(df, list(keys)), output_dir)


def pagerank_job(
    spark: SparkSession, input_path: str, output_dir: str, rounds: int = rank.ROUNDS, fmt: str = "csv"
) -> None:
    """Link file(s) → cleaned distinct edges → fixed-round PageRank → ranks."""
    edges = links.clean_links(files.read_lines(spark, input_path))
    files.write_ranks(rank.pagerank(edges, rounds=rounds), output_dir, fmt=fmt)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="quarry.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    s = sub.add_parser("sort")
    s.add_argument("input_dir")
    s.add_argument("output_dir")
    p = sub.add_parser("pagerank")
    p.add_argument("input")
    p.add_argument("output_dir")
    p.add_argument("--rounds", type=int, default=rank.ROUNDS)
    p.add_argument("--format", choices=("csv", "text"), default="csv")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"quarry-{args.job}").getOrCreate()
    try:
        if args.job == "sort":
            sort_job(spark, args.input_dir, args.output_dir)
        else:
            pagerank_job(spark, args.input, args.output_dir, args.rounds, args.format)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
