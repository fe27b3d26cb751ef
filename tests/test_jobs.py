"""End-to-end jobs: link file → ranks, CSV → sorted CSV."""

import os

import pytest

from quarry import jobs
from quarry.sources import files


def test_pagerank_job_end_to_end(spark, tmp_dir):
    src = os.path.join(tmp_dir, "links.txt")
    with open(src, "w") as f:
        f.write("# comment\ts\nS\ta\na\tb\nb\ta\nTalk:x\ta\n")
    out = os.path.join(tmp_dir, "ranks")
    jobs.pagerank_job(spark, src, out, rounds=1)
    got = {r["node"]: float(r["rank"]) for r in files.read_csv_strings(spark, out).collect()}
    assert got == pytest.approx({"a": 1.85, "b": 1.0})
    text_out = os.path.join(tmp_dir, "ranks_txt")
    jobs.pagerank_job(spark, src, text_out, rounds=2, fmt="text")
    lines = sorted(r["value"] for r in files.read_lines(spark, text_out).collect())
    assert [ln.split("\t")[0] for ln in lines] == ["a", "b"]


def test_sort_job_requires_key_columns(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "x.csv"), "w") as f:
        f.write("a,b\n1,2\n")
    with pytest.raises(ValueError):
        jobs.sort_job(spark, src, os.path.join(tmp_dir, "out"))


def test_sort_job(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "x.csv"), "w") as f:
        f.write("cca2,timestamp,v\nUS,9,a\nUS,10,b\nBR,1,c\n")
    out = os.path.join(tmp_dir, "out")
    jobs.sort_job(spark, src, out)
    rows = []
    for name in sorted(os.listdir(out)):
        if name.endswith(".csv"):
            with open(os.path.join(out, name)) as f:
                rows += [ln.strip() for ln in f.readlines()[1:]]
    assert rows == ["BR,1,c", "US,10,b", "US,9,a"]
