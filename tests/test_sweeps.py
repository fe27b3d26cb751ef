"""Experiment-sheet parsing on invented sheets."""

import os

import pytest

from quarry.operators import sweeps

SHEET = (
    "\ufeff\"Bakers (night shift, 30 loaves)\",,,\n"
    ",1,2,4\n"
    "Rye (oven),90s,50s,30s\n"
    "Oat (oven),12.5s,,\n"
    ",,,\n"
    "\"Flour \"\"00\"\", sifted\",,,\n"
    ",12*1,12*2,\n"
    "Rye (sieve),7.25,9.5,\n"
    ",,,\n"
    ",,,\n"
    "Proofing baskets,,,\n"
    "count,1,4,8\n"
    "none (shelf),,,\n"
    "Oat (shelf),11,n/a,17\n"
)
A, B, C = "Bakers (night shift, 30 loaves)", 'Flour "00", sifted', "Proofing baskets"


@pytest.fixture()
def tidy(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sheet.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(SHEET)
    return sweeps.read_sweeps(spark, path)


def test_tidy_rows(tidy):
    rows = sorted(((r["experiment"], r["model"], r["measure"], r["setting"], r["value"], r["value_text"]) for r in tidy.collect()), key=repr)
    assert rows == sorted([
        (A, "Rye", "oven", 1.0, 90.0, "90s"), (A, "Rye", "oven", 2.0, 50.0, "50s"), (A, "Rye", "oven", 4.0, 30.0, "30s"),
        (A, "Oat", "oven", 1.0, 12.5, "12.5s"), (B, "Rye", "sieve", 12.0, 7.25, "7.25"), (B, "Rye", "sieve", 24.0, 9.5, "9.5"),
        (C, "Oat", "shelf", 1.0, 11.0, "11"), (C, "Oat", "shelf", 4.0, None, "n/a"), (C, "Oat", "shelf", 8.0, 17.0, "17"),
    ], key=repr)


def test_speedup_and_best(tidy):
    sp = {(r["experiment"], r["series"], r["setting"]): r["speedup"] for r in sweeps.speedup(tidy).collect()}
    assert sp[A, "Rye (oven)", 4.0] == pytest.approx(90 / 30)
    assert sp[C, "Oat (shelf)", 4.0] is None
    best = {(r["experiment"], r["series"]): (r["best_setting"], r["best_value"]) for r in sweeps.best_setting(tidy).collect()}
    assert best[A, "Rye (oven)"] == (4.0, 30.0)
    assert best[C, "Oat (shelf)"] == (1.0, 11.0)


def test_pivot_back(tidy):
    wide = sweeps.pivot(tidy, [1, 2, 4])
    row = wide.where("series = 'Rye (oven)'").first()
    assert (row["s_1"], row["s_2"], row["s_4"]) == (90.0, 50.0, 30.0)


def test_setting_labels_are_exact():
    names = [sweeps.setting_label(x) for x in (1234567.0, 1234568.0, 1e7, 0.1, -2.5, 1e20)]
    assert len(set(names)) == len(names) and names[:3] == ["s_1234567", "s_1234568", "s_10000000"]


def test_equal_titles_in_two_files_stay_apart(spark, tmp_dir):
    paths = []
    for name, factor in (("a", 1), ("b", 10)):
        paths.append(os.path.join(tmp_dir, name + ".csv"))
        with open(paths[-1], "w", encoding="utf-8") as f:
            f.write(f"Same\n,1,2\nX (t),{8 * factor},{2 * factor}\n\nSame\n,1,2\nX (t),{6 * factor},{3 * factor}")
    got = sorted((r["setting"], r["value"], r["speedup"]) for r in sweeps.speedup(sweeps.read_sweeps(spark, paths)).collect())
    assert got == [(1.0, 6.0, 1.0), (1.0, 8.0, 1.0), (1.0, 60.0, 1.0), (1.0, 80.0, 1.0), (2.0, 2.0, 4.0), (2.0, 3.0, 2.0), (2.0, 20.0, 4.0), (2.0, 30.0, 2.0)]


def test_blocks_across_input_splits_and_wide_lines(spark, tmp_dir):
    from quarry.session import scoped_conf

    path = os.path.join(tmp_dir, "long.csv")
    with open(path, "w", encoding="utf-8") as f:
        for b in range(40):
            f.write(f"Block {b}\n,1,2\nX (t),{b + 1},5\n" + "\n" * (1 + b % 2))
        f.write("Wide" + "," * 25_000 + "\n")
    with scoped_conf(spark, "spark.sql.files.maxPartitionBytes", "64", spark__sql__files__openCostInBytes="0"):
        got = sorted((r["experiment"], r["setting"], r["value"]) for r in sweeps.read_sweeps(spark, path).collect())
    assert got == sorted(x for b in range(40) for x in ((f"Block {b}", 1.0, float(b + 1)), (f"Block {b}", 2.0, 5.0)))
