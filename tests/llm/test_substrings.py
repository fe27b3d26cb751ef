"""Substring dedup against brute force."""

import hashlib
import random

import pytest

from quarry.llm import substrings as S

RNG = random.Random(2)
ROWS = [(i, " ".join(RNG.choices("ab", k=RNG.randint(0, 120)))) for i in range(150)]
ROWS += [(500, "a " * 100), (501, "a b " * 60), (502, None), (503, ""), (504, "c d\te\x0bf " * 20), (505, " c d e f" * 21), (None, "a b c " * 30)]


def collect(spark, rows, **more):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, doc int").repartition(5)
    got = S.drop_repeats(df, **more).collect()
    return sorted(map(tuple, got), key=repr)


@pytest.mark.parametrize("window,seed,dense", [(8, 3, 2000), (8, 3, 10), (8, 3, 0), (5, 5, 2000)])
def test_equals_brute_force(spark, window, seed, dense):
    assert collect(spark, ROWS, window=window, seed=seed, dense=dense) == sorted(S.brute_force(ROWS, window), key=repr)


def test_shared_passages_and_copies(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randint(0, 5000)}"
    passage = [word() for _ in range(60)]
    copied = " ".join(word() for _ in range(200))
    rows = []
    for i in range(60):
        text = [word() for _ in range(150)]
        if i % 3 == 0:
            at = rng.randint(0, 150)
            text[at:at] = passage[rng.randint(0, 20) : rng.randint(35, 60)]
        rows.append((i, " ".join(text)))
    rows += [(100 + i, copied) for i in range(20)]
    want = S.brute_force(rows)
    assert sum(r[2] for r in want) > 4000
    assert collect(spark, rows) == sorted(want, key=repr)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    digests = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in S.substring_digest(df).collect()}
    assert digests == {(i, n, m, hashlib.sha256(k.encode()).hexdigest()) for i, n, m, k in want}


def test_rows_with_one_id(spark):
    text = " ".join(f"x{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text + " y"), (2, "z " + text)]
    got = collect(spark, rows)
    assert [r[:3] for r in got if r[0] == 1] == [(1, 40, 0)] * 2  # the same document twice
    assert sorted(r[2] for r in got if r[0] == 2) == [40, 40]
    assert collect(spark, []) == []


def test_automaton_statistics():
    rng = random.Random(3)
    for _ in range(200):
        refs = [[rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in range(3)]
        text = [rng.choice("abc") for _ in range(15)]
        automaton = S.SuffixAutomaton()
        for r in refs:
            automaton.add(r)
        for i, n in enumerate(automaton.statistics(text)):
            best = max((k for k in range(i + 2) if any(text[i + 1 - k : i + 1] == r[j : j + k] for r in refs for j in range(len(r) - k + 1))), default=0)
            assert n == best
