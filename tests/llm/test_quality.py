"""Quality counts against plain Python; the decision list on planted rules."""

import random

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import quality as Q


def test_counts_equal_brute_force():
    rng = random.Random(1)
    parts = ["a", "b", "é", "#", " ", " ", "\n", "\t", "\x0b", "中", "|x", " "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 80))) for _ in range(2000)] + [None, "", "\n\n", "a b c " * 50, "a " * 300]
    for t in texts:
        assert Q.counts_of(t.encode() if t is not None else None)[:5] == Q.brute_counts(t)


def test_many_different_words_need_no_packing():
    ids = np.array([0, 1, 2, 5, 0, 1, 2], np.int64)
    assert Q.repeated_window_words(ids, 1 << 20) == Q.repeated_window_words(ids, 6) == 6


def test_decision_list_finds_planted_rules():
    rng = np.random.default_rng(5)
    x = {"a": rng.random(6000), "b": rng.random(6000), "c": rng.random(6000)}
    bad = ((x["a"] > 0.8) & (x["b"] <= 0.5)) | (x["c"] > 0.95)
    rules = Q.fit_decision_list(x, bad)
    assert len(rules.rules) >= 2 and str(rules).endswith("keep")
    test = {k: rng.random(4000) for k in x}
    truth = ((test["a"] > 0.8) & (test["b"] <= 0.5)) | (test["c"] > 0.95)
    got = rules.rejects(test)
    assert (got == truth).mean() > 0.97 and (got & ~truth).sum() <= 0.02 * (~truth).sum()


def test_noise_gives_no_rule():
    rng = np.random.default_rng(6)
    assert Q.fit_decision_list({"a": rng.random(3000)}, rng.random(3000) < 0.3).rules == []
    assert Q.fit_decision_list({"a": np.empty(0)}, np.empty(0, bool)).rules == []


def test_spark_expression_equals_the_list(spark):
    good = " ".join(f"word{i}" for i in range(80))
    noisy = " ".join(f"w{i}$$$" for i in range(80))
    rows = [(i, good + f" x{i}", "k") for i in range(60)] + [(100 + i, noisy + f" y{i}", "k") for i in range(60)]
    rows += [(200, None, "k"), (201, "", "k"), (202, "short text", "k"), (None, good, "k"), (0, good, "k"), (203, "a b c " * 60, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(3)
    labels = spark.createDataFrame([(i, int(i < 100)) for i in [*range(60), *range(100, 160), 999]] + [(None, 1), (5, None)], "doc_id long, quality int")
    rules = Q.learn_rules(docs, labels)
    judged = Q.judged(docs, rules, out_col="c").select("doc_id", "c").collect()
    for r in judged:
        x = {k: np.array([v]) for k, v in {"symbols_per_word": r.c.n_symbols / max(1, r.c.n_words)}.items()}
        assert r.c.kept == (not r.c.base_failed and x["symbols_per_word"][0] < 1)
    kept = Q.keep_good(docs, rules)
    assert kept.columns == docs.columns and kept.count() == 62
    assert {r.doc_id: r.kept for r in Q.quality_digest(docs, labels).where(F.col("doc_id") >= 200).collect()} == {200: False, 201: False, 202: False, 203: False}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert Q.quality_digest(docs.where("false"), labels).collect() == []
    assert Q.quality_digest(docs, labels.where("false")).count() == 1


def test_repeated_labelled_id_counts_as_one_label(spark):
    good = " ".join(f"word{i}" for i in range(80))
    noisy = " ".join(f"w{i}$$$" for i in range(80))
    rows = [(i, good + f" x{i}") for i in range(60)] + [(100 + i, noisy + f" y{i}") for i in range(60)]
    hot = [(0, noisy + " z")] * 300 + [(0, noisy + " z" * k) for k in range(2, 60)]  # a good label on noisy texts
    docs = spark.createDataFrame(rows + hot, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i < 100)) for i in [*range(60), *range(100, 160)]], "doc_id long, quality int")
    found = Q.fit_table(docs, labels, "doc_id", "text", "quality", 120).toPandas()
    assert len(found) == 120 and found["weight"][found["id"] != 0].tolist() == [1.0] * 119
    assert 0 < found["weight"][found["id"] == 0].sum() <= 1
    rejected = Q.quality_digest(docs, labels).where("doc_id >= 100 AND NOT kept").count()
    assert rejected == 60
