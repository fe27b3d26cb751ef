"""Benchmark decontamination against brute force."""

import random

import pytest

from quarry.llm import decontaminate as D

ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short, item!"), (3, ""), (4, None), (2, "Other words"), (None, "no id here")]
DOCS = [
    (1, "x ONE two, three four five six seven eight nine ten eleven y"),
    (2, "short\nitem short item short"),
    (3, None),
    (4, ""),
    (5, "one two three four five six seven eight nine nope"),
    (6, "two three four five six seven eight nine ten eleven " * 400),
    (6, "no id here"),
    (None, "short item"),
]
SCHEMA = "doc_id long, text string, n_words string, contamination int"


def frames(spark, docs=DOCS, items=ITEMS):
    rows = [(i, t, "clash", 7) for i, t in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(items, "item_id long, text string")


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("block_words", [200_000, 12])
def test_counts_equal_brute_force(spark, block_words):
    docs, bench = frames(spark)
    found = D.find_contamination(docs.select("doc_id", "text"), bench, block_words=block_words).collect()
    got = [(r.doc_id, r.contamination.n_words, r.contamination.n_hit, sorted(r.contamination["items"])) for r in found]
    want = D.brute_force(DOCS, ITEMS)
    assert ordered((a, b, c, len(d)) for a, b, c, d in got) == ordered(r[:4] for r in want)


def test_digest_equals_brute_force(spark):
    rng = random.Random(4)
    words = "alpha beta gamma delta é中".split()
    items = [(i, " ".join(rng.choices(words, k=rng.randint(0, 14)))) for i in range(20)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(150)]
    df, bench = frames(spark, docs, items)
    assert ordered(D.contamination_digest(df, bench).collect()) == ordered(D.brute_force(docs, items))


def test_documents_and_spans_are_removed(spark):
    df, bench = frames(spark)
    kept = D.decontaminate(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    cut = {r.doc_id: r.text for r in D.decontaminate(df.where("doc_id <= 3"), bench, mode="spans").collect()}
    assert cut == {1: "x  y", 2: " short", 3: None}
    with pytest.raises(ValueError):
        D.decontaminate(df, bench, mode="other")


def test_empty_tables(spark):
    df, bench = frames(spark)
    assert not any(r.contaminated for r in D.contamination_digest(df, bench.where("false")).collect())
    assert D.contamination_digest(df.where("false"), bench).collect() == []
