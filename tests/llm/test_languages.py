"""Language identification: paths against all paths, spans against planted truth, held-out accuracy."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import languages as L
from quarry.sources.tables import table

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string"
BITS = {  # invented languages, two of them in one script
    "aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ber", "zei"],
    "cc": ["жи", "по", "ста", "ну"], "dd": ["字", "语", "文", "言"],
}


def made_text(rng, lang, n):
    return " ".join("".join(rng.choices(BITS[lang], k=rng.randint(2, 4))) for _ in range(n))


def made_docs(rng, n=60):
    langs = list(BITS)
    return [(i, made_text(rng, langs[i % 4], rng.randint(20, 60)), langs[i % 4]) for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_best_paths_against_all_paths(seed):
    rng = np.random.default_rng(seed)
    for k in (1, 2, 3):
        sizes = [0, 1, 2, 5, 7, 6]
        bounds = np.cumsum([0, *sizes])
        texts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
        scores, start = -rng.exponential(3, (bounds[-1], k)), -rng.exponential(1, k)
        for switch in (0.5, 2.0, 6.0):
            path = L.best_paths(scores, start, texts, switch)

            def value(p, a, z):
                return start[p[0]] + sum(scores[a + t, x] for t, x in enumerate(p)) - switch * sum(x != y for x, y in zip(p, p[1:]))

            for a, z in texts:
                if a < z:
                    most = max(value(p, a, z) for p in itertools.product(range(k), repeat=z - a))
                    assert abs(value(path[a:z].tolist(), a, z) - most) < 1e-9


def test_words_and_scripts():
    texts = [b"Ab c-\xc3\x89t\xc3\xa9", None, b"", "12 жи字 x".encode(), ("a" * 150).encode(), "éa ́b".encode()]
    w = L.split_words(texts)
    assert list(zip(w.doc.tolist(), w.start.tolist(), w.length.tolist())) == [
        (0, 0, 2), (0, 3, 1), (0, 5, 3), (3, 3, 2), (3, 5, 1), (3, 7, 1), (4, 0, 64), (4, 64, 64), (4, 128, 22), (5, 0, 3), (5, 4, 2),
    ]
    names = list(L.SCRIPTS)
    assert [names[s] for s in w.script[3:6]] == ["cyrillic", "han", "latin"]
    same = L.split_words([b"word Word WORD", b"word"])
    assert len(set(same.whole.tolist())) == 1 and len(set(same.ends.tolist())) == 1
    apart = L.split_words([b"word words wor Dword"])
    assert len(set(apart.whole.tolist())) == 4
    alone, among = L.split_words([b"one two"]), L.split_words([b"zz", b"one two"])
    assert among.triples[2:].tolist() == alone.triples.tolist() and among.start[1:].tolist() == alone.start.tolist()


def test_spans_of_mixed_texts(spark):
    rng = random.Random(7)
    model = L.fit_languages(spark.createDataFrame(made_docs(rng), SCHEMA))
    assert model.names == ("aa", "bb", "cc", "dd")
    right = letters = 0
    for a, b in itertools.permutations(BITS, 2):
        parts = [(a, made_text(rng, a, 12)), (b, made_text(rng, b, 15)), (a, made_text(rng, a, 9))]
        text = "; ".join(t for _, t in parts)
        lang, score, spans = L.label_texts([text.encode()], model)[0]
        truth, at = {}, 0
        for name, t in parts:
            truth |= {at + i: name for i, c in enumerate(t) if c.isalpha()}
            at += len(t) + 2
        told = {i: name for s, e, name in spans for i in range(s, e)}
        letters += len(truth)
        right += sum(told.get(i) == name for i, name in truth.items())
        assert 0 <= score <= 1 and lang in (a, b)
        assert all(x[1] <= y[0] and x[2] != y[2] for x, y in zip(spans, spans[1:]))
    assert right / letters > 0.98
    # a script leaves only its own languages, whatever the neighbours say
    assert [x[2] for x in L.label_texts(["kalo miтu жипо kalo mitu".encode()], model)[0][2]][0] == "aa"
    words = L.split_words(["жж kk 字".encode()])
    ruled = model.word_scores(words) <= -1e4
    assert ruled.tolist() == [[True, True, False, True], [False, False, True, True], [True, True, True, False]]


def test_counts_do_not_depend_on_partitions(spark):
    docs = made_docs(random.Random(2))
    one = L.fit_languages(spark.createDataFrame(docs, SCHEMA).coalesce(1))
    many = L.fit_languages(spark.createDataFrame(docs, SCHEMA).repartition(7))
    assert one.names == many.names and (one.scores == many.scores).all() and (one.start == many.start).all()
    # plain counts of two-letter runs of one word
    solo = L.fit_languages(spark.createDataFrame([(1, "abab", "x"), (2, "cd", "y")], SCHEMA))
    assert solo.names == ("x", "y") and solo.candidates.shape[1] == 2


def test_held_out_accuracy_and_no_leak(spark):
    docs = table(spark, SF, "documents")
    got = L.language_digest(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    joined = got.join(docs, "doc_id").where("held_out").select("lang", "lang_pred", "score").collect()
    assert len(joined) > 200 and sum(r["lang"] == r["lang_pred"] for r in joined) / len(joined) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in joined)
    assert got.count() == docs.count()
    # the language of held-out documents is no input
    hidden = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(map(tuple, L.language_digest(hidden).collect())) == sorted(map(tuple, got.collect()))


def test_defined_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert L.language_digest(empty).count() == 0 and L.fit_languages(empty).names == ()
    docs = made_docs(random.Random(3)) + [(100, None, "aa"), (101, "", "bb"), (102, "12 -- 7", "zz"), (103, made_text(random.Random(1), "cc", 5), None), (None, made_text(random.Random(1), "aa", 30), "cc"), (0, "", "aa")]
    long = " ".join([made_text(random.Random(9), "bb", 500)] * 200)
    docs += [(104, long, "bb")]
    rows = spark.createDataFrame(docs, SCHEMA)
    got = {(r["doc_id"], r["lang_pred"], r["score"] == 0) for r in L.language_digest(rows).collect()}
    assert {(100, "und", True), (101, "und", True), (102, "und", True), (103, "cc", False), (None, "aa", False), (104, "bb", False)} <= got
    assert "zz" not in L.fit_languages(rows).names
    untaught = L.language_digest(spark.createDataFrame([(1, "some words", None)], SCHEMA)).collect()
    assert [tuple(r) for r in untaught] == [(1, False, "und", 0.0)]
    clash = rows.withColumn("lang_pred", F.lit("mine")).withColumn("labelled", F.lit(1))
    out = L.identify(clash, L.fit_languages(rows))
    assert out.columns == [*clash.columns, "lang_pred_", "lang_score", "lang_spans"] and out.where("lang_pred = 'mine'").count() == len(docs)
    tie = L.fit_languages(spark.createDataFrame([(1, "same words", "b"), (2, "same words", "a")], SCHEMA))
    assert L.label_texts([b"other same"], tie)[0][0] == "a"
