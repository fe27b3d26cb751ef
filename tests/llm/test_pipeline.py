"""The corpus pipeline, stage by stage, on planted documents."""

import random

import corpus_pipeline
from quarry.llm import decontaminate, quality, simhash
from quarry.llm.components import written
from quarry.session import scratch_path


def corpus(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=5))
    prose = lambda n: " ".join(word() for _ in range(n))
    bench = [(i, prose(14)) for i in range(5)]
    rows, labels = [], []
    for i in range(80):
        rows.append((i, "\n".join(prose(40) for _ in range(2 + i % 4)) + ("\nShare this page" if i % 2 else "")))
        labels.append((i, 1))
    for i in range(100, 140):
        rows.append((i, " ".join(w + "$$$" for w in prose(60 + 3 * (i - 100)).split())))
        labels.append((i, 0))
    rows += [(200, rows[4][1]), (201, rows[4][1].upper())]
    rows += [(300, prose(60) + " " + bench[2][1] + " " + prose(30)), (301, "too short"), (302, None), (None, prose(70))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    folder = scratch_path(spark, "corpus")
    docs.repartition(4).write.parquet(folder + "/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(folder + "/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(folder + "/benchmark.parquet")
    return folder


def test_stages(spark):
    folder = corpus(spark)
    docs = spark.read.parquet(folder + "/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), name)
        seen[name] = sorted(r.doc_id if r.doc_id is not None else -1 for r in docs.collect())
        if name != "encoding":
            assert docs.columns == columns
        if name == "line_dedup":
            assert all("Share this page" not in r.text and r.n_chars == len(r.text) for r in docs.collect())
    assert seen["quality_rules"] == [-1, *range(80), 200, 201, 300]
    assert seen["line_dedup"] == seen["quality_rules"]
    assert seen["near_dedup"] == [-1, *range(80), 300]
    assert seen["decontamination"] == seen["encoding"] == [-1, *range(80)]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "encoding"]
    got = corpus_pipeline.run(spark, folder)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, docs.collect())))


def test_stages_equal_their_operators(spark):
    folder = corpus(spark)
    docs = spark.read.parquet(folder + "/documents.parquet")
    labels, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    ids = lambda df: sorted(repr(r.doc_id) for r in df.collect())
    kept = quality.quality_digest(docs, labels).where("kept")
    assert ids(corpus_pipeline.quality_rules(spark, docs, folder)) == ids(kept)
    clean = decontaminate.contamination_digest(docs, bench).where("NOT contaminated")
    assert ids(corpus_pipeline.decontamination(spark, docs, folder)) == ids(clean)
    first = simhash.near_duplicate_digest(docs).where("doc_id = component_id OR doc_id IS NULL")
    assert ids(corpus_pipeline.near_dedup(spark, docs, folder)) == ids(first)
