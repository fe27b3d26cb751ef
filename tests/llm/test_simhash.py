"""SimHash near-duplicates against all pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import simhash as S
from quarry.llm.components import connected_components


def fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b) and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprint():
    for text in (None, "", "One", "one two", "One TWO three", "a b c d e f g " * 9, "É é ß \x0b x\ty"):
        assert S.fingerprint_of(text.encode() if text is not None else None) == fingerprint(text)


@pytest.mark.parametrize("dense", [128, 4, 0])
def test_links_close_to_all_pairs(spark, dense):
    rng = random.Random(3)
    fps = {0}
    for _ in range(5):  # clouds of close fingerprints, and loose ones
        centre = rng.getrandbits(64)
        for _ in range(20):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = S.link_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"), 3, dense)
    got_links = links.distinct().collect()
    mask = (1 << 64) - 1
    assert all(((a ^ b) & mask).bit_count() <= 3 for a, b in got_links)
    found = {tuple(sorted(x)) for x in got_links}
    want = roots(signed, lambda a, b: ((a ^ b) & mask).bit_count() <= 3)
    assert roots(signed, lambda a, b: (min(a, b), max(a, b)) in found) == want
    by_job = {r.node: r.root for r in connected_components(links).collect()}
    assert {f: by_job.get(f, f) for f in signed} == want


def test_a_long_chain_is_one_component(spark):
    n = 200
    links = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {tuple(r) for r in connected_components(links).collect()} == {(i, 0) for i in range(n + 1)}
    assert connected_components(links.where("false")).collect() == []


def test_documents(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(9, base), (4, base), (7, base + " tail"), (2, "something else entirely here"), (11, None), (3, ""), (None, base), (2, "something else entirely here"), (12, "Other text that stands alone")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string").repartition(3)
    got = sorted(map(tuple, S.near_duplicate_digest(df).collect()), key=repr)
    texts = {fingerprint(t) for _, t in rows}
    root = roots(texts, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for i, t in rows:
        if i is not None:
            r = root[fingerprint(t)]
            least[r] = min(i, least.get(r, i))
    assert got == sorted(((i, f"{fingerprint(t):016x}", least[root[fingerprint(t)]]) for i, t in rows), key=repr)
    kept = S.keep_representatives(df)
    assert kept.columns == df.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, [i for i, t in rows if i is None or least[root[fingerprint(t)]] == i]))
    assert S.near_duplicate_digest(df.where("false")).collect() == []
