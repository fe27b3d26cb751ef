"""Hard negatives against all pairs in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import negatives as N
from quarry.sources.tables import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=3, every=50, moved=True):
    """Every pair's score, sorted."""
    live = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        if moved and i % 7 == 0:
            label = (label + 1) % 10
        live.append((i, [math.floor(256 * float(np.float32(c))) for c in v], label))
    out = []
    for a, x, label in live:
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), b, other) for b, y, other in live if b != a)
        for ps, p in [(-s, b) for s, b, other in scored if other == label][:positives]:
            fit = [(-s, b) for s, b, other in scored if other != label and 50 * ps <= 100 * -s <= 95 * ps][:negatives]
            out += [(a, p, r, b, ps, s) for r, (s, b) in enumerate(fit, 1)]
    return sorted(out)


def made(frame):
    return sorted(map(tuple, frame.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_whole_table(spark):
    rows = table(spark, "/root/testdata/sf0.01", "embeddings")
    assert made(N.negatives_digest(rows)) == brute(map(tuple, rows.collect()))


@pytest.mark.parametrize("block,quarter", [(8, False), (64, True)])
def test_lengths_ties_and_small_blocks(spark, monkeypatch, block, quarter):
    rng = random.Random(block)
    centres = [[rng.gauss(0, 1) for _ in range(5)] for _ in range(4)]
    rows = []
    for i in range(400):
        size = 4.0 ** rng.randint(-3, 3) if quarter else 1.0  # lengths over orders of magnitude
        rows.append((i, [float(np.float32(size * (c + rng.gauss(0, 0.05)))) for c in rng.choice(centres)], rng.randint(0, 3)))
    rows += [(500 + i, rows[3][1], i % 3) for i in range(200)]  # a third of the rows are copies
    monkeypatch.setattr(N, "BLOCK_ROWS", block)
    monkeypatch.setattr(N, "GROUP_ROWS", 4)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert made(N.negatives_digest(frame)) == brute(rows)


def test_defined_cases(spark, monkeypatch):
    assert N.negatives_digest(spark.createDataFrame([], SCHEMA)).count() == 0
    base = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.7, 0.2], 2), (3, [0.8], 2), (4, [], 2), (5, [0.0, 0.0], 1), (12, [0.7], 1), (50, [-1.0, 0.0], 1)]
    odd = [(None, [1.0, 0.0], 1), (6, None, 1), (8, [1.0, 0.0], None), (9, [1.0, None], 1), (10, [float("nan"), 0.0], 2), (11, [0.6, float("inf")], 2)]
    frame = spark.createDataFrame(base + odd, SCHEMA)
    got = made(N.negatives_digest(frame))
    want = brute([(i, (v + [0.0, 0.0])[:2] if v is not None else None, x) for i, v, x in base + odd])
    assert got == want and any((r[1], r[3]) == (3, 12) for r in got)
    clash = frame.withColumn("x", F.lit(1)).withColumn("key", F.lit("k")).withColumn("bucket", F.lit(2))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    assert made(N.mine_hard_negatives(clash.withColumn("label", moved), F.col("vec_id") % 50 == 0)) == want
    # a repeated row is a row of its own, but no partner of its namesakes
    twice = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2), (2, [0.9], 2)], SCHEMA)
    moved_anchor = N.mine_hard_negatives(twice, F.col("vec_id") == 0)
    assert made(moved_anchor) == [(0, 1, r, 2, 65536, 58880) for r in (1, 1, 2, 2)]
    with pytest.raises(ValueError, match="64 bits"):
        N.negatives_digest(spark.createDataFrame([(0, [1e20], 1)], SCHEMA))


def test_large_components_and_grid(spark, monkeypatch):
    """Scores past 2**53 stay exact, and dealing both sides to a grid gives the same rows."""
    rng = random.Random(4)
    rows = [(i, [float(np.float32(rng.uniform(-1, 1) * 2.0**19)) for _ in range(4)], rng.randint(0, 2)) for i in range(301)]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert max(r[4] for r in want) > 1 << 53
    assert made(N.negatives_digest(frame)) == want
    monkeypatch.setattr(N, "BROADCAST_BYTES", 0)
    assert made(N.negatives_digest(frame)) == want


def test_feasible_ranges_prune_and_lose_nothing():
    """Rows outside the candidates can't reach the score, and clustered rows are pruned."""
    rng = np.random.default_rng(1)
    X = (rng.normal(size=(600, 8)) * 100).astype(np.int64)
    X[:300, 0] += 3000
    order = np.argsort(N._unit(X), axis=0, kind="stable").T.astype(np.int32)
    part = {"n": 600, "high": float(np.sqrt((X.astype(float) ** 2).sum(axis=1)).max()), "bounds": b"", "x": X.tobytes(), "sorted_rows": order.tobytes()}
    part |= {c: np.arange(600).tobytes() for c in ("keys", "ids", "labels")}
    block = N._Packed(part, 8)
    Q = (rng.normal(size=(40, 8)) * 100).astype(np.int64)
    Q[:20, 1] += 2500
    asked = N._Packed(part | {"n": 40, "x": Q.tobytes(), "sorted_rows": b""} | {c: np.arange(40).tobytes() for c in ("keys", "ids", "labels")}, 8)
    lengths = np.sqrt((Q.astype(float) ** 2).sum(axis=1))
    focus = np.argsort(-np.abs(asked.unit), axis=1, kind="stable")[:, :3]
    S = Q @ X.T
    pruned = 0
    for share in (0.2, 0.5, 0.8, 0.95):
        need = (lengths * block.high * share).astype(np.int64)
        wide, narrow = N._candidates(asked, lengths, focus, block, need, np.arange(40))
        rows = dict(narrow)
        pruned += sum(len(r) < 150 for r in rows.values())
        for a in range(40):
            reach = set(np.flatnonzero(S[a] >= need[a]).tolist())
            assert a in wide or reach <= set(rows.get(a, np.array([], int)).tolist())
    assert pruned > 20
