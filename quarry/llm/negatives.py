"""Hard-negative mining by inner products, with coordinate pruning.

The rows are cut into *length buckets* (norms within a factor of ``GROWTH``) of
at most ``BLOCK_ROWS`` rows. A bucket block holds its rows' whole-number vectors
and, for every coordinate, the list of its rows sorted by the value of that
coordinate in the rows' unit vectors. The index is one row a block of a Parquet
table in the shared folder.

Anchors, packed in groups alike, meet every block: a stated query set against
all rows, in blocks. With the score an anchor still has to reach in a block, and
the block's largest norm, the least cosine ``theta`` is known. A block whose
``theta`` is over 1 is skipped. Otherwise a row ``p`` can only reach it if, for a
focus coordinate f (those where the anchor ``q`` is largest), its value lies in

    cos(min(pi, a + t)) .. cos(max(0, a - t)),   a = acos(q_f), t = acos(theta)

Such a *feasible range* is a run of the sorted list of f, found by binary search;
the runs of all focus coordinates are intersected, and what is left is scored
exactly. Where the shortest run holds more than a quarter of the block, pruning
can't pay and the anchors score the whole block in one matrix product.

Two passes: the best positives of every anchor (same label), then, with the
score bounds that these set, the best negatives (other label) of every pair.
A task keeps the best few of each anchor and sends on no more than those.

Scores are exact: products of doubles while all sums stay under 2**53, of 64-bit
integers beyond; sums that don't fit 64 bits are an error.

Defined cases: rows whose id or label or vector is null, or whose vector holds
a null or non-finite component, take no part. A vector shorter than the longest
counts as filled up with zeros, an empty one as zeros alone. A row that repeats
an id is a row of its own, but no partner of the rows of that id. Rows with
equal scores go by the smaller id. No rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scoped_conf
from .components import written
from .whitening import matrix, usable

#: Rows of a block, anchors of a group, anchors scored at once.
BLOCK_ROWS = 2048
GROUP_ROWS = 512
RUN_ANCHORS = 512
#: Norms within a length bucket differ by at most this factor.
GROWTH = 1.1
#: Coordinates whose feasible ranges are intersected.
FOCUS = 3
#: Bytes of packed anchors up to which they are broadcast, after counting them.
BROADCAST_BYTES = 32 << 20

_NONE = -(1 << 62)  # a place not filled yet
_PACKED = "bucket bigint, n int, keys binary, ids binary, labels binary, x binary, bounds binary, high double, sorted_rows binary"


def whole_vector(vector: Column, scale: int) -> Column:
    """``floor(scale * c)`` of every component; values past the limit stop just past it."""
    far = 2.0**61
    return F.transform(vector, lambda c: F.floor(F.least(F.greatest(c.cast("double") * scale, F.lit(-far)), F.lit(far))).cast("bigint"))


def _pack(d: int, width: int, limit: int | None):
    """mapInArrow body over ``(bucket, key, id, label, x, bounds)`` sorted by
    bucket: runs of a bucket, of at most ``limit`` rows, as one row each. With
    a limit the run is a block and gets its sorted coordinate lists."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        bucket, size = None, 0

        def packed():
            keys, ids, labels, X, bounds = (np.concatenate(c) for c in zip(*held))
            high, order = 0.0, b""
            if limit:
                by_id = np.argsort(ids, kind="stable")
                keys, ids, labels, X, bounds = (c[by_id] for c in (keys, ids, labels, X, bounds))
                lengths = np.sqrt((X.astype(np.float64) ** 2).sum(axis=1))
                high = float(lengths.max(initial=0.0))
                order = np.argsort(_unit(X), axis=0, kind="stable").T.astype(np.int32).tobytes()
            values = [bucket, len(ids), keys.tobytes(), ids.tobytes(), labels.tobytes(), X.tobytes(), bounds.tobytes(), high, order]
            types = [pa.int64(), pa.int32(), *[pa.binary()] * 5, pa.float64(), pa.binary()]
            names = [c.split()[0] for c in _PACKED.split(", ")]
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, types)], names=names)

        for batch in batches:
            buckets, keys, ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            X, bounds = matrix(batch.column(4), d) if d else np.zeros((len(ids), 0), np.int64), matrix(batch.column(5), width) if width else np.zeros((len(ids), 0), np.int64)
            at = 0
            while at < len(ids):
                if held and (buckets[at] != bucket or limit and size >= limit):
                    yield packed()
                    held, size = [], 0
                bucket = int(buckets[at])
                end = at + int(np.searchsorted(-buckets[at:], -bucket, side="right"))
                if limit:
                    end = min(end, at + limit - size)
                held.append([keys[at:end], ids[at:end], labels[at:end], X[at:end], bounds[at:end]])
                size += end - at
                at = end
        if held:
            yield packed()

    return fn


def _unit(X: np.ndarray) -> np.ndarray:
    """Rows divided by their lengths; rows of length nil stay nil."""
    lengths = np.sqrt((X.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return X / np.where(lengths > 0, lengths, 1.0)


class _Packed:
    """A packed run of rows, as arrays."""

    def __init__(self, columns: dict, d: int, width: int = 0):
        n = columns["n"]
        self.n, self.high = n, columns["high"]
        self.keys, self.ids, self.labels = (np.frombuffer(columns[c], np.int64) for c in ("keys", "ids", "labels"))
        self.x = np.frombuffer(columns["x"], np.int64).reshape(n, d)
        self.bounds = np.frombuffer(columns["bounds"], np.int64).reshape(n, width // 2, 2)
        self.order = np.frombuffer(columns["sorted_rows"], np.int32).reshape(d, n) if columns["sorted_rows"] else None
        self.unit = _unit(self.x)


class _Best:
    """The best ``k`` (score, id) of every unit, higher scores first, then smaller ids."""

    def __init__(self, units: int, k: int):
        self.scores = np.full((units, k), _NONE, np.int64)
        self.ids = np.zeros((units, k), np.int64)

    def add(self, unit: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(unit):
            return
        k = self.scores.shape[1]
        touched = np.unique(unit)
        u = np.concatenate([np.repeat(touched, k), unit])
        s = np.concatenate([self.scores[touched].ravel(), scores])
        i = np.concatenate([self.ids[touched].ravel(), ids])
        order = np.lexsort((i, -s, u))
        u, s, i = u[order], s[order], i[order]
        place = np.arange(len(u)) - np.searchsorted(u, u)
        top = place < k
        self.scores[u[top], place[top]], self.ids[u[top], place[top]] = s[top], i[top]

    @property
    def least(self) -> np.ndarray:
        """The score a unit's next entry must at least have (``_NONE`` while it takes any)."""
        return self.scores[:, -1]


def _products(Q: np.ndarray, P: np.ndarray, small: bool) -> np.ndarray:
    """Exact integer inner products."""
    if small:
        return (Q.astype(np.float64) @ P.astype(np.float64).T).astype(np.int64)
    return Q @ P.T


def _row_best(S: np.ndarray, mask: np.ndarray, k: int, small: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(row, column)`` of the ``k`` largest masked entries of every row, ties to the smaller column."""
    n = S.shape[1]
    rows = np.flatnonzero(mask.any(axis=1))
    if not len(rows):
        return rows, rows
    if small:  # score and column in one number, so that no two are equal
        K = np.where(mask[rows], S[rows] * n + np.arange(n - 1, -1, -1), np.iinfo(np.int64).min)
        if k < n:
            K = np.partition(K, n - k, axis=1)[:, n - k :]
        r, c = np.nonzero(K != np.iinfo(np.int64).min)
        return rows[r], n - 1 - K[r, c] % n
    order = np.argsort(np.where(mask[rows], -S[rows], np.iinfo(np.int64).max), axis=1, kind="stable")[:, :k]
    r, c = np.nonzero(np.take_along_axis(mask[rows], order, axis=1))
    return rows[r], order[r, c]


def _candidates(group: _Packed, lengths: np.ndarray, focus: np.ndarray, block: _Packed, need: np.ndarray, at: np.ndarray):
    """Which of the anchors ``at`` must look at the whole block, and the candidate
    rows of those whose feasible ranges prune; ``need`` is the score to reach."""
    bound = lengths[at] * block.high
    theta = np.where(need > 0, need / np.where(bound > 0, bound, 1.0) * (1 - 1e-9) - 1e-9, -1.0)
    theta[(need > 0) & (bound <= 0)] = 2.0
    at, theta = at[theta <= 1], theta[theta <= 1]
    if not focus.shape[1]:
        return at, []
    tau = np.arccos(np.clip(theta, -1, 1))
    f = focus[at]
    angle = np.arccos(np.clip(group.unit[at[:, None], f], -1, 1))
    low = np.cos(np.minimum(np.pi, angle + tau[:, None])) - 1e-9
    high = np.cos(np.maximum(0, angle - tau[:, None])) + 1e-9
    start, stop = np.zeros_like(f), np.full_like(f, block.n)
    for c in np.unique(f):
        values = block.unit[block.order[c], c]
        here = f == c
        start[here] = np.searchsorted(values, low[here], side="left")
        stop[here] = np.searchsorted(values, high[here], side="right")
    run = stop - start
    shortest = run.argmin(axis=1)
    pick = np.arange(len(at))
    wide = (theta <= 0) | (run[pick, shortest] > block.n // 4)
    narrow = []
    for a in np.flatnonzero(~wide & (run.min(axis=1) > 0)).tolist():
        s = shortest[a]
        rows = block.order[f[a, s], start[a, s] : stop[a, s]]
        for o in range(f.shape[1]):
            if o != s:
                v = block.unit[rows, f[a, o]]
                rows = rows[(v >= low[a, o]) & (v <= high[a, o])]
        if len(rows):
            narrow.append((at[a], np.sort(rows)))
    return at[wide], narrow


def _mine(d: int, k: int, pairs: int, small: bool):
    """mapInArrow body over ``(group, block)`` pairs: the best rows of every anchor
    (``pairs = 0``: same label) or of every anchor and pair within its bounds
    (other label), sent on once when the task ends."""
    units = max(pairs, 1)

    def look(group: _Packed, lengths, focus, best: _Best, block: _Packed) -> None:
        per_unit = best.least.reshape(-1, units)
        if pairs:
            lows, highs = group.bounds[:, :, 0], group.bounds[:, :, 1]
            floors = np.maximum(lows, per_unit)
            open_ = floors <= highs
            need = np.where(open_, floors, np.iinfo(np.int64).max).min(axis=1)
            asks = np.flatnonzero(open_.any(axis=1))
        else:
            need, asks = per_unit[:, 0], np.arange(group.n)

        def take(anchors, columns, S):
            """Adds the scores ``S`` (anchors x columns of the block)."""
            labels = block.labels[columns] == group.labels[anchors][:, None]
            other = block.ids[columns] != group.ids[anchors][:, None]
            for u in range(units):
                if pairs:
                    mask = ~labels & other & (S >= floors[anchors, u][:, None]) & (S <= highs[anchors, u][:, None])
                else:
                    mask = labels & other & (S >= need[anchors][:, None])
                r, c = _row_best(S, mask, k, small)
                best.add(anchors[r] * units + u, S[r, c], block.ids[columns[c]])

        for at in range(0, len(asks), RUN_ANCHORS):
            run = asks[at : at + RUN_ANCHORS]
            wide, narrow = _candidates(group, lengths, focus, block, need[run], run)
            if len(wide):
                take(wide, np.arange(block.n), _products(group.x[wide], block.x, small))
            for a, rows in narrow:
                one = np.array([a])
                take(one, rows, _products(group.x[one], block.x[rows], small))

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}

        def results(g):
            group, _, _, best = held.pop(g)
            filled = best.scores != _NONE
            unit, _ = np.nonzero(filled)
            return pa.record_batch(
                [pa.array(group.keys[unit // units]), pa.array((unit % units).astype(np.int32)), pa.array(best.scores[filled]), pa.array(best.ids[filled])],
                names=["key", "pair", "score", "id"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                g = row["group"]["bucket"]
                if g not in held:
                    while len(held) >= 8:  # bounded: what a group has found so far is sent on
                        yield results(next(iter(held)))
                    group = _Packed(row["group"], d, 2 * pairs)
                    lengths = np.sqrt((group.x.astype(np.float64) ** 2).sum(axis=1))
                    focus = np.argsort(-np.abs(group.unit), axis=1, kind="stable")[:, :FOCUS]
                    held[g] = (group, lengths, focus, _Best(group.n * units, k))
                look(*held[g], _Packed(row["block"], d))
        for g in list(held):
            yield results(g)

    return fn


def _best_of(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of every unit over all tasks, with their rank."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _meet(groups: DataFrame, blocks: DataFrame, n_groups: int, body, name: str) -> DataFrame:
    """Runs ``body`` over every group and block. The groups are broadcast if
    their counted bytes allow it; otherwise both sides are dealt to the cells
    of a grid, so that no cell holds more than a part of either."""
    spark = groups.sparkSession
    group, block = F.struct(*groups.columns).alias("group"), F.struct(*blocks.columns).alias("block")
    size = groups.agg(F.sum(F.octet_length("x") + F.octet_length("bounds") + 24 * F.col("n"))).first()[0] or 0
    dealt = blocks.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_groups - 1).cast("bigint"))).alias("g"), block)
    if size <= BROADCAST_BYTES:
        both = dealt.join(F.broadcast(groups.select(F.col("bucket").alias("g"), group)), "g")
    else:
        parts = max(1, blocks.count() // 256)
        cell = F.pmod(F.xxhash64("block.x", "block.ids"), F.lit(parts)).cast("int")
        spread = groups.select(F.col("bucket").alias("g"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("cell"), group)
        both = dealt.withColumn("cell", cell).join(spread.hint("shuffle_hash"), ["g", "cell"])
    # rows are blocks of megabytes, so a batch is a few of them; the table is written within the setting
    with scoped_conf(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "4"):
        return written(both.select("group", "block").mapInArrow(body, "key bigint, pair int, score bigint, id bigint"), name)


def mine_hard_negatives(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``: for each row where ``anchors`` holds and each of its best
    ``positives`` other rows of the same label, the best ``negatives`` rows of
    other labels whose score is from ``low_percent`` to ``high_percent`` of the
    positive's."""
    spark = rows.sparkSession
    whole = rows.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
        whole_vector(F.col(vector_col), scale).alias("x"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    )
    whole = written(whole.withColumn("key", F.monotonically_increasing_id()), "negatives_rows")
    about = whole.agg(F.max(F.size("x")), F.max(F.array_max(F.transform("x", F.abs))), F.count_if("is_anchor"), F.count("*")).first()
    d, largest, n_anchors, n = about[0] or 0, about[1] or 0, about[2], about[3]
    if largest * largest * d >= 1 << 62:
        raise ValueError(f"components up to {largest} give scores beyond 64 bits")
    small = largest * largest * d < 1 << 51  # exact in doubles, and room for a row number beside the score
    none = F.array().cast("array<bigint>")
    x = F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(d) - F.size("x")))
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v))
    bucket = F.when(length > 0, F.ceil(F.log(length) / math.log(GROWTH))).otherwise(-1).cast("bigint")
    listed = whole.select(bucket.alias("bucket"), "key", "id", "label", x.alias("x"), none.alias("bounds"))
    # a few dozen blocks a task, and work for every core where there are blocks enough
    tasks = max(1, math.ceil(n / (32 * BLOCK_ROWS)), min(2 * spark.sparkContext.defaultParallelism, math.ceil(n / BLOCK_ROWS)))
    spread = listed.repartitionByRange(tasks, F.desc("bucket"), F.xxhash64("id", "key")).sortWithinPartitions(F.desc("bucket"), "id")
    blocks = written(spread.mapInArrow(_pack(d, 0, BLOCK_ROWS), _PACKED), "negatives_index")

    n_groups = max(1, math.ceil(n_anchors / GROUP_ROWS))
    asked = whole.where("is_anchor").select(F.pmod(F.xxhash64("key"), F.lit(n_groups)).cast("bigint").alias("bucket"), "key", "id", "label", x.alias("x"))

    def grouped(frame: DataFrame, width: int) -> DataFrame:
        dealt = frame.repartition(F.col("bucket")).sortWithinPartitions(F.desc("bucket"), "key")
        return written(dealt.mapInArrow(_pack(d, width, None), _PACKED), "negatives_anchors")

    found = _meet(grouped(asked.withColumn("bounds", none), 0), blocks, n_groups, _mine(d, positives, 0, small), "negatives_positives")
    best = _best_of(found, ["key"], positives).select("key", (F.col("rank") - 1).cast("int").alias("pair"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    best = written(best, "negatives_pairs")
    # low * p <= 100 * n <= high * p, in whole numbers of n; a pair without bounds gets none that hold
    p = F.col("positive_score")
    lowest, highest = F.ceil(p * F.lit(low_percent).cast("decimal(18,0)") / 100).cast("bigint"), F.floor(p * F.lit(high_percent).cast("decimal(18,0)") / 100).cast("bigint")
    span = F.when((p >= 0), F.array(lowest, highest)).otherwise(F.array(F.lit(1).cast("bigint"), F.lit(0).cast("bigint")))
    bounds = best.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("pair", span.alias("span")))).alias("spans"))
    filled = F.concat(F.flatten(F.transform("spans", lambda s: s["span"])), F.flatten(F.array_repeat(F.array(F.lit(1).cast("bigint"), F.lit(0).cast("bigint")), F.lit(positives) - F.size("spans"))))
    bounded = asked.join(bounds, "key").select(*asked.columns, filled.alias("bounds"))
    found = _meet(grouped(bounded, 2 * positives), blocks, n_groups, _mine(d, negatives, positives, small), "negatives_found")
    first = _best_of(found, ["key", "pair"], negatives).select("key", "pair", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = whole.where("is_anchor").select("key", F.col("id").alias("anchor_id"))
    return (
        first.join(best, ["key", "pair"]).join(names, "key")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )


def negatives_digest(rows: DataFrame) -> DataFrame:
    """Hard negatives of the anchors (ids divisible by 50); where an id is
    divisible by 7 the label counts as the next one of ten."""
    rows = rows.select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, ((F.col("label").cast("bigint") + 1) % 10)).otherwise(F.col("label").cast("bigint"))
    return mine_hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)
