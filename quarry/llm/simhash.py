"""SimHash near-duplicates by multi-index hashing (operator 4).

Fingerprint: text with ASCII ``A-Z`` lower-cased, words ``[^\\x20\\x09-\\x0D]+``,
shingles of ``k`` words joined by a space (fewer words: the whole sequence),
each hashed by XXH64 (seed 42); a bit is set if it is set in over half of the
hashes. A text without words has fingerprint zero, linked like any other.

Links: fingerprints that differ in at most ``r`` bits. The 64 bits are cut in
two segments; by the pigeonhole principle two linked fingerprints differ in at
most ``r // 2`` bits of one of them. Every fingerprint is entered in one table
per segment under that segment's value, and looks up the whole Hamming ball of
radius ``r // 2`` around its own value; the matches are verified on all 64 bits.

Only distinct fingerprints are linked, so copies cost nothing. A segment value
shared by very many different fingerprints (one template, lightly edited) is
not joined pair by pair: its members are dealt out again by the other segment,
cut in nibbles. With at most ``d`` differing bits there, at least ``8 - d``
nibbles agree, so each choice of that many nibbles makes small groups of
provably bounded size; each group gives a spanning set of its links, not all.
Components are then closed over the whole corpus by star contraction.

Defined cases: null texts count as empty; documents without id keep their row
but can't be a component's id (null if all of it lack one); repeated rows each
get a row; an empty table gives no rows; other columns aren't looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import join_small
from .components import connected_components, written
from .texts import free_name, small_batches, utf8

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Different fingerprints under one segment value that are joined directly.
DENSE = 128
_BITS = np.array([[(v >> b) & 1 for b in range(8)] for v in range(256)], np.int64)


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of one text (unsigned)."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = len(words) - shingle + 1
    if n <= 1:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    else:
        joined = memoryview(b" ".join(words))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[: n - 1].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter([digest(joined[s:e], seed) for s, e in zip(starts, (ends[shingle - 1 :] - 1).tolist())], np.uint64, n)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    value = 0
    for k in range(8):
        ones = np.bincount(octets[:, k], minlength=256) @ _BITS
        for b in np.flatnonzero(2 * ones > len(hashes)).tolist():
            value |= 1 << (8 * k + b)
    return value


def fingerprint(text: Column | str, shingle: int = SHINGLE) -> Column:
    """Fingerprints of a text column, as signed 64-bit integers."""

    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint_of(t, shingle) for t in utf8(texts)], np.uint64)
        return pa.array(values.view(np.int64))

    return simhash(F.col(text) if isinstance(text, str) else text)


def _segments() -> list[tuple[Column, Column]]:
    """(segment value, other segment's value) for both 32-bit segments."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    return [(high, low), (low, high)]


def _balls(radius: int) -> list[int]:
    return [sum(1 << b for b in c) for d in range(radius + 1) for c in combinations(range(32), d)]


def spanning_links(fps: np.ndarray, entry: np.ndarray, r: int) -> list[tuple[int, int]]:
    """Within one group of unsigned fingerprints: links that connect whatever
    the entries link to, at most one for each fingerprint."""
    table, looks = np.unique(fps[entry]), np.unique(fps)
    parent = {x: x for x in looks.tolist()}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a in table.tolist():
        for b in looks[np.bitwise_count(looks ^ np.uint64(a)) <= r].tolist():
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((a, b))
    return out


def _group_links(r: int):
    """Rows ``(s, v, mask, part, fp, entry)`` sorted by their first four
    columns to the spanning links of each group; a group is held until it ends."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def links(cols, starts, ends):
            out = []
            for lo, hi in zip(starts, ends):
                if hi - lo > 1 and cols[5][lo:hi].any():
                    out += spanning_links(cols[4][lo:hi].view(np.uint64), cols[5][lo:hi], r)
            pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.record_batch([pa.array(np.ascontiguousarray(pairs[:, k])) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols = [c.astype(bool) if k == 5 else np.ascontiguousarray(c, np.int64) for k, c in enumerate(cols)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:4]])) + 1
            starts = [0, *change.tolist()]
            yield links(cols, starts[:-1], starts[1:])
            held = [c[starts[-1] :] for c in cols]
        if held is not None:
            yield links(held, [0], [len(held[0])])

    return link


def link_fingerprints(fps: DataFrame, r: int = DISTANCE, dense: int = DENSE) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` whose closure
    equals that of all pairs at ``r`` or fewer differing bits."""
    radius = r // 2
    sides = _segments()
    entries = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(s).alias("s"), own.alias("v")) for s, (own, _) in enumerate(sides)])).alias("x")).select("x.s", "x.v", "fp")
    entries = written(entries, "segments")
    crowded = written(entries.groupBy("s", "v").count().where(F.col("count") > dense).select("s", "v"), "crowded")
    flips = F.array(*[F.lit(f).cast("bigint") for f in _balls(radius)])
    looks = entries.select("s", F.explode(flips).alias("flip"), F.col("v").alias("own"), "fp").select(
        "s", F.col("own").bitwiseXOR(F.col("flip")).alias("v"), F.col("fp").alias("look"), "flip"
    ).where("flip >= 0")
    # of two fingerprints each of which would find the other, the smaller segment (or fingerprint) looks
    looks = looks.where((F.col("flip") == 0) | (F.col("v") > F.col("v").bitwiseXOR(F.col("flip"))))
    thin = entries.join(crowded, ["s", "v"], "left_anti")
    pairs = looks.join(thin, ["s", "v"]).where(
        (F.bit_count(F.col("look").bitwiseXOR(F.col("fp"))) <= r) & ((F.col("flip") != 0) | (F.col("look") < F.col("fp")))
    ).select(F.col("look").alias("a"), F.col("fp").alias("b"))

    # crowded segment values: members and lookers, dealt out by nibbles of the other segment
    full = entries.select("s", F.explode(flips).alias("flip"), F.col("v").alias("own"), "fp").select(
        "s", F.col("own").bitwiseXOR(F.col("flip")).alias("v"), "fp", "flip"
    ).join(crowded, ["s", "v"])
    other = F.when(F.col("s") == 0, sides[0][1]).otherwise(sides[1][1])
    masks = [sum(0xF << (4 * i) for i in c) for c in combinations(range(8), 8 - r)]
    dealt = full.select(
        "s", "v", "fp", (F.col("flip") == 0).alias("entry"), other.alias("o"),
        F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks])).alias("mask"),
    ).select("s", "v", "mask", F.col("o").bitwiseAND(F.col("mask")).alias("part"), "fp", "entry")
    group = ["s", "v", "mask", "part"]
    spans = dealt.select(*group, "fp", "entry").repartition(*group).sortWithinPartitions(*group).mapInArrow(_group_links(r), "a bigint, b bigint")
    return pairs.union(spans)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, r: int = DISTANCE, dense: int = DENSE,
) -> DataFrame:
    """``(id_col, fp, component_id)`` for every row: the smallest id reachable
    through fingerprints that differ in at most ``r`` bits."""
    small_batches(docs.sparkSession)
    marked = written(docs.select(F.col(id_col).alias("id"), fingerprint(text_col, shingle).alias("fp")), "fingerprints")
    least = written(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = connected_components(link_fingerprints(least.select("fp"), r, dense))
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "roots")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = written(rooted.join(ids, "root").select("fp", "component_id"), "classes")
    return marked.join(by_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def near_duplicate_digest(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, r: int = DISTANCE) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: that with the
    smallest id (rows that repeat that id stay with it). Rows without id stay:
    nothing names them as a copy."""
    found = near_duplicates(docs, id_col, text_col, shingle, r)
    name = free_name(docs, "kept_id")
    keep = found.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias(name)).distinct()
    joined = join_small(docs, written(keep, "kept"), docs[id_col] == F.col(name), "left")
    return joined.where(F.col(name).isNotNull() | docs[id_col].isNull()).select(*[docs[c] for c in docs.columns])
