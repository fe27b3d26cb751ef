"""Graphs as numbered nodes and packed blocks of edges.

A graph's nodes are numbered once: a node's number is its block and its place in
the block (32 bits each), with its out-degree beside it, in a table in the shared
folder. The edges, as pairs of numbers, are packed by the block of their source
into compressed sparse rows, one table row a part. A block with more edges than a
part should hold (a hub's) is spread over several parts by the edges' targets.

A value per node then travels as arrays: every part adds up, for each target it
reaches, the shares of its sources (``np.bincount``), and sends each block one
row of places and sums. A part meets the sums for its own block in a cogroup on
its key, so a round moves these rows and nothing else; the parts stay where they
are. Keys are chosen so that every hash partition gets exactly one part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_BYTES, drop_path, persist, scoped_conf, scratch_path

_LOW = (1 << 32) - 1

#: Edges that a task deals to the parts at once.
RUN_EDGES = 1 << 20

#: What one part sends to a block: steps between the places in the block, and the sum for each, squeezed.
SUMS = "key bigint, block bigint, places binary, sums binary"
_RUN = "key bigint, src binary, n_edges binary, degree binary, dst binary"
_RUN_TYPES = [pa.int64(), *[pa.binary()] * 4]
_PART = "key bigint, src binary, n_edges binary, degree binary, dst binary, place binary"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` hash partitions a number that Spark puts there."""
    if n == 1:
        return [0]
    pool = n * (math.ceil(math.log(n + 1)) + 12)
    while True:
        part = F.pmod(F.hash(F.col("id")), F.lit(n))
        rows = spark.range(0, pool, 1, 1).groupBy(part.alias("part")).agg(F.min("id").alias("id")).collect()
        if len(rows) == n:
            return [r["id"] for r in sorted(rows, key=lambda r: r["part"])]
        pool *= 2


@dataclass
class BlockedGraph:
    """Numbered nodes ``(node, id, degree)`` and packed parts of edges.

    ``part_keys`` names the parts of each block that has out-links."""

    nodes: DataFrame
    paths: list[str]       # the node table, and the numbered edges if they were written
    small: bool            # whether the node table may be broadcast: its bytes are counted
    parts: DataFrame
    n_parts: int
    part_keys: dict[int, list[int]]

    def release(self) -> None:
        self.parts.unpersist()
        for path in self.paths:
            drop_path(self.nodes.sparkSession, path)

    def node_side(self, frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if self.small else frame


def _numbered(edges: DataFrame, n_blocks: int) -> tuple[DataFrame, str]:
    """The node table, written once so that numbers never change."""
    spark = edges.sparkSession
    ends = F.array(F.struct(F.col("src").alias("node"), F.lit(1).alias("out")), F.struct(F.col("dst").alias("node"), F.lit(0).alias("out")))
    nodes = edges.select(F.explode(ends).alias("e")).groupBy("e.node").agg(F.sum("e.out").alias("degree"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    number = F.shiftleft(F.spark_partition_id().cast("bigint"), 32).bitwiseOR(place)
    path = scratch_path(spark, "nodes")
    with scoped_conf(spark, "spark.sql.shuffle.partitions", str(n_blocks), spark__sql__adaptive__enabled="false"):
        nodes.select("node", number.alias("id"), "degree").write.parquet(path)
    return spark.read.schema("node string, id bigint, degree bigint").parquet(path), path


def _squeezed(values: np.ndarray) -> bytes:
    """The numbers as planes of their bytes, those of one rank side by side, compressed."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _spread(data: bytes, kind: type) -> np.ndarray:
    """What :func:`_squeezed` was given."""
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(data[8:], n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).reshape(-1).view(kind)


def _steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: rows of edges ``(key, sid, did, degree)`` as one row a part for every run of them."""
    held: list[pa.RecordBatch] = []

    def rows() -> pa.RecordBatch:
        key, sid, did, degree = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(4))
        order = np.lexsort((did, sid, key))
        key, sid, did, degree = key[order], sid[order], did[order], degree[order]
        bounds = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
        columns: list[list] = [[], [], [], [], []]
        for a, z in zip(bounds, bounds[1:]):
            src, first, n_edges = np.unique(sid[a:z], return_index=True, return_counts=True)
            packed = _steps(src), n_edges.astype(np.int64), degree[a:z][first], did[a:z]
            for column, value in zip(columns, [int(key[a]), *map(_squeezed, packed)]):
                column.append(value)
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _RUN_TYPES)], names=_names(_RUN))

    n = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= RUN_EDGES:
            yield rows()
            held, n = [], 0
    if held:
        yield rows()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: the dealt rows of one partition, which is one part, as compressed sparse rows."""
    key, sources, counts, degrees, targets = None, [], [], [], []
    for batch in batches:
        for k, src, n_edges, degree, dst in zip(*(c.to_pylist() for c in batch.columns)):
            if key is not None and k != key:
                raise ValueError("a partition holds the edges of two parts")
            key = k
            sources.append(np.cumsum(_spread(src, np.int64)))
            counts.append(_spread(n_edges, np.int64))
            degrees.append(_spread(degree, np.int64))
            targets.append(dst)  # the long column stays compressed until it is needed
    if key is None:
        return
    src, first, at = np.unique(np.concatenate(sources), return_index=True, return_inverse=True)
    counts, degree = np.concatenate(counts), np.concatenate(degrees)[first]
    n_edges = np.zeros(len(src), np.int64)
    np.add.at(n_edges, at, counts)
    order = np.argsort(np.repeat(at.astype(np.int32), counts), kind="stable")
    did = np.concatenate([_spread(x, np.int64) for x in targets])[order]
    del targets, order
    dst, place = np.unique(did, return_inverse=True)
    columns = [src & _LOW, n_edges, degree]
    values = [[key], *[[c.tobytes()] for c in columns], [_squeezed(_steps(dst))], [place.astype(np.int32).tobytes()]]
    types = [pa.int64(), *[pa.binary()] * 5]
    yield pa.record_batch([pa.array(v, t) for v, t in zip(values, types)], names=_names(_PART))


def blocked(edges: DataFrame, partitions: int, edges_per_part: int | None = None) -> BlockedGraph:
    """Number and pack distinct edges ``(src, dst)`` without nulls.
    A part has at most about ``edges_per_part`` edges (default: twice the mean)."""
    spark = edges.sparkSession
    nodes, path = _numbered(edges, partitions)
    about = nodes.groupBy(F.shiftright("id", 32).alias("block")).agg(
        F.sum("degree").alias("edges"), F.sum(F.octet_length("node") + 64).alias("bytes")
    ).collect()  # one row a block
    small = sum(r["bytes"] for r in about) <= BROADCAST_MAX_BYTES
    side = F.broadcast if small else (lambda frame: frame)
    limit = edges_per_part or max(1, math.ceil(2 * sum(r["edges"] for r in about) / max(1, partitions)))
    chunks = {r["block"]: math.ceil(r["edges"] / limit) for r in about if r["edges"]}
    n_parts = max(1, sum(chunks.values()))
    keys = iter(even_keys(spark, n_parts))
    part_keys = {block: [next(keys) for _ in range(c)] for block, c in sorted(chunks.items())}
    table = pa.table({"block": pa.array(part_keys.keys(), pa.int64()), "keys": pa.array(part_keys.values(), pa.list_(pa.int64()))})
    dealt = F.broadcast(spark.createDataFrame(table))  # one row a block
    key = F.get("keys", F.pmod(F.xxhash64("did"), F.size("keys")).cast("int"))
    encoded = edges.join(side(nodes.select(F.col("node").alias("src"), F.col("id").alias("sid"), "degree")), "src").join(
        side(nodes.select(F.col("node").alias("dst"), F.col("id").alias("did"))), "dst"
    ).select("sid", "did", "degree")
    placed = encoded.withColumn("block", F.shiftright("sid", 32)).join(dealt, "block").select(key.alias("key"), "sid", "did", "degree")
    runs = placed.mapInArrow(_deal, _RUN)
    paths = [path]
    if not small:  # shuffle joins, whose hot keys adaptive execution splits; the packing below has a fixed plan
        paths.append(scratch_path(spark, "numbered_edges"))
        runs.write.parquet(paths[-1])
        runs = spark.read.schema(_RUN).parquet(paths[-1])
    packed = runs.repartition(n_parts, "key").mapInArrow(_pack, _PART)
    # a plan that adapts while it runs doesn't tell its partitioning beforehand, and the rounds would move the parts
    with scoped_conf(spark, "spark.sql.adaptive.enabled", "false"):
        parts = persist(packed.repartition(n_parts, "key"))
    return BlockedGraph(nodes, paths, small, parts, n_parts, part_keys)


def _sent(row: dict, values: np.ndarray | None, targets: Callable[[int], list[int]]) -> Iterator[tuple[int, int, bytes, bytes]]:
    """What a part sends: for each block it reaches the sums of its sources' shares.
    ``values`` are those of the part's own block, 0 where a node has none
    (None: every source has 1); a target that no share reaches isn't named."""
    src, n_edges, degree = (np.frombuffer(row[c], np.int64) for c in ("src", "n_edges", "degree"))
    dst = np.cumsum(_spread(row["dst"], np.int64))
    if values is None:
        own = np.ones(len(src))
    else:
        own = np.where(src < len(values), values[np.minimum(src, max(len(values) - 1, 0))], 0.0) if len(values) else np.zeros(len(src))
    sums = np.bincount(np.frombuffer(row["place"], np.int32), np.repeat(own / degree, n_edges), len(dst))
    reached = sums > 0
    dst, sums = dst[reached], sums[reached]
    blocks = dst >> 32
    edges = np.flatnonzero(np.diff(blocks)) + 1
    for a, z in zip([0, *edges.tolist()], [*edges.tolist(), len(dst)]):
        if a < z:
            keys = targets(int(blocks[a]))
            if keys:
                packed = _squeezed(_steps((dst[a:z] & _LOW).astype(np.uint32))), _squeezed(sums[a:z])
            for key in keys:
                yield key, int(blocks[a]), *packed


def _rows(sent: list[tuple[int, int, bytes, bytes]]) -> list[pa.Array]:
    key, block, places, sums = zip(*sent) if sent else ((),) * 4
    return [pa.array(key, pa.int64()), pa.array(block, pa.int64()), pa.array(places, pa.binary()), pa.array(sums, pa.binary())]


_SUM_NAMES = _names(SUMS)


def _met(table: pa.Table) -> np.ndarray:
    """Sums met for one block, by place; 0 where there is none."""
    total = np.zeros(0)
    for places, sums in zip(table.column("places"), table.column("sums")):
        at = np.cumsum(_spread(places.as_py(), np.uint32), dtype=np.uint32)
        if at[-1] >= len(total):  # places ascend
            total = np.concatenate([total, np.zeros(int(at[-1]) + 1 - len(total))])
        total[at] += _spread(sums.as_py(), np.float64)
    return total


def _targets(graph: BlockedGraph, last: bool) -> Callable[[int], list[int]]:
    keys = graph.part_keys
    return (lambda block: [block]) if last else (lambda block: keys.get(block, []))


def first_sums(graph: BlockedGraph, last: bool) -> DataFrame:
    """The sums that a value of 1 on every node with out-links sends on; with
    ``last`` each block gets them once, else every part of the block."""
    targets = _targets(graph, last)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.record_batch(_rows(list(_sent(row, None, targets))), names=_SUM_NAMES)

    return graph.parts.mapInArrow(fn, SUMS)


def next_sums(graph: BlockedGraph, sums: DataFrame, update: Callable[[np.ndarray], np.ndarray], last: bool) -> DataFrame:
    """The sums that the values ``update(sums)`` of the nodes reached send on."""
    targets = _targets(graph, last)

    def fn(part: pa.Table, met: pa.Table) -> pa.Table:
        sent = []
        if part.num_rows and met.num_rows:
            total = _met(met)
            values = np.where(total > 0, update(total), 0.0)
            for row in part.to_pylist():
                sent += _sent(row, values, targets)
        return pa.table(_rows(sent), names=_SUM_NAMES)

    return graph.parts.groupBy("key").cogroup(sums.groupBy("key")).applyInArrow(fn, SUMS)


def node_values(graph: BlockedGraph, sums: DataFrame, update: Callable[[np.ndarray], np.ndarray], name: str) -> DataFrame:
    """``(node, name)`` of the nodes reached by the sums of a last round."""

    def fn(met: pa.Table) -> pa.Table:
        total = _met(met)
        at = np.flatnonzero(total > 0)
        block = met.column("block")[0].as_py()
        return pa.table([pa.array((block << 32) | at), pa.array(update(total[at]))], names=["id", name])

    values = sums.groupBy("block").applyInArrow(fn, f"id bigint, {name} double")
    return values.join(graph.node_side(graph.nodes.select("node", "id")), "id").select("node", name)
