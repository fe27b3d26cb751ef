"""Benchmark decontamination (operator 2).

The benchmark's word n-grams go into a hash set that every task holds; each
document's token windows are looked up in it, hits are verified word by word,
and the covered words are removed, or the whole document is.

* Words: text with ASCII ``A-Z`` lower-cased, cut into runs of ASCII
  letters/digits and all characters beyond ASCII.
* Windows: every ``n`` consecutive words of an item; an item with fewer words
  (but at least one) is one window of its own length.
* Every document word inside any occurrence of a window is *hit*.

The hash set has a bound: items are packed into blocks of at most
``block_words`` words (an item longer than that is split into overlapping
pieces, so no window is lost) and each block makes one pass over the
documents, so memory does not grow with the benchmark.

Defined cases: a null text has no words (null stays null in the cleaned text);
an empty benchmark hits nothing; repeated documents each get their own row;
repeated items with one id count once; an item without id counts as id
``null``; extra columns are kept, and clashing helper names are avoided.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .texts import alnum_spans, alnum_words, chunks, free_name, small_batches, utf8

WINDOW = 10
#: Benchmark words in one broadcast block (about 80 bytes of index a word).
BLOCK_WORDS = 200_000
_RESULT = "struct<n_words:bigint,spans:array<struct<s:int,e:int>>,items:array<string>>"
_BITS = 22


class WindowIndex:
    """Hash set of a block's windows: by length, sorted 64-bit hashes with the
    window's word ids (for verification) and the items that hold it."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocab: dict[bytes, int] = {}
        found: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, words in items:
            if not words:
                continue
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1):
                found[size][tuple(ids[i : i + size])].add(item)
        self.tables = []
        for size, windows in sorted(found.items()):
            grams = np.array(list(windows), np.int32).reshape(-1, size)
            owners = [sorted(x) for x in windows.values()]
            seed = 1
            while True:  # another seed if two different windows share a hash
                values = self._values(seed)
                hashes = _roll(values[grams.ravel()].reshape(grams.shape))
                if len(np.unique(hashes)) == len(hashes):
                    break
                seed += 1
            order = np.argsort(hashes)
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[hashes >> np.uint64(64 - _BITS)] = True
            self.tables.append((size, values, hashes[order], grams[order], [owners[i] for i in order], bitmap))

    def _values(self, seed: int) -> np.ndarray:
        return np.random.default_rng(seed).integers(0, 2**64, len(self.vocab) + 1, np.uint64)

    def scan(self, texts: list[bytes | None]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """Per text: word count, disjoint word ranges that are hit, items found."""
        docs = [alnum_words(t) for t in texts]
        get = self.vocab.get
        starts, flat = [], []
        for words in docs:
            starts.append(len(flat))
            flat += [get(w, 0) for w in words]
            flat.append(0)  # no window has id 0, so none crosses documents
        ids = np.array(flat, np.int32)
        spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
        items: dict[int, set[str]] = defaultdict(set)
        begin = np.array(starts, np.int64)
        for size, values, hashes, grams, owners, bitmap in self.tables:
            if len(ids) < size:
                continue
            h = _roll_flat(values[ids], size)
            at = np.flatnonzero(bitmap[h >> np.uint64(64 - _BITS)])
            if not len(at):
                continue
            slot = np.minimum(np.searchsorted(hashes, h[at]), len(hashes) - 1)
            same = (ids[at[:, None] + np.arange(size)] == grams[slot]).all(axis=1)
            at, slot = at[same], slot[same]
            doc = np.searchsorted(begin, at, "right") - 1
            for d, i, k in zip(doc.tolist(), (at - begin[doc]).tolist(), slot.tolist()):
                spans[d].append((i, i + size))
                items[d].update(owners[k])
        return [(len(w), _merge(spans[d]) if d in spans else [], sorted(items[d]) if d in items else []) for d, w in enumerate(docs)]


def _roll(rows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        h = h * np.uint64(0x9E3779B97F4A7C15) + rows[:, k]
    return h ^ (h >> np.uint64(29))


def _roll_flat(values: np.ndarray, size: int) -> np.ndarray:
    n = len(values) - size + 1
    h = values[:n].copy()
    for k in range(1, size):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += values[k : k + n]
    return h ^ (h >> np.uint64(29))


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[list]:
    """Items as ``(id, words)`` lists of at most ``block_words`` words each."""
    rows = benchmark.select(F.col(id_col).cast("string"), F.encode(F.col(text_col), "UTF-8")).toLocalIterator()
    block: list[tuple[str, list[bytes]]] = []
    size = 0
    for item, text in rows:
        words = alnum_words(bytes(text) if text is not None else None)
        step = max(block_words - window + 1, window)
        pieces = [words[i : i + step + window - 1] for i in range(0, max(1, len(words) - window + 1), step)]
        for piece in pieces:
            if block and size + len(piece) > block_words:
                yield block
                block, size = [], 0
            block.append((item if item is not None else "null", piece))
            size += len(piece)
    yield block


def _scanner(spark, block, window):
    index = spark.sparkContext.broadcast(WindowIndex(block, window))

    @F.arrow_udf(_RESULT)
    def scan(texts: pa.Array) -> pa.Array:
        out = [x for part in chunks(utf8(texts)) for x in index.value.scan(part)]
        return pa.array(
            [{"n_words": n, "spans": [{"s": s, "e": e} for s, e in spans], "items": items} for n, spans, items in out],
            pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))), ("items", pa.list_(pa.string()))]),
        )

    return scan


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the ranges; what lies between two of a range goes too."""
    at = alnum_spans(text)
    keep, last = [], 0
    for s, e in spans:
        keep.append(text[last : at[s, 0]])
        last = at[e - 1, 1]
    return b"".join([*keep, text[last:]])


def without_spans(text: Column, spans: Column) -> Column:
    @F.arrow_udf("string")
    def strip(texts: pa.Array, found: pa.Array) -> pa.Array:
        rows = zip(utf8(texts), found.to_pylist())
        return pa.array([cut_words(t, [(x["s"], x["e"]) for x in f]) if t is not None and f else t for t, f in rows], pa.binary()).cast(pa.string())

    return strip(text, spans)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS, out_col: str = "contamination",
) -> DataFrame:
    """``docs`` with a struct column: ``n_words``, ``n_hit``, hit word ranges
    ``spans`` (disjoint, sorted) and ``items`` (ids as sorted strings)."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    out = None
    for block in _blocks(benchmark, item_id, item_text, window, block_words):
        found = _scanner(spark, block, window)(F.col(text_col))
        if out is None:
            out = docs.withColumn(out_col, found)
            continue
        name = free_name(out, "block_hits")
        merged = out.withColumn(name, found)
        both = F.array_sort(F.concat(F.col(out_col)["spans"], F.col(name)["spans"]))
        disjoint = F.aggregate(
            both, F.expr("CAST(array() AS array<struct<s:int,e:int>>)"),
            lambda acc, x: F.when(
                (F.size(acc) > 0) & (F.element_at(acc, -1)["e"] >= x["s"]),
                F.concat(
                    F.slice(acc, 1, F.size(acc) - 1),
                    F.array(F.struct(F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], x["e"]).alias("e"))),
                ),
            ).otherwise(F.concat(acc, F.array(x))),
        )
        result = F.struct(
            F.col(out_col)["n_words"].alias("n_words"), disjoint.alias("spans"),
            F.array_sort(F.array_union(F.col(out_col)["items"], F.col(name)["items"])).alias("items"),
        )
        out = cut_lineage(merged.withColumn(out_col, result).drop(name))
    hit = F.aggregate(F.col(out_col)["spans"], F.lit(0).cast("bigint"), lambda a, x: a + (x["e"] - x["s"]))
    return out.withColumn(out_col, F.col(out_col).withField("n_hit", hit))


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", text_col: str = "text", **more) -> DataFrame:
    """``docs`` without contaminated documents (``mode="documents"``) or with
    the hit spans cut out of their texts (``mode="spans"``); same columns."""
    name = free_name(docs, "contamination")
    found = find_contamination(docs, benchmark, text_col=text_col, out_col=name, **more)
    if mode == "documents":
        return found.where(F.size(F.col(name)["spans"]) == 0).select(docs.columns)
    if mode != "spans":
        raise ValueError(f"mode {mode!r}: documents or spans")
    return found.withColumn(text_col, without_spans(F.col(text_col), F.col(name)["spans"])).select(docs.columns)


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: the counts and the digest of the items found."""
    c = F.col("contamination")
    found = find_contamination(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"), F.size(c["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"), (c["n_hit"] > 0).alias("contaminated"),
    )


def brute_force(docs: list[tuple], benchmark: list[tuple], window: int = WINDOW) -> list[tuple]:
    """Plain-Python result of :func:`contamination_digest` for small inputs (tests)."""
    grams = defaultdict(set)
    for item, text in benchmark:
        w = alnum_words(text.encode() if text is not None else None)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[i : i + n])].add(str(item) if item is not None else "null")
    out = []
    for doc, text in docs:
        w = alnum_words(text.encode() if text is not None else None)
        hit, items = set(), set()
        for g, owners in grams.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit.update(range(i, i + len(g)))
                    items |= owners
        out.append((doc, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return out
