"""Substring dedup with suffix automata of reference shards (operator 9).

A window is ``WINDOW`` consecutive words (``[^\\x20\\x09-\\x0D]+``) of one
document. A word goes if a window over it also starts earlier: in a document of
smaller id, or earlier in its own. The result is exact.

One automaton of the whole corpus broadcast to every task, or each document
streamed past every shard's automaton, would be quadratic. The reference is
instead sharded so that a window can only recur within its own shard:

1. Each window has a *seed*: the ``SEED``-word run in it with the smallest hash
   (the leftmost of equals). Neighbouring windows with one seed position form a
   passage. Equal windows have equal seeds, so the seed's hash is the shard.
2. Passages equal as a whole are recognised by hash (64 bits of seed and 64 of
   passage): all but the first occurrence are removed at once, the first
   ones of a task's batch already there (so copies collapse before the shuffle).
3. Seeds left with more than one different passage are the shards whose
   passages overlap in part. Each shard's passages are streamed in document
   order through a suffix automaton of those before: wherever the matching
   statistic reaches ``WINDOW``, the span is removed; then the passage
   enters the automaton.
4. A shard of more than ``DENSE`` passages (a phrase met everywhere) is not
   gathered: its windows are grouped by their 128-bit hash instead, with
   partial minima before the shuffle.

Only passages of step 3 travel with their words, and only spans come back to
the documents.

Defined cases: null texts have no words; documents without id come after all
others; rows of equal id are told apart by their text; rows equal in both are
one document and cleaned alike; an empty table gives no rows; other columns
aren't looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import join_small
from .components import written
from .texts import chunks, small_batches, space_words, utf8

WINDOW = 20
SEED = 5
#: Passages of one seed that a task gathers (about WINDOW + 10 words each).
DENSE = 2000
_B = 0x9E3779B97F4A7C15
_B_INVERSE = pow(_B, -1, 1 << 64)
_LAST = np.int64(2**63 - 1)  # order of a missing id

_PASSAGE = "seed bigint, phash bigint, doc bigint, h bigint, pos int, start int, n int, again boolean"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def passages(docs: list[list[bytes]], window: int, seed: int) -> tuple[np.ndarray, ...]:
    """All passages of the documents: document number, seed hash, passage hash,
    seed position, first word, number of words."""
    empty = np.empty(0, np.int64)
    sizes = np.array([len(d) for d in docs], np.int64)
    if not len(sizes) or sizes.max(initial=0) < window:
        return empty, empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    words = np.fromiter(map(xxhash.xxh64_intdigest, (w for d in docs for w in d)), np.uint64, int(sizes.sum()))
    grams = np.zeros(len(words) - seed + 1, np.uint64)
    for k in range(seed):
        grams = grams * np.uint64(_B) + words[k : k + len(grams)]
    grams = _mix(grams)
    # windows are numbered by their first word; those across documents are left out below
    low = np.lib.stride_tricks.sliding_window_view(grams, window - seed + 1).argmin(axis=1) + np.arange(len(words) - window + 1)
    owner = np.repeat(np.arange(len(docs)), sizes)
    inside = owner[: len(low)] == owner[window - 1 :]
    at = np.flatnonzero(inside)
    low = low[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(at)) - 1
    s, e, p = at[first], at[last] + window, low[first]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(_B, len(words)), dtype=np.uint64)])
    whole = (sums[e] - sums[s]) * _powers(_B_INVERSE, len(words) + 1)[s]
    whole = _mix(whole ^ _mix(((p - s) * 4096 + (e - s)).astype(np.uint64)))
    begin = np.cumsum(sizes) - sizes
    d = owner[s]
    return d, grams[p], whole, p - begin[d], s - begin[d], e - s


def _mark(window: int, seed: int):
    """Batches of documents to their passages; repeats within a run of texts are marked ``again``."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs, texts = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False), utf8(batch.column(2))
            order = np.array(ids.fill_null(int(_LAST)).to_numpy(zero_copy_only=False), np.int64)
            done = 0
            for run in chunks(texts):
                d, seeds, whole, pos, start, n = passages([space_words(t) for t in run], window, seed)
                d = d + done
                done += len(run)
                doc, h = order[d], hs[d]
                by = np.lexsort((pos, h, doc, whole, seeds))
                same = np.zeros(len(by), bool)
                same[1:] = (seeds[by[1:]] == seeds[by[:-1]]) & (whole[by[1:]] == whole[by[:-1]])
                head = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))] if len(by) else by
                again = np.zeros(len(by), bool)
                again[by] = (doc[by] != doc[head]) | (h[by] != h[head]) | (pos[by] != pos[head])
                # a repeat needs no shard: any will do, so they are spread by document
                seeds = np.where(again, _mix((h ^ pos).view(np.uint64)), seeds)
                yield pa.record_batch(
                    [pa.array(x) for x in (seeds.view(np.int64), whole.view(np.int64), doc, h, pos.astype(np.int32), start.astype(np.int32), n.astype(np.int32), again)],
                    names=["seed", "phash", "doc", "h", "pos", "start", "n", "again"],
                )

    return mark


def _sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted passages to spans: ``gone`` (an equal passage starts earlier) or
    to be compared (the seed has another passage); the others aren't passed on."""
    names = ["seed", "phash", "doc", "h", "pos", "start", "n", "again"]
    held = {k: np.empty(0, np.int64) for k in names}  # the last first occurrence, whose seed may go on

    def out(rows, gone):
        cols = [rows["seed"], rows["doc"], rows["h"], *(rows[k].astype(np.int32) for k in ("pos", "start", "n"))]
        return pa.record_batch([*map(pa.array, cols), pa.array(np.full(len(rows["seed"]), gone))], names=["seed", "doc", "h", "pos", "start", "n", "gone"])

    head = None  # seed, passage and occurrence that the running group began with
    paired = False  # whether the held row's seed had a passage before it
    for batch in batches:
        rows = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
        known = rows["again"].astype(bool)
        yield out({k: v[known] for k, v in rows.items()}, True)
        rows = {k: v[~known] for k, v in rows.items()}
        n = len(rows["seed"])
        if not n:
            continue
        begins = np.ones(n, bool)
        begins[1:] = (rows["seed"][1:] != rows["seed"][:-1]) | (rows["phash"][1:] != rows["phash"][:-1])
        if head is not None:
            begins[0] = (rows["seed"][0], rows["phash"][0]) != head[:2]
        lead = np.maximum.accumulate(np.where(begins, np.arange(n), -1))
        other = np.zeros(n, bool)
        for i, k in enumerate(("doc", "h", "pos")):
            lead_value = np.where(lead >= 0, rows[k][np.maximum(lead, 0)], head[2 + i] if head is not None else 0)
            other |= rows[k] != lead_value
        again = ~begins & other
        yield out({k: v[again] for k, v in rows.items()}, True)
        if lead[-1] >= 0:
            k = int(lead[-1])
            head = tuple(rows[c][k].item() for c in ("seed", "phash", "doc", "h", "pos"))
        firsts = {k: np.concatenate([held[k].astype(v.dtype), v[begins]]) for k, v in rows.items()}
        m = len(firsts["seed"])
        if not m:
            continue
        joined = firsts["seed"][1:] == firsts["seed"][:-1]
        shared = np.zeros(m, bool)
        shared[1:] |= joined
        shared[:-1] |= joined
        shared[0] |= paired
        yield out({k: v[:-1][shared[:-1]] for k, v in firsts.items()}, False)
        held, paired = {k: v[-1:] for k, v in firsts.items()}, bool(shared[-1])
    if paired:
        yield out(held, False)


class SuffixAutomaton:
    """Suffix automaton of several word sequences."""

    def __init__(self):
        self.length, self.link, self.next = [0], [-1], [{}]

    def _clone(self, p: int, q: int, word) -> int:
        c = len(self.length)
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.next.append(dict(self.next[q]))
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = c
            p = self.link[p]
        self.link[q] = c
        return c

    def add(self, words: list) -> None:
        last = 0
        for w in words:
            p, q = last, self.next[last].get(w)
            if q is not None:  # already there from another sequence
                last = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
                continue
            last = len(self.length)
            self.length.append(self.length[p] + 1)
            self.link.append(0)
            self.next.append({})
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = last
                p = self.link[p]
            if p >= 0:
                q = self.next[p][w]
                self.link[last] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)

    def statistics(self, words: list) -> list[int]:
        """For each word, the length of the longest match that ends with it."""
        state = size = 0
        out = []
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                size += 1
            out.append(size)
        return out


def _compare(window: int):
    """Runs of rows of one seed, in document order: spans whose windows occur before."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, automaton = None, None
        for batch in batches:
            found = []
            for seed, doc, h, start, words in zip(*(batch.column(k).to_pylist() for k in ("seed", "doc", "h", "start", "words"))):
                if seed != current:
                    current, automaton = seed, SuffixAutomaton()
                words = words.split()
                for i, size in enumerate(automaton.statistics(words)):
                    if size >= window:
                        found.append((doc, h, start + i + 1 - window, window))
                automaton.add(words)
            cols = list(zip(*found)) or [()] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["doc", "h", "start", "n"])

    return spans


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with lists of passages to rows of one passage with its words."""
    for batch in batches:
        docs, hs, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()
        found = []
        for doc, h, text, wanted in zip(docs, hs, utf8(batch.column(2)), lists):
            words = space_words(text)
            found += [(x["seed"], doc, h, x["pos"], x["start"], b" ".join(words[x["start"] : x["start"] + x["n"]])) for x in wanted]
        cols = list(zip(*found)) or [()] * 6
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=["seed", "doc", "h", "pos", "start", "words"])


def _windows(window: int):
    """Rows of one passage to rows of one window, with 128 bits of its hash."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc, h, start, words in zip(*(batch.column(k).to_pylist() for k in ("doc", "h", "start", "words"))):
                words = words.split()
                for i in range(len(words) - window + 1):
                    found.append((doc, h, start + i, xxhash.xxh128_digest(b" ".join(words[i : i + window]))))
            cols = list(zip(*found)) or [()] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=["doc", "h", "start", "w"])

    return split


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED, dense: int = DENSE) -> DataFrame:
    """``(doc, h, start, n)``: word ranges that an earlier window covers, per
    document (``doc``: its id, or the largest number; ``h``: hash of its text)."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    marked = texts.mapInArrow(_mark(window, seed), _PASSAGE)
    by_seed = marked.repartition("seed").sortWithinPartitions("seed", "phash", "doc", "h", "pos")
    sifted = written(by_seed.mapInArrow(_sift, "seed bigint, doc bigint, h bigint, pos int, start int, n int, gone boolean"), "passages")
    gone = sifted.where("gone").select("doc", "h", "start", "n")
    open_ = sifted.where("NOT gone")

    wanted = open_.groupBy("doc", "h").agg(F.collect_list(F.struct("seed", "pos", "start", "n")).alias("wanted"))
    keyed = texts.select(F.coalesce("id", F.lit(int(_LAST))).alias("doc"), "h", "text")
    held = keyed.join(wanted, ["doc", "h"]).select("doc", "h", "text", "wanted")
    cut = written(held.mapInArrow(_cut, "seed bigint, doc bigint, h bigint, pos int, start int, words binary").distinct(), "passage_words")

    # crowded seeds: at most one in ``dense`` rows; their table is broadcast if small enough
    hot = written(open_.groupBy("seed").count().where(F.col("count") > dense).select("seed"), "hot_seeds")
    few = join_small(cut, hot, "seed", "left_anti").repartition("seed").sortWithinPartitions("seed", "doc", "h", "pos")
    near = few.mapInArrow(_compare(window), "doc bigint, h bigint, start int, n int")
    each = join_small(cut, hot, "seed", "left_semi").mapInArrow(_windows(window), "doc bigint, h bigint, start int, w binary")
    each = written(each, "hot_windows")
    first = each.groupBy("w").agg(F.min(F.struct("doc", "h", "start")).alias("first"), F.count("*").alias("times")).where("times > 1")
    # both sides of the join come from tables, so a window met very often is split over tasks
    crowded = each.join(written(first, "first_windows"), "w").where(F.struct("doc", "h", "start") > F.col("first")).select("doc", "h", "start", F.lit(window).alias("n"))
    return gone.union(near).union(crowded)


def covered(n_words: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """Mask of the words inside ``(start, n)`` spans."""
    edge = np.zeros(n_words + 1, np.int64)
    for s, n in spans:
        edge[s] += 1
        edge[s + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """``(id_col, n_words, n_removed, kept)`` for every row: kept words joined by one space."""
    spans = repeated_spans(docs, id_col, text_col, **more)
    by_doc = spans.groupBy("doc", "h").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    keyed = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(_LAST))).alias("doc"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, found in zip(utf8(batch.column(1)), batch.column(2).to_pylist()):
                words = space_words(text)
                n_words.append(len(words))
                if found:
                    mask = covered(len(words), [(x["start"], x["n"]) for x in found])
                    words = [w for w, out in zip(words, mask.tolist()) if not out]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.record_batch(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=[id_col, "n_words", "n_removed", "kept"],
            )

    joined = keyed.join(by_doc, ["doc", "h"], "left").select("id", "text", "spans")
    return joined.mapInArrow(strip, f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_words bigint, n_removed bigint, kept string")


def substring_digest(docs: DataFrame) -> DataFrame:
    found = drop_repeats(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def brute_force(docs: list[tuple], window: int = WINDOW) -> list[tuple]:
    """Plain-Python result of :func:`drop_repeats` for rows of different ids (tests)."""
    import re

    first: dict[tuple[str, ...], tuple] = {}
    out = []
    for doc, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if first.setdefault(w, (doc, i)) != (doc, i):
                gone.update(range(i, i + window))
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out
