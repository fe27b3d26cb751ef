"""Language identification with spans, learned from labelled documents.

Words are runs of letters of one script (cut every ``WORD_LETTERS`` letters).
The code-point range of a word's first letter names its script, and only
languages that write a share of their letters in that script are candidates for
the word (all, if no language does). A word's score under a language is the sum
of the log-probabilities of its two- and three-letter runs, its ending and the
whole word, each hashed to a slot of one table; a language's own frequencies are
mixed with those of all languages, so a run seen in no document says nothing.

Viterbi's best path over a text's words, where a change of language costs
``SWITCH``, labels the spans. Where no stretch of words could pay for leaving the
best single language (checked by sums over the words) that language is the path;
other texts go through the recurrence, many texts a step. A text's language is
the one with the most letters in its spans.

Learning counts all labelled documents: tasks add up their share of the table,
Spark sums the slots. The table has at most ``TABLE`` places whatever the input,
which bounds what reaches the driver and the tasks.

Defined cases: a text that is null, empty or without a letter has no span,
language ``und`` and score 0, and so has every text if nothing was learned.
Documents without text or language aren't learned from, nor are languages whose
texts hold no letter; repeated rows count as often as they come. Ties go to the
language that comes first by name. A taken default column name is lengthened by
underscores. More than ``LANGUAGES`` different labels are an error.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scoped_conf
from .components import written
from .texts import BATCH_ROWS, chunks, free_name, utf8

#: Places of the score table (slots times languages), and slots at most.
TABLE = 1 << 23
SLOTS = 1 << 18
#: Different labels at most.
LANGUAGES = 1024
#: Letters of a word at most; longer runs are several words.
WORD_LETTERS = 64
#: Share of its letters a language must write in a script to be a candidate there.
SCRIPT_SHARE = 0.001
#: Share of all languages' frequencies in each one's own.
MIX = 0.02
#: Letter runs overlap, so their summed scores are scaled down.
TEMPER = 0.5
#: Cost of a change of language between two words.
SWITCH = 10.0
#: Score of a language that isn't a candidate.
_RULED_OUT = -1e4
#: Values held at once while words are scored.
_SCORES = 1 << 22

UNKNOWN = "und"

# Code-point ranges of scripts (Unicode).
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x531, 0x58F)],
    "hebrew": [(0x591, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "tibetan": [(0xF00, 0xFFF)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "ethiopic": [(0x1200, 0x137F)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
_OTHER, _ANY = len(SCRIPTS), 255  # letters of no listed script; marks, which go with the letter before
_LIMIT = 0x323B0


@functools.lru_cache(1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case form (0: no letter or mark) and script of each code point, built from Python's own tables."""
    lower, script = np.zeros(_LIMIT, np.uint64), np.full(_LIMIT, _OTHER, np.uint8)
    for i, ranges in enumerate(SCRIPTS.values()):
        for a, z in ranges:
            script[a : z + 1] = i
    for c in range(_LIMIT - 1):  # the last place stands for all code points beyond
        if 0xD800 <= c < 0xE000:
            continue
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            small = chr(c).lower()
            lower[c] = ord(small) if len(small) == 1 else c
        elif kind == "M":
            lower[c], script[c] = c, _ANY
    return lower, script


@dataclass
class _Words:
    """The words of some texts: where they lie, and what they are made of."""

    doc: np.ndarray      # text of each word
    start: np.ndarray    # first code point, in the text
    length: np.ndarray   # letters
    script: np.ndarray
    first: np.ndarray    # index of the word's first letter among all letters
    pairs: np.ndarray    # hash of the letter and the one before, of each letter
    triples: np.ndarray
    ends: np.ndarray     # hash of the last two letters of each word
    whole: np.ndarray    # hash of each word


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(1)
def _powers() -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(WORD_LETTERS, 1_000_003, np.uint64)]))


def split_words(texts: list[bytes | None]) -> _Words:
    """The words of whole texts (UTF-8; null as empty)."""
    lower, script = _characters()
    parts = [t.decode("utf-8", "replace") if t else "" for t in texts]
    points = np.frombuffer("\n".join([*parts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.cumsum([0, *(len(p) + 1 for p in parts)])
    points = np.minimum(points, _LIMIT - 1)
    C, S = lower[points], script[points]
    letter = C != 0
    after = np.concatenate([[False], letter[:-1]])
    before_s = np.concatenate([[_ANY], S[:-1]]).astype(np.uint8)
    new = letter & (~after | ((S != before_s) & (S != _ANY) & (before_s != _ANY)))
    at = np.arange(len(C))
    begun = np.maximum.accumulate(np.where(new, at, -1))
    new |= letter & ((at - begun) % WORD_LETTERS == 0)
    begun = np.maximum.accumulate(np.where(new, at, -1))
    inside = np.flatnonzero(letter)
    c, place = C[inside], (at - begun)[inside]
    one = np.where(place >= 1, np.concatenate([[0], C[:-1]]).astype(np.uint64)[inside], np.uint64(0))
    two = np.where(place >= 2, np.concatenate([[0, 0], C[:-2]]).astype(np.uint64)[inside], np.uint64(0))
    first = np.flatnonzero(place == 0)
    last = np.concatenate([first[1:], [len(inside)]]) - 1 if len(first) else first
    start = inside[first]
    doc = np.searchsorted(bounds, start, side="right") - 1
    k21, k42, k63 = np.uint64(21), np.uint64(42), np.uint64(1 << 63)
    weight = _powers()[place]
    whole = np.add.reduceat(c * weight, first) if len(first) else np.zeros(0, np.uint64)
    return _Words(
        doc, start - bounds[doc], last - first + 1, S[start], first,
        (one << k21 | c | k63) * _FACTOR, (two << k42 | one << k21 | c) * _FACTOR,
        (one[last] << k42 | c[last] << k21 | k63 >> np.uint64(1)) * _FACTOR, (whole + k63) * _FACTOR,
    )


def _slots(hashes: np.ndarray, n_slots: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - (n_slots.bit_length() - 1))).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """Learned languages (by name), scores of each slot, start scores, and candidates of each script."""

    names: tuple[str, ...]
    scores: np.ndarray       # slots x languages, the best language of a slot at 0
    start: np.ndarray
    candidates: np.ndarray   # scripts x languages

    def word_scores(self, words: _Words) -> np.ndarray:
        """Words x languages; languages that a word's script rules out stand far below."""
        n, k = len(words.first), len(self.names)
        out = np.empty((n, k))
        n_slots = len(self.scores)
        step = max(1, _SCORES // k // 8)
        ends = np.concatenate([words.first[1:], [len(words.pairs)]]) if n else words.first
        at = 0
        while at < n:  # runs of words of about `step` letters
            to = max(at + 1, int(np.searchsorted(ends, words.first[at] + step, side="right")))
            a, z = words.first[at], ends[to - 1]
            each = self.scores[_slots(words.pairs[a:z], n_slots)]
            each += self.scores[_slots(words.triples[a:z], n_slots)]
            out[at:to] = np.add.reduceat(each, words.first[at:to] - a, axis=0)
            out[at:to] += self.scores[_slots(words.ends[at:to], n_slots)]
            out[at:to] += self.scores[_slots(words.whole[at:to], n_slots)]
            at = to
        out *= TEMPER
        allowed = self.candidates[np.minimum(words.script, _OTHER)]
        out[~allowed] = _RULED_OUT
        return out


def best_paths(scores: np.ndarray, start: np.ndarray, texts: list[tuple[int, int]], switch: float = SWITCH) -> np.ndarray:
    """The best language of each word: Viterbi within each text's range of words."""
    path = np.zeros(len(scores), np.int64)
    if scores.shape[1] < 2:
        return path
    hard = []
    for a, z in texts:
        if a == z:
            continue
        E = scores[a:z]
        total = E.sum(axis=0) + start
        best = int(total.argmax())
        gain = np.delete(E, best, axis=1).max(axis=1) - E[:, best]  # of any other language, word by word
        gain[0] += np.delete(start, best).max() - start[best]
        G = np.concatenate([[0.0], np.cumsum(gain)])
        low = np.minimum.accumulate(G)
        if G.max() <= switch and G[-1] - low[-1] <= switch and (G - low).max() <= 2 * switch:
            path[a:z] = best
        else:
            hard.append((a, z))
    if hard:
        _recurrence(scores, start, sorted(hard, key=lambda r: r[0] - r[1]), switch, path)
    return path


def _recurrence(scores: np.ndarray, start: np.ndarray, texts: list[tuple[int, int]], switch: float, path: np.ndarray) -> None:
    """Viterbi's recurrence for texts sorted by falling length, one word of every text a step."""
    begin, size = np.array([a for a, _ in texts]), np.array([z - a for a, z in texts])
    V = scores[begin] + start
    came = np.zeros(scores.shape, np.int16)
    own = np.arange(scores.shape[1])
    for t in range(1, int(size[0])):
        live = int(np.searchsorted(-size, -t, side="left"))
        top = V[:live].argmax(axis=1)
        moved = V[np.arange(live), top][:, None] - switch
        came[begin[:live] + t] = np.where(moved > V[:live], top[:, None], own)
        V[:live] = np.maximum(V[:live], moved) + scores[begin[:live] + t]
    now = V.argmax(axis=1)
    for t in range(int(size[0]) - 1, -1, -1):
        live = int(np.searchsorted(-size, -t, side="left"))
        path[begin[:live] + t] = now[:live]
        now[:live] = came[begin[:live] + t, now[:live]] if t else now[:live]


def _doc_ranges(doc: np.ndarray, n: int) -> list[tuple[int, int]]:
    edges = np.searchsorted(doc, np.arange(n + 1))
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def label_texts(texts: list[bytes | None], model: LanguageModel) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """Language, score and spans (code points, end exclusive) of each text."""
    words = split_words(texts)
    ranges = _doc_ranges(words.doc, len(texts))
    if not model.names:
        return [(UNKNOWN, 0.0, [])] * len(texts)
    scores = model.word_scores(words)
    path = best_paths(scores, model.start, ranges)
    out = []
    for a, z in ranges:
        if a == z:
            out.append((UNKNOWN, 0.0, []))
            continue
        p, length = path[a:z], words.length[a:z]
        letters = np.bincount(p, weights=length, minlength=len(model.names))
        best = int(letters.argmax())
        total = scores[a:z][p == best].sum(axis=0) + model.start  # over the spans of that language
        chance = 1.0 / np.exp(np.minimum(total - total[best], 700.0)).sum()
        cut = np.flatnonzero(np.diff(p)) + 1
        firsts, lasts = np.concatenate([[0], cut]), np.concatenate([cut, [z - a]]) - 1
        begins, ends = words.start[a:z][firsts], (words.start[a:z] + length)[lasts]
        spans = [(int(s), int(e), model.names[i]) for s, e, i in zip(begins, ends, p[firsts])]
        out.append((model.names[best], float(min(1.0, chance * letters[best] / letters.sum())), spans))
    return out


def _count_slots(names: list[str], n_slots: int):
    """mapInArrow body over ``(text, lang)``: counts by slot and language, and of
    letters by script and language, sent on once when the task ends."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(names)
        code = {n: i for i, n in enumerate(names)}
        counts = np.zeros(n_slots * k, np.int64)
        scripts = np.zeros((_OTHER + 1) * k, np.int64)
        for batch in batches:
            langs = batch.column(1).to_pylist()
            at = 0
            for texts in chunks(utf8(batch.column(0))):
                words = split_words(texts)
                lang = np.array([code[x] for x in langs[at : at + len(texts)]], np.int64)[words.doc]
                at += len(texts)
                of_letter = np.repeat(lang, words.length)
                for hashes, of in ((words.pairs, of_letter), (words.triples, of_letter), (words.ends, lang), (words.whole, lang)):
                    counts += np.bincount(_slots(hashes, n_slots) * k + of, minlength=len(counts))
                found = np.bincount(np.minimum(words.script, _OTHER).astype(np.int64) * k + lang, weights=words.length, minlength=len(scripts))
                scripts += found.astype(np.int64)
        both = np.concatenate([counts, scripts])
        filled = np.flatnonzero(both)
        for a in range(0, len(filled), 1 << 16):
            part = filled[a : a + (1 << 16)]
            yield pa.record_batch([pa.array(part), pa.array(both[part])], names=["place", "n"])

    return fn


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from every document with a text and a language."""
    spark = docs.sparkSession
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col), F.col(lang_col).cast("string"))
    known = known.toDF("text", "lang")
    found = known.groupBy("lang").count().orderBy("lang").limit(LANGUAGES + 1).collect()
    if len(found) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} different languages")
    names = sorted(r["lang"] for r in found)
    k = len(names)
    if not k:
        return LanguageModel((), np.zeros((2, 0), np.float32), np.zeros(0), np.zeros((_OTHER + 1, 0), bool))
    n_slots = min(SLOTS, 1 << ((TABLE // k).bit_length() - 1))
    with scoped_conf(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)):
        counted = known.mapInArrow(_count_slots(names, n_slots), "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(n_slots * k + (_OTHER + 1) * k, np.float64)
    total[counted.column("place").to_numpy()] = counted.column("n").to_numpy()
    counts, scripts = total[: n_slots * k].reshape(n_slots, k), total[n_slots * k :].reshape(_OTHER + 1, k)
    lettered = np.flatnonzero(scripts.sum(axis=0) > 0)  # a language without a letter can't be told
    names, counts, scripts = [names[i] for i in lettered], counts[:, lettered], scripts[:, lettered]
    docs_of = {r["lang"]: r["count"] for r in found}
    if not names:
        return LanguageModel((), np.zeros((2, 0), np.float32), np.zeros(0), np.zeros((_OTHER + 1, 0), bool))
    share = counts / counts.sum(axis=0)
    scores = np.log((1 - MIX) * share + MIX * (share.mean(axis=1, keepdims=True) + 1.0 / n_slots))
    scores -= scores.max(axis=1, keepdims=True)
    n = np.array([docs_of[x] for x in names], np.float64)
    allowed = scripts / scripts.sum(axis=0) >= SCRIPT_SHARE
    allowed[~allowed.any(axis=1)] = True
    return LanguageModel(tuple(names), scores.astype(np.float32), np.log(n / n.sum()), allowed)


_LABELLED = "struct<lang: string, score: double, spans: array<struct<start: int, end: int, lang: string>>>"


def labeller(spark, model: LanguageModel):
    """The model as a function of a text column: language, score and spans."""
    shipped = spark.sparkContext.broadcast(model)  # at most TABLE places
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])

    @F.arrow_udf(_LABELLED)
    def label(texts: pa.Array) -> pa.Array:
        rows = []
        for part in chunks(utf8(texts)):
            for lang, score, spans in label_texts(part, shipped.value):
                rows.append({"lang": lang, "score": score, "spans": [{"start": s, "end": e, "lang": x} for s, e, x in spans]})
        return pa.array(rows, kind)

    return label


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "lang_score", spans_col: str = "lang_spans") -> DataFrame:
    """``docs`` with each whole text's language, score and spans. The result is
    written to the shared folder, in small Arrow batches whatever the session's setting."""
    spark = docs.sparkSession
    label = labeller(spark, model)
    out = docs
    names = []
    for name in (lang_col, score_col, spans_col):
        names.append(free_name(out, name))
        out = out.withColumn(names[-1], F.lit(0))
    held = free_name(out, "labelled")
    done = docs.withColumn(held, label(F.col(text_col)))
    parts = [F.col(f"{held}.{f}").alias(n) for f, n in zip(("lang", "score", "spans"), names)]
    with scoped_conf(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)):
        return written(done.select(*[F.col(f"`{c}`") for c in docs.columns], *parts), "languages")


def held_out(id_col: Column) -> Column:
    """Whether a document is kept out of learning: crc32 of its id as text is 2 mod 4 (null: false)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_digest(docs: DataFrame) -> DataFrame:
    """One row per document; learned from the documents that aren't held out.
    A document without id is neither held out nor learned from."""
    docs = docs.select("doc_id", "text", "lang")
    model = fit_languages(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    label = labeller(docs.sparkSession, model)
    done = docs.select("doc_id", label("text").alias("l"))
    rows = done.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("l.lang").alias("lang_pred"), F.col("l.score").alias("score"))
    with scoped_conf(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)):
        return written(rows, "languages")
