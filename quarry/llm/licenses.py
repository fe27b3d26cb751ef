"""License scan by MinHash over text windows (operator 10).

Texts and templates are cut in lower-cased words and shingles of five words (a
template of fewer words is one shingle). A document holds a template if some
stretch of ``reach(m)`` shingles (``m``: the template's) has ``CONTAINMENT`` or
more of its different shingles. That is 2.5 to 7 times the template, so words
may be put into it, left out or changed.

Shingles of a document are covered by overlapping windows; a template is sought
in windows of the smallest power of two of at least ``4 m`` shingles, a quarter
of a window apart, so that each such stretch lies whole within one, whatever its
place. Every window and template has a MinHash signature; one that agrees in all
rows of a band is retrieved. Rows and bands are chosen from the least similarity
at which a window may hold the template, so that retrieval misses a window with
probability of at most ``MISS``. Retrieved templates are verified by exact
shingle containment over the whole document, word by word.

The templates are few and fixed (their total size is checked); they travel
with the tasks. Window minima are built up from minima of small blocks, so a
signature costs one pass whatever the window sizes.

Defined cases: null and empty texts hold nothing; a template found at several
places counts once per document, with its best place (ties: the first); equal templates are all
named; templates without words are left out; repeated rows each keep their
row; extra columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_texts import TEMPLATES
from .texts import alnum_words, chunks, small_batches, utf8

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-3
#: Shingles of a block, the unit of windows.
BLOCK = 4
#: Bound of the templates' words, which every task holds.
MAX_TEMPLATE_WORDS = 2_000_000


@dataclass
class Template:
    name: str
    words: list[bytes]
    width: int  # words of a shingle
    shingles: set[tuple[bytes, ...]]
    window: int  # shingles of a window
    reach: int  # shingles of the stretch that has to hold it
    hashes: np.ndarray  # of its shingles


def window_size(m: int) -> int:
    return max(2 * BLOCK, 1 << (4 * m - 1).bit_length())


def stride(window: int) -> int:
    """Shingles from one window to the next."""
    return max(BLOCK, window // 4)


def reach(m: int) -> int:
    """Shingles of the longest stretch that lies whole within a window at any place."""
    return window_size(m) - stride(window_size(m)) + 1


def least_similarity(m: int, containment: float) -> float:
    """Smallest Jaccard similarity of a template of ``m`` shingles and a window that holds that share of it."""
    shared = ceil(containment * m - 1e-9)
    return shared / (window_size(m) + m - shared)


def choose_bands(similarity: float, miss: float, max_rows: int = 4, max_hashes: int = 64) -> tuple[int, int]:
    """Rows and bands with ``(1 - s^rows)^bands <= miss``: the most rows that ``max_hashes`` allow."""
    for rows in range(max_rows, 0, -1):
        bands = ceil(log(miss) / log(1 - similarity**rows)) if similarity < 1 else 1
        if rows * bands <= max_hashes or rows == 1:
            return rows, bands
    raise AssertionError


def make_templates(texts: dict[str, str], shingle: int = SHINGLE) -> list[Template]:
    out = []
    for name, text in texts.items():
        words = alnum_words(text.encode())
        if words:
            width = min(shingle, len(words))
            grams = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
            m = len(words) - width + 1
            out.append(Template(name, words, width, grams, window_size(m), reach(m), np.unique(shingle_hashes(_word_hashes(words), width))))
    if sum(len(t.words) for t in out) > MAX_TEMPLATE_WORDS:
        raise ValueError("templates are too large to travel with the tasks; scan them in parts")
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(n: int) -> np.ndarray:
    """Odd multipliers and addends of ``n`` hash functions."""
    return np.random.default_rng(20).integers(0, 2**63, (n, 2), np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` consecutive word hashes."""
    n = max(0, len(words) - width + 1)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    return _mix(h)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


class Scanner:
    def __init__(self, templates: list[Template], containment: float = CONTAINMENT, miss: float = MISS):
        self.templates, self.containment = templates, containment
        #: (shingle width, window) -> rows, bands, per band: signature -> templates
        self.groups: dict[tuple[int, int], tuple[int, int, list[dict[bytes, list[int]]]]] = {}
        self.hashes: dict[int, int] = {}
        members: dict[tuple[int, int], list[int]] = {}
        for i, t in enumerate(templates):
            members.setdefault((t.width, t.window), []).append(i)
        for group, ids in sorted(members.items()):
            s = min(least_similarity(len(templates[i].words) - templates[i].width + 1, containment) for i in ids)
            rows, bands = choose_bands(s, miss)
            self.hashes[group[0]] = max(self.hashes.get(group[0], 0), rows * bands)
            tables: list[dict[bytes, list[int]]] = [{} for _ in range(bands)]
            keys = _keys(rows * bands)
            for i in ids:
                sig = np.array([(templates[i].hashes * a + b).min() for a, b in keys], np.uint64)
                for k in range(bands):
                    tables[k].setdefault(sig[k * rows : (k + 1) * rows].tobytes(), []).append(i)
            self.groups[group] = (rows, bands, tables)

    def _retrieve(self, docs: list[list[bytes]]) -> set[tuple[int, int]]:
        """Candidate (document, template)."""
        found: set[tuple[int, int]] = set()
        flat = [w for d in docs for w in d]
        words = _word_hashes(flat)
        ends = np.cumsum([len(d) for d in docs])
        for width in sorted(self.hashes):
            n = np.array([max(0, len(d) - width + 1) for d in docs], np.int64)
            blocks = -(-n // BLOCK)
            first = np.concatenate([[0], np.cumsum(blocks)])
            total = int(first[-1])
            if not total:
                continue
            padded = np.empty(total * BLOCK, np.uint64)
            h = shingle_hashes(words, width)
            for d in range(len(docs)):
                if n[d]:
                    start, at = int(ends[d]) - len(docs[d]), int(first[d]) * BLOCK
                    padded[at : at + n[d]] = h[start : start + n[d]]
                    padded[at + n[d] : int(first[d + 1]) * BLOCK] = h[start + n[d] - 1]  # a repeat changes no minimum
            owner = np.repeat(np.arange(len(docs)), blocks)
            windows = sorted(w for k, w in self.groups if k == width)
            place = np.arange(total) - first[owner]
            starts = {w: np.flatnonzero(place % (stride(w) // BLOCK) == 0) for w in windows}
            hits: dict[int, dict[int, list[np.ndarray]]] = {w: {} for w in windows}
            for k, (a, b) in enumerate(_keys(self.hashes[width])):
                values = (padded * a + b).reshape(-1, BLOCK).min(axis=1)
                size, level = BLOCK, values  # minima of `size` shingles from each block on
                for w in windows:
                    while size < w:
                        step = size // BLOCK
                        nxt = level.copy()
                        if step < total:
                            same = owner[step:] == owner[:-step]
                            nxt[:-step] = np.where(same, np.minimum(level[:-step], level[step:]), level[:-step])
                        level, size = nxt, size * 2
                    rows, bands, tables = self.groups[width, w]
                    if k >= rows * bands:
                        continue
                    band, row = divmod(k, rows)
                    held = hits[w].setdefault(band, [])
                    held.append(level[starts[w]])
                    if row == rows - 1:
                        sigs = np.stack(held, axis=1)
                        hits[w][band] = []
                        wanted = np.array([np.frombuffer(x, np.uint64) for x in tables[band]])
                        for x in np.flatnonzero(np.isin(sigs[:, 0], wanted[:, 0])).tolist():
                            for t in tables[band].get(sigs[x].tobytes(), ()):
                                found.add((int(owner[starts[w][x]]), t))
        return found

    def verify(self, words: list[bytes], hashes: np.ndarray, t: Template) -> tuple[float, int] | None:
        """The largest share of the template's shingles in a stretch, and where the first of
        them is (the earliest such place); None below the bound. ``hashes``: of the words."""
        near = np.flatnonzero(np.isin(shingle_hashes(hashes, t.width), t.hashes)).tolist()
        met = [(i, g) for i in near if (g := tuple(words[i : i + t.width])) in t.shingles]
        held: dict[tuple[bytes, ...], int] = {}  # shingles of the stretch that starts at a match
        best, end = (0, 0), 0
        for i, gram in met:
            while end < len(met) and met[end][0] < i + t.reach:
                held[met[end][1]] = held.get(met[end][1], 0) + 1
                end += 1
            best = min(best, (-len(held), i))
            held[gram] -= 1
            if not held[gram]:
                del held[gram]
        share = -best[0] / len(t.shingles)
        return (share, best[1]) if share >= self.containment and share else None

    def scan(self, texts: list[bytes | None]) -> list[list[tuple[str, float, int]]]:
        """Per text: (template, containment, first word) of the templates found, by name."""
        docs = [alnum_words(t) for t in texts]
        out: list[list[tuple[str, float, int]]] = [[] for _ in docs]
        hashes: dict[int, np.ndarray] = {}
        for d, t in sorted(self._retrieve(docs)):
            if d not in hashes:
                hashes = {d: _word_hashes(docs[d])}
            got = self.verify(docs[d], hashes[d], self.templates[t])
            if got is not None:
                out[d].append((self.templates[t].name, *got))
        return [sorted(x) for x in out]


_FOUND = "array<struct<license:string,containment:double,word:int>>"


def scan_column(text: Column | str, texts: dict[str, str] | None = None, containment: float = CONTAINMENT, miss: float = MISS) -> Column:
    """The licence templates found in a text column."""
    templates = make_templates(TEMPLATES if texts is None else texts)
    ready: list[Scanner] = []

    @F.arrow_udf(_FOUND)
    def scan(batch: pa.Array) -> pa.Array:
        if not ready:
            ready.append(Scanner(templates, containment, miss))
        out = [x for part in chunks(utf8(batch), 1 << 20) for x in ready[0].scan(part)]
        kind = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()), ("word", pa.int32())]))
        return pa.array([[{"license": n, "containment": c, "word": w} for n, c, w in x] for x in out], kind)

    return scan(F.col(text) if isinstance(text, str) else text)


def find_licenses(docs: DataFrame, text_col: str = "text", out_col: str = "licenses", **more) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.withColumn(out_col, scan_column(text_col, **more))


def license_digest(docs: DataFrame) -> DataFrame:
    """Per document: number of templates found, their names, and each one's containment and place."""
    x = F.col("licenses")
    found = find_licenses(docs.select("doc_id", "text"))
    return found.select(
        "doc_id", F.size(x).cast("bigint").alias("n_licenses"), F.array_join(x["license"], ",").alias("licenses"),
        F.array_join(F.transform(x, lambda l: F.concat_ws(":", F.round(l["containment"], 4), l["word"])), ",").alias("places"),
    )
