"""Byte-level BPE encoding and decoding over a prefix trie (operator 3).

A run of texts (bounded by bytes) is cut into words by Arrow and each distinct
word is encoded once. Its pieces, cut by the vocabulary's split pattern, are
sorted, which is the depth-first order of their trie: a stack holds the nodes
on the path, the nodes shared with the piece before stay, the others are pushed
in order. Every node holds one state: the *last token* of the encoding of the
prefix that ends there. Two facts about BPE make that state enough:

* the tokens before the last one are the encoding of the shorter prefix, so a
  whole encoding is read off by walking back from node to node;
* token ``t`` is the last token of a prefix iff it is a suffix of it and
  merging the bytes of (last token of the rest, ``t``) gives that pair again.

So a state is found from the states above it and the encoding of a shared
prefix is computed once for all pieces below it. Words met more than once in a
run go to a bounded memo for the worker's next runs, which ages when full; that
costs time only. The token ids are packed in the machine's order, little-endian
on all platforms that Spark's Arrow exchange supports.

Defined cases: null and empty texts have no tokens and decode to an empty
text; special tokens found in a text are taken whole, as the vocabulary file's
library does by default; repeated rows are encoded alike; no piece is too long.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .texts import gather, give_back, joined, runs, small_batches

#: Fixed value: the split pattern of the byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words (about 200 bytes each) at which a worker's memo ages, and of which lengths.
MEMO_PIECES = 100_000
MEMO_BYTES = 64
#: Token pairs whose border is remembered.
MEMO_PAIRS = 200_000
#: Bytes of text encoded and decoded at once; the ids, texts and scratch space of a run take many times that.
CODE_BYTES = 2 << 20
_MARKS = ".,;:!?"
_MODIFIERS = "\u02b0"  # below it, Python's letters are the pattern's letters
_NEVER = 1 << 60
_NONE = (_NEVER, -1)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: printable Latin-1 bytes stand for
    themselves, the others take the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieBPE:
    def __init__(self, content: str):
        spec = json.loads(content)
        to_byte = byte_alphabet()
        raw = lambda token: bytes(to_byte[c] for c in token)
        vocab = spec["model"]["vocab"]
        ids = {raw(token): i for token, i in vocab.items()}
        bytes_of = {i: t for t, i in ids.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        for text, i in self.special.items():
            bytes_of[i] = text.encode()
        by_length = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if by_length else None
        self.pattern = regex.compile(SPLIT)
        self.fits: dict[int, bool] = {}
        self.spines: tuple[dict, dict] = ({}, {})
        self.parts = {made: (a, b, rank) for (a, b), (rank, made) in reversed(self.merges.items())}
        if len([t for t in ids if len(t) == 1]) < 256:
            raise ValueError("a byte is missing from the vocabulary")
        whole = {i for i in ids.values() if i not in self.parts}  # the tokens that text can encode to
        for (a, b), (_, made) in self.merges.items():  # by rank, so parts come first
            if self.parts[made][:2] == (a, b) and a in whole and b in whole and self._meet(a, b):
                whole.add(made)
        self._automaton({t: i for t, i in ids.items() if i in whole})
        self.memo: dict[str, bytes] = {}  # words met lately, and ...
        self.older: dict[str, bytes] = {}  # ... before that
        self.text_of = [bytes_of.get(i, b"") for i in range(max(bytes_of) + 1)]
        self.width = array("i", map(len, self.text_of))
        self.text_at = np.cumsum([0, *self.width])
        self.all_text = np.frombuffer(b"".join(self.text_of), np.uint8)
        self.text_of = []

    def _automaton(self, tokens: dict[bytes, int]) -> None:
        """Suffix matching over the tokens: ``step`` leads from (node, byte) to a
        node, ``fail`` to the node of its longest proper suffix; ``best`` is the
        longest token that ends at a node, ``shorter`` the next one after a token."""
        self.step: dict[int, int] = {}
        self.fail, self.best = array("i", [0]), array("i", [-1])
        self.shorter = array("i", [-1]) * (max(tokens.values()) + 1)
        level = [(0, t) for t in sorted(tokens)]  # (node of the first bytes, token)
        depth = 0
        while level:
            deeper = []
            for node, t in level:
                key = node << 8 | t[depth]
                child = self.step.get(key)
                if child is None:
                    fail = 0
                    if depth:
                        fail = self.fail[node]
                        while fail and fail << 8 | t[depth] not in self.step:
                            fail = self.fail[fail]
                        fail = self.step[fail << 8 | t[depth]]
                    child = self.step[key] = len(self.fail)
                    self.fail.append(fail)
                    self.best.append(self.best[fail])
                if len(t) == depth + 1:
                    self.shorter[tokens[t]] = self.best[self.fail[child]]
                    self.best[child] = tokens[t]
                else:
                    deeper.append((child, t))
            level, depth = deeper, depth + 1

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at one edge of ``token`` while it is built (0:
        left edge, 1: right edge), each with the rank of the merge that ends it."""
        known = self.spines[side].get(token)
        if known is None:
            known, t, end = [], token, _NEVER
            while True:
                known.append((t, end))
                if t not in self.parts:
                    break
                a, b, end = self.parts[t]
                t = b if side else a
            known.reverse()
            self.spines[side][token] = known
        return known

    def _meet(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b``, built side by side, are both complete before a
        pair at their border is merged. At equal ranks the left pair is merged first."""
        left, right = self._spine(a, 1), self._spine(b, 0)
        i = j = 0
        while True:
            (x, x_end), (y, y_end) = left[i], right[j]
            if x_end == _NEVER and y_end == _NEVER:
                return True
            rank = self.merges.get((x, y), _NONE)[0]
            if rank < x_end and rank <= y_end:
                return False
            if x_end <= y_end:
                i += 1
            else:
                j += 1

    def _fit(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` and ``b`` together encode to just ``[a, b]``."""
        if len(self.fits) > MEMO_PAIRS:
            self.fits.clear()
        known = self.fits[a << 32 | b] = (a, b) not in self.merges and self._meet(a, b)
        return known

    def encode_pieces(self, pieces: list[bytes]) -> list[array]:
        """Encodings of sorted non-empty pieces, in the depth-first order of their
        trie: ``states[k]`` is the last token of the first ``k`` bytes of the path,
        ``found[k]`` the node of the tokens that end there."""
        step, fail, best, shorter = self.step.get, self.fail, self.best, self.shorter
        width, fits = self.width, self.fits
        states, found, before, out = [-1], [0], b"", []
        for piece in pieces:
            shared = 0
            for x, y in zip(piece, before):
                if x != y:
                    break
                shared += 1
            del states[shared + 1 :], found[shared + 1 :]
            before, node = piece, found[shared]
            for at, b in enumerate(piece[shared:], shared + 1):
                child = step(node << 8 | b)
                while child is None:
                    node = fail[node]
                    child = step(node << 8 | b)
                node = child
                found.append(node)
                t = best[node]
                start = at - width[t]
                while start:
                    a = states[start]
                    fit = fits.get(a << 32 | t)
                    if fit or fit is None and self._fit(a, t):
                        break
                    t = shorter[t]
                    start = at - width[t]
                states.append(t)
            at, ids = len(piece), []
            while at:
                t = states[at]
                ids.append(t)
                at -= width[t]
            ids.reverse()
            out.append(array("I", ids))
        return out

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Packed ids of pieces, by trie unless the memo has them."""
        found: dict[str, bytes] = {}
        new = []
        for p in pieces:
            known = self.memo.get(p[1:]) if p[0] == " " else None
            if p in self.special:
                found[p] = array("I", [self.special[p]]).tobytes()
            elif known is not None:
                found[p] = known
            else:
                new.append(p.encode())
        new.sort()
        for p, ids in zip(new, self.encode_pieces(new)):
            found[p.decode()] = ids.tobytes()
        return found

    def _pieces(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.special):
            return self.pattern.findall(text)
        return [p for part in self.cut.split(text) for p in ([part] if part in self.special else self.pattern.findall(part))]

    def _cut_word(self, word: str) -> list[str]:
        """The pieces of a blank-led word; letters, with or without a mark behind, need no pattern."""
        if word.isalpha() and (word.isascii() or max(word) < _MODIFIERS):
            return [" " + word]
        stem = word[:-1]
        if word[-1] in _MARKS and stem.isalpha() and (stem.isascii() or max(stem) < _MODIFIERS):
            return [" " + stem, word[-1]]
        return self.pattern.findall(" " + word)

    def _words(self, words: list[str], often: np.ndarray) -> list[bytes]:
        """Ids of distinct blank-led words; those met ``often`` are kept."""
        if len(self.memo) > MEMO_PIECES:
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        known = list(map(memo.get, words))
        new: dict[str, int] = {}
        for k, ids in enumerate(known):
            if ids is None:
                w = words[k]
                ids = known[k] = older.get(w)
                if ids is None:
                    new[w] = k
                else:
                    memo[w] = ids
        plain = sorted(w for w in new if w.isalpha() and (w.isascii() or max(w) < _MODIFIERS))
        for w, ids in zip(plain, self.encode_pieces([b" " + w.encode() for w in plain])):
            known[new[w]] = ids.tobytes()
        cuts = {w: self._cut_word(w) for w in new if known[new[w]] is None}
        pieces = {p for cut in cuts.values() for p in cut}
        found = {p: known[new[p[1:]]] for p in pieces if p[1:] in new and p[0] == " " and p[1:] not in cuts}
        found.update(self._learn(pieces.difference(found)))
        for w, cut in cuts.items():
            known[new[w]] = b"".join([found[p] for p in cut])
        memo.update((w, known[k]) for w, k in new.items() if often[k] and len(w) <= MEMO_BYTES)
        return known

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers.

        Between two words that one space parts, the split pattern always cuts
        before the space, so a text of such words is its first word and the row of
        its blank-led words; any other text is cut by the pattern.
        """
        if not len(texts):
            return []
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string())
        texts = texts.fill_null("")
        cut = pc.split_pattern(texts, " ")
        starts = cut.offsets.to_numpy()
        coded = cut.flatten().dictionary_encode()
        place, words = coded.indices.to_numpy().copy(), coded.dictionary.to_pylist()
        first = starts[:-1] - starts[0]
        bounds = np.append(first, len(place))
        # texts that the pattern must cut as a whole
        loose = np.fromiter((not w or w != w.strip() for w in words), bool, len(words))
        flags = loose[place]
        flags[first] = [words[k][-1:].isspace() for k in place[first].tolist()]
        odd = np.logical_or.reduceat(flags, first)
        for text in self.special:
            odd |= pc.match_substring(texts, text).to_numpy(zero_copy_only=False)
        counted = ~np.repeat(odd, np.diff(bounds))
        counted[first] = False
        times = np.bincount(place[counted], minlength=len(words))
        used = np.flatnonzero(times)
        entries = self._words([words[k] for k in used.tolist()], times[used] > 1)
        # first words and whole odd texts as rows of pieces
        whole = {k: self._pieces(texts[k].as_py()) for k in np.flatnonzero(odd).tolist()}
        heads = {k: self.pattern.findall(words[k]) for k in set(place[first[~odd]].tolist())}
        found = self._learn({p for row in (*whole.values(), *heads.values()) for p in row})
        to = np.zeros(len(words) + 1, np.int32)  # word -> entry; entry 0 is empty
        to[used] = np.arange(1, len(used) + 1)
        head_to = {k: len(entries) + 1 + n for n, k in enumerate(heads)}
        entries = [b"", *entries, *(b"".join([found[p] for p in row]) for row in heads.values())]
        place = np.where(counted, to[place], 0)
        place[first] = [0 if o else head_to[coded.indices[k].as_py()] for k, o in zip(first.tolist(), odd.tolist())]
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        data, ends = gather(np.frombuffer(b"".join(entries), "<u4"), np.cumsum(sizes) - sizes, sizes, place)
        ends = np.append(0, ends)[bounds].tolist()
        return [b"".join([found[p] for p in whole[k]]) if k in whole else data[a:b].tobytes() for k, (a, b) in enumerate(zip(ends, ends[1:]))]

    def forget(self) -> None:
        """Drop all but the vocabulary."""
        self.memo, self.older, self.fits, self.spines = {}, {}, {}, ({}, {})

    def decode(self, packed: bytes) -> bytes:
        """The UTF-8 text of packed ids (broken sequences become U+FFFD)."""
        at = self.text_at
        data, _ = gather(self.all_text, at[:-1], np.diff(at), np.frombuffer(packed, "<u4"))
        return data.tobytes().decode("utf-8", "replace").encode()


_ready: dict[str, TrieBPE] = {}


def _coder(content: str) -> TrieBPE:
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _ready:
        _ready.clear()
        _ready[key] = TrieBPE(content)
    return _ready[key]


def load_vocabulary(spark: SparkSession, path: str):
    """Broadcast of the vocabulary file (a fixed few MB), read on the driver."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encoder(vocabulary, text: Column) -> Column:
    """Packed little-endian 32-bit ids of a text column."""

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        coder = _coder(vocabulary.value)
        batch = pa.record_batch([texts], names=["text"])
        return pa.array([ids for run in runs(batch, 0) for ids in coder.encode(run.column(0))], pa.binary())

    return encode(text)


def decoder(vocabulary, ids: Column) -> Column:
    """The text of packed ids."""

    @F.arrow_udf("string")
    def decode(packed: pa.Array) -> pa.Array:
        coder = _coder(vocabulary.value)
        return pa.array([coder.decode(x) if x is not None else b"" for x in packed.to_pylist()], pa.binary()).cast(pa.string())

    return decode(ids)


def encode_documents(docs: DataFrame, vocab_path: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with the packed ids of each whole text in ``ids_col``."""
    small_batches(docs.sparkSession)
    return docs.withColumn(ids_col, encoder(load_vocabulary(docs.sparkSession, vocab_path), F.col(text_col)))


def _code_runs(coder: TrieBPE, batches: Iterator[pa.RecordBatch], id_col: str) -> Iterator[pa.RecordBatch]:
    """mapInArrow body over ``(id_col, text)``: a run's ids and decoded texts are gone before the next run."""
    try:
        for run in joined(batches, 1, CODE_BYTES):
            ids = coder.encode(run.column(1))
            decoded = pa.array(map(coder.decode, ids), pa.binary()).cast(pa.string())
            coded = pa.array(ids, pa.binary())
            del ids
            yield pa.record_batch([run.column(0), coded, decoded], names=[id_col, "ids", "decoded"])
            del coded, decoded
    finally:
        coder.forget()
        give_back()


def code_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids, decoded)``: each whole text's packed ids, and the text they decode to.
    A task that ends gives its memory back, which an idle worker would keep."""
    small_batches(docs.sparkSession)
    vocabulary = load_vocabulary(docs.sparkSession, vocab_path)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _code_runs(_coder(vocabulary.value), batches, id_col)

    rows = docs.select(F.col(id_col), F.col(text_col))
    return rows.mapInArrow(code, f"`{id_col}` {dict(docs.dtypes)[id_col]}, ids binary, decoded string")


def bpe_digest(docs: DataFrame, vocab_path: str) -> DataFrame:
    """One row per document: token count, digest of the ids, digest of the decoded text."""
    coded = code_documents(docs.select("doc_id", "text"), vocab_path)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
