"""Trie BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import bpe, texts
from quarry.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")
PATH = vocabulary_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def coder():
    with open(PATH, encoding="utf-8") as f:
        return bpe.TrieBPE(f.read())


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def random_texts(n, seed=1):
    rng = random.Random(seed)
    parts = ["the", "ing", "ation", " ", "  ", "\n", "\t", "é", "中文", "🙂", "'ll", "'s", "12", "3", "!!", "<|endoftext|>", " ", "\x1c", "a", "B", "ß"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(n)]


def test_equals_the_library(coder, library):
    texts = random_texts(3000) + ["", " ", "x" * 5000, "ab" * 3000, " a" * 2000, "<|endoftext|>" * 3]
    want = [packed(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert coder.encode(texts) == want
    assert [coder.decode(w).decode() for w in want] == [library.decode(np.frombuffer(w, "<u4").tolist(), skip_special_tokens=False) for w in want]


def test_every_code_point_is_cut_alike(coder, library):
    points = [chr(c) for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}1 {c}{c} x{c}" for c in points]
    assert coder.encode(texts) == [packed(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_bounded_memo_and_trie_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_PIECES", 5)
    monkeypatch.setattr(texts, "RUN_BYTES", 7)
    monkeypatch.setattr(bpe, "MEMO_PAIRS", 5)
    monkeypatch.setattr(bpe, "MEMO_BYTES", 3)
    with open(PATH, encoding="utf-8") as f:
        small = bpe.TrieBPE(f.read())
    rows = random_texts(200, 2)
    batch = pa.record_batch([pa.array([None, *rows])], names=["text"])
    got = [x for run in texts.joined(iter([batch.slice(0, 50), batch.slice(50)]), 0) for x in small.encode(run.column(0))]
    assert got == [packed(e.ids) for e in library.encode_batch(["", *rows], add_special_tokens=False)]


def test_automaton_holds_the_tokens_that_text_encodes_to(coder, library):
    """A token is an end of the automaton iff the library gives it back for its own text."""
    at, data = coder.text_at, coder.all_text
    for i in range(0, 50_000, 7):
        token = data[at[i] : at[i + 1]].tobytes()
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue
        node = 0
        for b in token:
            node = coder.step.get(node << 8 | b, 0)
        if library.encode(text, add_special_tokens=False).ids == [i]:
            assert coder.best[node] == i
            ends = [t for t in range(max(0, i - 400), i) if len(token) > at[t + 1] - at[t] > 0 and token.endswith(data[at[t] : at[t + 1]].tobytes())]
            chain, t = set(), coder.shorter[i]
            while t >= 0:
                chain.add(t)
                t = coder.shorter[t]
            text_of = lambda t: data[at[t] : at[t + 1]].tobytes()
            assert all(token.endswith(text_of(t)) for t in chain)
            assert {t for t in ends if coder.encode_pieces([text_of(t)])[0].tolist() == [t]} <= chain


def test_digest(spark, library):
    rows = [(1, "Hello world", 5), (2, None, 5), (3, "", 5), (3, "Hello world", 5), (None, "é\n\n x", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(2)
    want = []
    for i, t, _ in rows:
        ids = packed(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(repr, (tuple(r) for r in bpe.bpe_digest(df, PATH).collect()))) == sorted(map(repr, want))
    assert bpe.bpe_digest(df.where("false"), PATH).collect() == []
    assert bpe.encode_documents(df, PATH).columns == ["doc_id", "text", "ids", "token_ids"]


def test_a_task_holds_small_runs_and_gives_its_memory_back(monkeypatch):
    seen, back = [], []

    class Coder:
        def encode(self, column):
            seen.append(column.nbytes)
            return [b"\1\0\0\0"] * len(column)

        def decode(self, packed):
            return b"x"

        def forget(self):
            back.append("coder")

    monkeypatch.setattr(bpe, "give_back", lambda: back.append("system"), raising=False)
    one = pa.record_batch([pa.array(range(100), pa.int64()), pa.array(["x" * 50_000] * 100)], names=["doc_id", "text"])
    out = list(bpe._code_runs(Coder(), iter([one, one]), "doc_id"))
    assert sum(b.num_rows for b in out) == 200 and max(seen) <= bpe.CODE_BYTES + 4096
    assert back == ["coder", "system"]
    texts.give_back()
