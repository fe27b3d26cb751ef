"""Token files: equal to the library, read back exactly, zero-copy rows."""

import random
import zlib

import numpy as np
import pytest

from quarry.llm import token_files as T
from quarry.llm.queries import vocabulary_path
from quarry.session import scratch_path

tokenizers = pytest.importorskip("tokenizers")
PATH = vocabulary_path("word_bpe_49k.json")
library = tokenizers.Tokenizer.from_file(PATH)


def rows():
    rng = random.Random(1)
    parts = ["a", "É", "é", " ", "\n", " ", "<|endoftext|>", "'s", "12", "ß", "Σ", "\x1c", "́", "中", "$", "\t", "\x85", "İ", "thing"]
    out = [(i, "".join(rng.choices(parts, k=rng.randint(0, 40)))) for i in range(600)]
    return out + [(900, None), (None, "x y"), (None, None), (5, "again"), (5, "again"), (901, "word " * 9000)]


def ordered(data):
    return sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))


def test_documents_come_back(spark):
    data = rows()
    df = spark.createDataFrame([(i, t, 1) for i, t in data], "doc_id long, text string, start int").repartition(7)
    got = sorted(map(tuple, T.token_digest(df, PATH).collect()), key=lambda r: r[1])
    want, base = [], 0
    for i, t in ordered(data):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, base, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        base += len(ids)
    assert got == want


def test_rows_are_views_with_masks(spark):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    shards = T.write_tokens(df, PATH, scratch_path(spark, "tokens"), length=16).orderBy("part").collect()
    flat = [x for _, t in ordered(data) for x in library.encode(t or "", add_special_tokens=False).ids + [2]]
    at = 0
    for s in shards:
        f = T.open_tokens(s.path)
        assert s.base == at and f.n_rows == -(-s.n_tokens // 16)
        read = []
        for i in range(f.n_rows):
            tokens, mask = f.row(i)
            assert tokens.dtype == np.uint16 and not tokens.flags.owndata and len(tokens) == 16
            read += tokens[np.array(mask.to_pylist())].tolist()
        assert read == flat[at : at + s.n_tokens]
        at += s.n_tokens
    assert at == len(flat)


def test_bounded_memo_changes_nothing(monkeypatch):
    monkeypatch.setattr(T, "MEMO_WORDS", 3)
    monkeypatch.setattr(T, "MEMO_BYTES", 2)
    monkeypatch.setattr(T, "CALL_WORDS", 2)
    with open(PATH, encoding="utf-8") as f:
        encoder = T.WordEncoder(f.read())
    for _, t in rows()[:200]:
        (ids,) = encoder.encode([t.encode()])
        assert np.frombuffer(ids, encoder.dtype).tolist() == library.encode(t, add_special_tokens=False).ids


def test_empty_table(spark):
    assert T.token_digest(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
