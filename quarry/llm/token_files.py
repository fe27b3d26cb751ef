"""Token ids in Arrow files of fixed-size lists (operator 8).

Documents are put in ascending id order by a range partitioning; each task
encodes its texts, appends the end id and packs all ids into rows of
``LENGTH`` tokens. A shard is an Arrow IPC file (the stream's messages with a
footer of offsets) of record batches of ``BATCH`` rows: ``tokens`` and
``mask``, both fixed-size lists, so row ``i`` is slot ``i % BATCH`` of batch
``i // BATCH`` and is read without a copy from a memory map. The mask marks ids
that belong to documents; only a shard's last row is padded. Ids take the
smallest unsigned type that holds the vocabulary. A second Arrow file beside
it lists the shard's documents with their place in it.

The table of shards (one row for each written file) is committed by Spark;
its running sums, one number a shard, turn places in shards into places in
the whole corpus.

Texts are cut at ASCII white space, which the vocabulary's normalisation and
split pattern always drop and never merge across. A run of texts (bounded by
bytes) is cut into words by Arrow; each different word of it is encoded by the
tokenizers library once, and words met more than once are kept for the worker's
next runs: words of letters many to a text, told apart by the ids that end a
word, the others as texts of their own.

Defined cases: null texts count as empty and give the end id alone; documents
without id come first, equal ids in order of their text; repeated rows are all
written; an empty table gives no shard and no rows; other columns aren't looked at.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .shared_files import new_name, open_folder
from .texts import gather, joined, small_batches

LENGTH = 2048
BATCH = 256
END_ID = 2
#: Words (about 150 bytes each) at which a worker's memo ages, and of which lengths.
MEMO_WORDS = 150_000
MEMO_BYTES = 64
#: Words given to the library at once, which bounds its scratch space.
CALL_WORDS = 20_000


_MARKS = frozenset(bytes([b]) for b in b".,;:!?")


def _plain(word: bytes) -> bool:
    """Letters only that are one word of the split pattern, in either case, as they stand."""
    if word.isascii():
        return word.isalpha() and len(word) <= MEMO_BYTES
    text = word.decode()
    return text.isalpha() and max(text) < "\u0130" and len(word) <= MEMO_BYTES


class WordEncoder:
    """Ids of whole texts by the tokenizers library, through a memo of words."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes | None] | pa.Array) -> list[bytes]:
        """Each text's packed ids (``dtype``), without an end id."""
        if not len(texts):
            return []
        texts = (pa.array(texts, pa.binary()) if isinstance(texts, list) else texts).cast(pa.string()).fill_null("")
        # the vocabulary lower-cases, so ASCII capitals may go first where no special token can arise
        cut = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))
        coded = cut.flatten().dictionary_encode()
        place = coded.indices.to_numpy()
        times = np.bincount(place, minlength=len(coded.dictionary))
        entries = self._words(coded.dictionary.cast(pa.binary()).to_pylist(), times > 1)
        width = self.dtype.itemsize
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // width
        data, ends = gather(np.frombuffer(b"".join(entries), self.dtype), np.cumsum(sizes) - sizes, sizes, place)
        bounds = cut.offsets.to_numpy()
        ends = np.append(0, ends)[bounds - bounds[0]].tolist()
        return [data[a:b].tobytes() for a, b in zip(ends, ends[1:])]

    def _words(self, words: list[bytes], often: np.ndarray) -> list[bytes]:
        """Ids of distinct words (an empty one has none); those met ``often`` are kept."""
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        known = list(map(memo.get, words))
        new: dict[bytes, int] = {}
        for k, ids in enumerate(known):
            if ids is None:
                w = words[k]
                ids = known[k] = older.get(w) if w else b""
                if ids is None:
                    new[w] = k
                elif w:
                    memo[w] = ids
        # letters with one mark behind are two words of the split pattern
        marked, single, others = {}, set(), set()
        for w in new:
            if w.isalpha() or w.isdigit():  # ASCII only
                (single if w.isalpha() and len(w) <= MEMO_BYTES else others).add(w)
            elif w[-1:] in _MARKS and _plain(w[:-1]):
                marked[w] = (w[:-1], w[-1:])
            else:
                (single if _plain(w) else others).add(w)
        found = {p: memo.get(p) for parts in marked.values() for p in parts}
        for p, ids in found.items():
            if ids is None:
                (others if p in _MARKS else single).add(p)
        alone, rest = list(single), list(others)
        for at in range(0, len(alone), CALL_WORDS):
            found.update(self._together(alone[at : at + CALL_WORDS]))
        for at in range(0, len(rest), CALL_WORDS):
            part = rest[at : at + CALL_WORDS]
            for w, e in zip(part, self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)):
                found[w] = np.array(e.ids, self.dtype).tobytes()
        for w, k in new.items():
            parts = marked.get(w)
            ids = known[k] = found[w] if parts is None else found[parts[0]] + found[parts[1]]
            if often[k] and len(w) <= MEMO_BYTES:
                memo[w] = ids
        return known

    def _together(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Words of letters only, each of which the split pattern leaves whole,
        encoded as one text: a word's ids end with the one id that ends a word."""
        if not words:
            return iter(())
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, self.dtype)
        ends = (np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize
        if len(ends) != len(words):
            raise ValueError("the vocabulary does not end each word with an id of its own")
        packed = ids.tobytes()
        return zip(words, map(packed.__getitem__, map(slice, [0, *ends[:-1].tolist()], ends.tolist())))


_ready: dict[int, WordEncoder] = {}


def _encoder(vocabulary) -> WordEncoder:
    content = vocabulary.value
    key = zlib.crc32(content.encode())
    if key not in _ready:
        _ready.clear()
        _ready[key] = WordEncoder(content)
    return _ready[key]


def _schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("tokens", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_SHARDS = "part bigint, path string, n_tokens bigint, n_docs bigint"


class ShardWriter:
    """One shard: packed rows of ids, and the list of its documents."""

    def __init__(self, fs, folder: str, part: int, dtype: np.dtype, length: int):
        self.path = f"{folder}/{new_name('tokens', part, '.arrow')}"
        self.schema, self.length = _schema(dtype, length), length
        self.sinks = [fs.open_output_stream(self.path, compression=None), fs.open_output_stream(self.path + ".docs", compression=None)]
        self.rows, self.docs = pa.ipc.new_file(self.sinks[0], self.schema), pa.ipc.new_file(self.sinks[1], _DOCS)
        self.left = np.empty(0, dtype)
        self.n_tokens = self.n_docs = 0

    def _write(self, ids: np.ndarray, n: int) -> None:
        tokens = pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length)
        mask = pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(ids)) < n), self.length)
        self.rows.write_batch(pa.record_batch([tokens, mask], schema=self.schema))

    def add(self, doc_ids: list[int | None], coded: list[bytes]) -> None:
        sizes = np.array([len(c) // self.left.itemsize for c in coded], np.int64)
        starts = self.n_tokens + np.cumsum(sizes) - sizes
        self.docs.write_batch(pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(sizes)], schema=_DOCS))
        self.n_tokens += int(sizes.sum())
        self.n_docs += len(coded)
        ids = np.concatenate([self.left, np.frombuffer(b"".join(coded), self.left.dtype)])
        step = self.length * BATCH
        for at in range(0, len(ids) - step + 1, step):
            self._write(ids[at : at + step], step)
        self.left = ids[len(ids) // step * step :].copy()

    def close(self) -> None:
        if len(self.left):
            rows = -(-len(self.left) // self.length)
            self._write(np.concatenate([self.left, np.zeros(rows * self.length - len(self.left), self.left.dtype)]), len(self.left))
        for x in (self.rows, self.docs, *self.sinks):
            x.close()


def write_tokens(docs: DataFrame, vocab_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """Write all documents' ids under ``folder``; the committed table of shards,
    with ``base``: the ids of all shards before."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocab_path, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shard = None
        for run in joined(batches, 1):
            if shard is None:
                encoder = _encoder(vocabulary)
                fs, path = open_folder(folder)
                fs.create_dir(path, recursive=True)
                part = TaskContext.get().partitionId()
                shard = ShardWriter(fs, path, part, encoder.dtype, length)
            end = np.array([end_id], encoder.dtype).tobytes()
            shard.add(run.column(0).to_pylist(), [c + end for c in encoder.encode(run.column(1))])
        if shard is not None:
            shard.close()
            name = folder.rstrip("/") + "/" + shard.path.rsplit("/", 1)[-1]
            yield pa.record_batch([pa.array([x]) for x in (part, name, shard.n_tokens, shard.n_docs)], names=["part", "path", "n_tokens", "n_docs"])

    ordered = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).repartitionByRange(F.col("id").asc_nulls_first())
    shards = ordered.sortWithinPartitions(F.col("id").asc_nulls_first(), "text").mapInArrow(write, _SHARDS)
    shards.write.parquet(folder.rstrip("/") + "/shards")
    return read_shards(spark, folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The committed shards with ``base`` (a number for each file passes through the driver)."""
    rows = spark.read.schema(_SHARDS).parquet(folder.rstrip("/") + "/shards").orderBy("part").collect()
    out, base = [], 0
    for r in rows:
        out.append((r.part, r.path, r.n_tokens, r.n_docs, base))
        base += r.n_tokens
    spread = spark.sparkContext.parallelize(out, max(1, len(out)))
    return spark.createDataFrame(spread, _SHARDS + ", base bigint")


class TokenFile:
    """Random access to one shard: rows and masks as views of the mapped file."""

    def __init__(self, source):
        self.file = pa.ipc.open_file(source)

    @property
    def n_rows(self) -> int:
        last = self.file.num_record_batches - 1
        return 0 if last < 0 else last * BATCH + self.file.get_batch(last).num_rows

    def row(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Tokens (no copy) and mask of row ``i``."""
        batch = self.file.get_batch(i // BATCH)
        width = batch.schema.field("tokens").type.list_size
        at = (i % BATCH) * width
        return batch.column("tokens").values[at : at + width].to_numpy(zero_copy_only=True), batch.column("mask").values[at : at + width]

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the shard."""
        if not n:
            return np.empty(0, np.uint16)
        width = self.file.schema.field("tokens").type.list_size * BATCH
        parts = []
        for b in range(start // width, (start + n - 1) // width + 1):
            values = self.file.get_batch(b).column("tokens").values
            lo, hi = max(0, start - b * width), min(len(values), start + n - b * width)
            parts.append(values[lo:hi].to_numpy(zero_copy_only=True))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def open_tokens(path: str) -> TokenFile:
    fs, at = open_folder(path)
    return TokenFile(pa.memory_map(at) if fs.type_name == "local" else fs.open_input_file(at))


def read_documents(shards: DataFrame) -> DataFrame:
    """Per document, read back from the files: ``doc_id, start, n_tokens, ids`` (packed 32-bit ids)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                tokens = open_tokens(shard["path"])
                fs, at = open_folder(shard["path"] + ".docs")
                with pa.ipc.open_file(fs.open_input_file(at)) as listed:
                    for b in range(listed.num_record_batches):
                        docs = listed.get_batch(b)
                        starts, sizes = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
                        packed = [tokens.ids(s, n).astype("<u4").tobytes() for s, n in zip(starts.tolist(), sizes.tolist())]
                        yield pa.record_batch(
                            [docs.column("doc_id"), pa.array(starts + shard["base"]), docs.column("n_tokens"), pa.array(packed, pa.binary())],
                            names=["doc_id", "start", "n_tokens", "ids"],
                        )

    return shards.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_digest(docs: DataFrame, vocab_path: str) -> DataFrame:
    shards = write_tokens(docs, vocab_path, scratch_path(docs.sparkSession, "tokens"))
    found = read_documents(shards)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
