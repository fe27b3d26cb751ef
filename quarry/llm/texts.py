"""Small helpers shared by the text operators (run inside Arrow batches)."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once inside a task: bounds the numpy scratch space
#: whatever the size of the Arrow batch.
CHUNK_BYTES = 4 << 20
#: Bytes of text that are encoded together; a longer text is a run of its own.
RUN_BYTES = 8 << 20
#: Rows of an Arrow batch of texts.
BATCH_ROWS = 1000

_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The column's texts as UTF-8 bytes (no decoding, nulls stay None)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def chunks(texts: list[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[list[bytes | None]]:
    """Consecutive runs of texts of about ``limit`` bytes; a longer text is a run of its own."""
    run: list[bytes | None] = []
    size = 0
    for t in texts:
        n = len(t) if t is not None else 0
        if run and size + n > limit:
            yield run
            run, size = [], 0
        run.append(t)
        size += n
    if run:
        yield run


def space_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: ``bytes.split()`` cuts at exactly these six bytes."""
    return text.split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` (ASCII letters,
    digits and every character beyond ASCII)."""
    return text.translate(_ALNUM).split() if text else []


def alnum_spans(text: bytes) -> np.ndarray:
    """Byte ranges of :func:`alnum_words`, as an ``n x 2`` array."""
    inside = np.frombuffer(text.translate(_ALNUM), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return edge.reshape(-1, 2)


def lengths(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, words), np.int64, len(words))


def small_batches(spark) -> None:
    """Texts go to Python workers at most ``BATCH_ROWS`` at a time, which
    bounds a worker's memory; the setting stays with the session."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def free_name(df, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Memory that a worker has freed goes back to the system, which an idle worker
    would keep; where the C library has no such call, only Arrow's does."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices of ``data`` named by ``rows`` one after the other, and where each ends."""
    n = sizes[rows]
    ends = np.cumsum(n)
    kind = np.int32 if len(data) < 1 << 31 and (not len(ends) or ends[-1] < 1 << 31) else np.int64
    at = np.repeat((starts[rows] - ends + n).astype(kind), n)
    at += np.arange(len(at), dtype=kind)
    return data[at], ends


def runs(batch: pa.RecordBatch, column: int, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about ``limit`` (default ``RUN_BYTES``) bytes of text each."""
    limit = limit or RUN_BYTES
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    at = size = 0
    for k, n in enumerate(sizes.tolist()):
        if k > at and size + n > limit:
            yield batch.slice(at, k - at)
            at, size = k, 0
        size += n
    if batch.num_rows:
        yield batch.slice(at)


def joined(batches: Iterator[pa.RecordBatch], column: int, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Small batches put together up to ``limit`` (default ``RUN_BYTES``) bytes of text, large ones cut."""
    limit = limit or RUN_BYTES
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        n = batch.column(column).nbytes
        if held and size + n > limit:
            yield from runs(pa.concat_batches(held), column, limit)
            held, size = [], 0
        held.append(batch)
        size += n
    if held:
        yield from runs(pa.concat_batches(held), column, limit)
