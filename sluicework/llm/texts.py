"""Text columns of Arrow batches as plain byte arrays, in blocks of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The bytes that separate words.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
# What a word is, and a character between words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True

BLOCK_BYTES = 1 << 20

_C = ctypes.CDLL(None)


def fold_of(doc_id: Column, folds: int) -> Column:
    """The fold of a document by the checksum of its id; a NULL id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0).cast("long"))


def widened(schema: T.StructType, **added: str) -> T.StructType:
    """The schema with more columns; their names must be new."""
    if clash := sorted(set(added) & set(schema.names)):
        raise ValueError(f"there are columns {clash} already")
    return T.StructType([*schema.fields, *(T.StructField(k, T._parse_datatype_string(v)) for k, v in added.items())])


def plain_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and where each row starts in them; NULL is empty."""
    binary = pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type)
    array = pc.fill_null(array, b"" if binary else "")
    if len(array) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    at = at[array.offset:array.offset + len(array) + 1].astype(np.int64)
    data = np.zeros(0, dtype=np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive rows with about ``limit`` bytes of text at most; a longer text is a block alone.

    At the end the worker, which goes on to other tasks, gives back the memory that is free.
    """
    for batch in batches:
        data, at = plain_bytes(batch.column(column))
        start, rows = 0, batch.num_rows
        while start < rows:
            end = int(np.searchsorted(at, at[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), rows)
            yield batch.slice(start, end - start), data[at[start]:at[end]], at[start:end + 1] - at[start]
            start = end
    release_memory()


def release_memory() -> None:
    """Returns free memory to the system, as far as the allocators can."""
    pa.default_memory_pool().release_unused()
    if hasattr(_C, "malloc_trim"):
        _C.malloc_trim(0)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the bytes, and the row it belongs to."""
    inside = ~IS_SPACE[data]
    first = inside.copy()
    last = inside.copy()
    if len(data) > 1:
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
    # A row that ends in a word and the next row's first word don't run together
    cuts = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    rows = np.searchsorted(at, starts, side="right") - 1
    return starts, ends, rows


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of spans of the bytes, each from its bytes and length alone.

    Eight bytes at a time: the cost follows the bytes, whatever the number of spans.
    """
    lengths = ends - starts
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = _unaligned(padded, len(data) + 1)
    h = mixed(lengths.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64))
    masks = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
    left, at, rows = lengths.copy(), starts.copy(), np.arange(len(starts))
    while len(rows):
        part = words[at] & masks[np.minimum(left, 8)]
        h[rows] = mixed((h[rows] ^ part) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        more = left > 8
        rows, left, at = rows[more], left[more] - 8, at[more] + 8
    return h


def _unaligned(padded: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes from every position on, as one little-endian number each."""
    out = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        out |= padded[k:k + n].astype(np.uint64) << np.uint64(8 * k)
    return out


def window_hashes(hashes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``width`` entries within one row, and the place of its first entry."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        h = h * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
    whole = np.flatnonzero(rows[:n] == rows[width - 1:])
    return mixed(h[whole]), whole
