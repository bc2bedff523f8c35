"""Words and hashes of Arrow text columns, in blocks of bounded size, for code inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCK_BYTES = 4 << 20


def rebased(texts: pa.Array) -> pa.Array:
    """The same large strings without nulls, with offsets that begin at 0: Arrow's ASCII
    transforms misread slices whose offsets begin elsewhere."""
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    if not len(texts) or at[0] == 0 and texts.offset == 0:
        return texts
    data = texts.buffers()[2].slice(int(at[0]), int(at[-1] - at[0])) if at[-1] > at[0] else pa.py_buffer(b"")
    return pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer(at - at[0]), data])


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as text without nulls (null reads as empty)."""
    return rebased(pc.fill_null(batch.column(name).cast(pa.large_string()), ""))


def blocks(batch: pa.RecordBatch, name: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with about ``limit`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    block = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
        yield batch.slice(int(a), int(b - a))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of texts with A-Z lower-cased.

    Returns the code of every word, the offsets of each text's words (one more than texts),
    and the distinct words by code.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(rebased(texts)))
    if isinstance(parts, pa.ChunkedArray):
        parts = parts.combine_chunks()
    words, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    kept = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not kept.all():  # white space at either end leaves empty parts
        offsets = np.r_[0, np.cumsum(kept, dtype=np.int64)][offsets]
        words = words.filter(pa.array(kept))
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), offsets, coded.dictionary


_TABLES: dict[int, tuple[np.ndarray, int]] = {}


def _hash_tables(seed: int) -> tuple[np.ndarray, int]:
    if seed not in _TABLES:
        rng = np.random.default_rng(seed)
        _TABLES[seed] = rng.integers(0, 1 << 64, 256, np.uint64), int(rng.integers(0, 1 << 64, dtype=np.uint64)) | 1
    return _TABLES[seed]


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number with its bits mixed, one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def hash_words(words: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word: a random number for each byte value, weighed by powers of an
    odd base, summed over the word's bytes and mixed with its length. All words at once."""
    raw = words.cast(pa.large_binary())
    at = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
    if not len(raw) or at[-1] == at[0]:
        return np.zeros(len(raw), np.uint64)
    data, at = np.frombuffer(raw.buffers()[2], np.uint8)[at[0]:at[-1]], at - at[0]
    table, base = _hash_tables(seed)
    powers = [np.cumprod(np.r_[np.uint64(1), np.full(len(data), b, np.uint64)], dtype=np.uint64)
              for b in (base, pow(base, -1, 1 << 64))]
    sums = np.r_[np.uint64(0), np.cumsum(table[data] * powers[0][:-1], dtype=np.uint64)]
    return mixed((sums[at[1:]] - sums[at[:-1]]) * powers[1][at[:-1]] + np.diff(at).astype(np.uint64))


def with_fields(df: DataFrame, fields: str) -> T.StructType:
    """The schema of ``df`` with more columns, given as a DDL text."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(fields).fields])
