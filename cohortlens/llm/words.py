"""Vectorised text kernels used inside Arrow tasks.

A batch of texts is seen as one byte buffer with row offsets; word and line
bounds are found with numpy over the buffer and distinct words with Arrow's
dictionary encoding, so no Python code runs per word. Batches are cut into
slices of a few MB first, which bounds the memory of a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 3 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_slices(batch: pa.RecordBatch, column: str = "text"):
    """Slices of ``batch`` holding about SLICE_BYTES of ``column`` each (a
    longer single text is a slice of its own)."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0)
    ends = np.cumsum(np.asarray(size, dtype=np.int64) + 64)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        yield batch.slice(at, to - at)
        at = to


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; NULL counts as empty."""
    col = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.empty(0, np.uint8)
    return data, offs - offs[0]


def spans_of(data: np.ndarray, offs: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes outside ``gap`` (a mask over byte values), never
    across rows: (starts, ends, first run of each row and the total)."""
    inside = ~gap[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offs] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (cut[:-1] | ~before))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (cut[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(starts, offs)


def pieces(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The byte strings data[bounds[i]:bounds[i + 1]] without a copy."""
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)),
                                  pa.py_buffer(np.ascontiguousarray(data))])


def hash64(values: pa.Array) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(x) for x in values.to_pylist()), np.uint64, len(values))


def word_hashes(column: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs without ASCII white space) of a string
    column in order, and the word offsets of its rows."""
    words, of, first = word_numbers(column, lower)
    return words[of], first


def word_numbers(column: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``word_hashes``, the hashes of distinct words and the number of each word among them."""
    data, offs = buffer_of(column)
    if lower:
        data = _LOWER[data]
    starts, ends, first = spans_of(data, offs, _SPACE)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64), first
    kept = data[~_SPACE[data]]
    bounds = np.concatenate(([0], np.cumsum(ends - starts)))
    coded = pieces(kept, bounds).dictionary_encode()
    return hash64(coded.dictionary), np.asarray(coded.indices), first


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive entries (n <= 8)."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total += words[i:len(words) - n + 1 + i] * _ODD[i]
    return mix(total)
