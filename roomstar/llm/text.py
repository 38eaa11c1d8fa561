"""Vectorised text helpers shared by the operators: Arrow text columns as byte arrays, words
as spans, and position-independent 64-bit hashes of any span of a buffer."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BATCH_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: a bijection of 64-bit values in which every output bit depends on every
    input bit."""
    x = np.asarray(x, U64).copy()
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


_SYMBOL = mix(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64, grown as needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    @staticmethod
    def _grow(table: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(table) < n:
            step = U64(pow(base, len(table), 1 << 64))
            table = np.concatenate([table, table * step])
        return table

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = self._grow(self.up, _BASE, n)
            self.down = self._grow(self.down, pow(_BASE, -1, 1 << 64), n)
        return self.up, self.down


_POWERS = _Powers()
KEPT_POWERS = 1 << 20
_malloc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give freed memory back to the system. A Python worker lives on for later stages, beside the
    executor's JVM, and would else keep what its largest batch took."""
    if len(_POWERS.up) > KEPT_POWERS:
        _POWERS.up, _POWERS.down = _POWERS.up[:KEPT_POWERS].copy(), _POWERS.down[:KEPT_POWERS].copy()
    pa.default_memory_pool().release_unused()
    if _malloc_trim is not None:
        _malloc_trim(0)


class SpanHash:
    """Hashes of spans of one buffer: ``of(s, e)`` depends on the content of [s, e) only."""

    def __init__(self, data: np.ndarray, symbols: np.ndarray | None = None) -> None:
        up, self._down = _POWERS.upto(len(data) + 1)
        value = _SYMBOL[data] if symbols is None else symbols
        self._sum = np.zeros(len(data) + 1, U64)
        np.cumsum(value * up[:len(data)], out=self._sum[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sum[end] - self._sum[start]) * self._down[start])


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty. offsets[0] is 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[off[0]:off[-1]], off - off[0]


def from_texts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    return utf8(pa.array(texts, pa.large_string()))


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of whole rows with about ``limit`` bytes of ``column`` each; a
    longer text is a run of its own. When the batches end, the task's memory is given back."""
    yield from pieces(batches, column, limit)
    release()


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The runs of ``slices``, for functions that are called once a group."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        run = np.cumsum(size.astype(np.int64)) // limit
        cuts = np.flatnonzero(np.diff(run)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that do not cross texts: (start, end, text index)."""
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | first[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def per_text(owner: np.ndarray, n: int) -> np.ndarray:
    """Offsets (n + 1) of each text's entries in arrays ordered by text index."""
    return np.searchsorted(owner, np.arange(n + 1))


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenated index runs start[i] .. start[i] + length[i] - 1."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    step = np.repeat(start - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
    return np.arange(total) + step
