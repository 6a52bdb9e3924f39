"""Vectorised text helpers shared by the operators of this subpackage.

All of them work on a whole Arrow batch at once: a batch of texts is one byte
buffer plus offsets, words are two integer arrays into it, and hashes of
arbitrary spans come from prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words are runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

U64 = np.uint64
_STEP = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 output bits (a bijection)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


# One pseudo-random value per byte, so that byte differences are not small integers.
BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(_STEP))

_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse, up to ``n``; kept by the worker."""
    if _POWERS[0].size < n:
        size = max(n, 1 << 16)
        inverse = pow(_STEP, -1, 1 << 64)
        for k, base in enumerate((_STEP, inverse)):
            p = np.full(size, base, dtype=U64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p)
    return _POWERS[0][:n], _POWERS[1][:n]


class SpanHash:
    """64-bit hashes of any spans of a sequence of units (bytes or word hashes)."""

    def __init__(self, values: np.ndarray):
        n = values.size
        forward, self._back = _powers(n + 1)
        self._sums = np.zeros(n + 1, U64)
        np.cumsum(values * forward[:n], out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._back[start])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and ``len + 1`` offsets into them; null texts count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def text_chunks(batches: Iterable[pa.RecordBatch], column: str = "text",
                max_bytes: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of at most about ``max_bytes`` each; a longer text comes alone and whole."""
    for batch in batches:
        raw, off = text_buffer(batch.column(batch.schema.get_field_index(column)))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
            j = min(j, n)
            yield batch.slice(i, j - i), raw[off[i]:off[j]], off[i:j + 1] - off[i]
            i = j


def word_spans(raw: np.ndarray, off: np.ndarray, cut: np.ndarray | None = None, space: np.ndarray = _SPACE
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and ``len(off)`` offsets of the texts in word counts.

    ``cut``, a 256 x 256 table, says between which bytes of a word it is cut in two; ``space`` says
    which bytes part words.
    """
    n = raw.size
    space = space[raw]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    part = edge[1:n]
    if cut is not None:
        part = part | cut.ravel()[raw[:-1].astype(np.int32) << 8 | raw[1:]]
    begins = ~space
    begins[1:] &= space[:-1] | part
    ends = ~space
    ends[:-1] &= space[1:] | part
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, off)


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return SpanHash(BYTE_VALUE[raw])(start, end)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, in one pass forward and one back over blocks."""
    n = x.size
    if n < width:
        return x[:0]
    if width == 1:
        return x
    pad = -n % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n - width + 1], head[width - 1:n])


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The integers of all ranges [start, start + length), one after the other."""
    total = int(length.sum())
    first = np.repeat(start - np.concatenate([[0], np.cumsum(length)[:-1]]), length) if total else np.zeros(0, np.int64)
    return first + np.arange(total)


class PartEncoder:
    """Token ids of texts from those of their parts, encoding each distinct part once.

    ``encode_new`` maps a list of part strings to their ids as little-endian bytes; ids are kept per
    worker, and a memory of ``kept`` parts is emptied when full.
    """

    def __init__(self, encode_new, kept: int = 600_000):
        self._encode_new, self._kept = encode_new, kept
        self._known: dict[int, bytes] = {}

    def __call__(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts, one after the other; how many each part has)."""
        hashes = SpanHash(BYTE_VALUE[raw])(start, end)
        distinct, place, which = np.unique(hashes, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        new = [i for i, h in enumerate(keys) if h not in self._known]
        if len(self._known) + len(new) > self._kept:
            self._known, new = {}, list(range(len(keys)))
        if new:
            data = raw.tobytes()
            where = place[new]
            parts = [data[a:b].decode("utf-8", "replace") for a, b in zip(start[where].tolist(), end[where].tolist(), strict=True)]
            for i, ids in zip(new, self._encode_new(parts), strict=True):
                self._known[keys[i]] = ids
        found = [self._known[h] for h in keys]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        each = size[which]
        return flat[ranges((np.cumsum(size) - size)[which], each)], each
