"""Words of whole texts as arrays: positions and 64-bit hashes, many texts at a time.

Used inside Arrow tasks.  A word is a run of bytes other than blank, tab, LF, VT, FF
and CR, so UTF-8 text never has to be decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit number."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 21)
        _powers = tuple(
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, base))])
            for base in (_P, _P_INVERSE)
        )
    return _powers


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or of one row."""
    size = np.frombuffer(column.buffers()[1], np.int64)[column.offset:][: len(column) + 1]
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(size, size[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield start, stop
        start = stop


def as_bytes(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as large binary; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())


class Words:
    """Words of the texts ``column[start:stop]``: ``hashes`` and the ``row`` of each.

    ``starts`` and ``ends`` are byte positions in ``data``; ``first`` has for each text
    the number of its first word, and one more entry for the end.
    """

    def __init__(self, column: pa.Array, start: int, stop: int, splits: np.ndarray | None = None):
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:]
        offsets = offsets[start: stop + 1]
        raw = column.buffers()[2]
        whole = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        self.data = data = whole[offsets[0]: offsets[-1]]
        offsets = offsets - offsets[0]
        inside = ~((data == 32) | ((data >= 9) & (data <= 13))) if splits is None else ~splits[data]
        before = np.empty(len(data), bool)
        after = np.empty(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = offsets[:-1][offsets[:-1] < offsets[1:]]
        before[edges] = False
        after[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(stop - start), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        up, down = _power_tables(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=total[1:])
        raw = (total[self.ends] - total[self.starts]) * down[self.starts]
        return mix(raw ^ (self.ends - self.starts).astype(np.uint64))


def grams(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words from each position on, and which of them lie in one text."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h = h * _P + hashes[k: m + k]
    return mix(h), row[:m] == row[n - 1:]


def sliding(values: np.ndarray, width: int, better) -> np.ndarray:
    """``better`` (minimum or maximum) of each run of ``width`` values."""
    out, span = values, 1
    while span < width:
        step = min(span, width - span)
        out = better(out[: len(out) - step], out[step:])
        span += step
    return out
