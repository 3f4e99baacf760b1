"""Words of many texts as numpy arrays: 64-bit hashes computed from one running
sum over the bytes instead of one Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at a time (a longer word makes a longer piece).
PIECE = 1 << 18

_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n + 1:
        size = max(n + 1, PIECE + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _hash_piece(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a byte array, and where they start."""
    space = _SPACE[raw]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers(len(raw))
    run = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUE[_LOWER[raw]] * up, out=run[1:])
    return mix((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64)), start


def words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, row ends) of runs of rows: the lower-cased (A-Z)
    words of row ``first + i`` are ``hashes[ends[i]:ends[i + 1]]``. Nulls have
    no words."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    first = 0
    while first < len(column):
        last = first + 1
        while last < len(column) and offsets[last + 1] - offsets[first] <= PIECE:
            last += 1
        a, b = int(offsets[first]), int(offsets[last])
        if last == first + 1 and b - a > PIECE:
            hashes = np.concatenate([_hash_piece(p)[0] for p in _pieces(data[a:b])])
            yield first, hashes, np.array([0, len(hashes) if valid[first] else 0])
        else:
            # A gap between rows keeps the words of neighbours apart.
            size = np.where(valid[first:last], np.diff(offsets[first:last + 1]), 0)
            raw = np.full(int(size.sum()) + last - first, 32, np.uint8)
            begin = np.concatenate(([0], np.cumsum(size + 1)))
            source = np.repeat(offsets[first:last] - begin[:-1], size)
            at = np.arange(len(raw))[np.repeat(np.ones(last - first, bool), size + 1)]
            inside = np.ones(len(raw), bool)
            inside[begin[1:] - 1] = False
            at = at[inside]
            raw[at] = data[at + source]
            hashes, start = _hash_piece(raw)
            yield first, hashes, np.searchsorted(start, begin)
        first = last


def _pieces(raw: np.ndarray) -> Iterator[np.ndarray]:
    """Cut a long text at white space."""
    at = 0
    while at < len(raw):
        end = min(at + PIECE, len(raw))
        while end < len(raw):
            stop = np.flatnonzero(_SPACE[raw[end:end + PIECE]])
            if len(stop):
                end += int(stop[0])
                break
            end = min(end + PIECE, len(raw))
        yield raw[at:end]
        at = end
