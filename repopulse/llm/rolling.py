"""Rolling hashes of byte strings, and the anchors that stand for all windows of a length."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Starts handled at a time; positions within fit into the low bits of a 64-bit key.
CHUNK = 1 << 16
_PLACE_BITS = 20
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers, one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_LETTERS = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Hashes of all strings of a piece of bytes, from one pass over it."""

    _up = _powers(_BASE, CHUNK + 4096)
    _down = _powers(_INVERSE, CHUNK + 4096)

    def __init__(self, piece: np.ndarray) -> None:
        if len(piece) > len(self._up):
            type(self)._up = Rolling._up = _powers(_BASE, 2 * len(piece))
            type(self)._down = Rolling._down = _powers(_INVERSE, 2 * len(piece))
        self._sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_LETTERS[piece] * self._up[: len(piece)], out=self._sums[1:])

    def each(self, width: int) -> np.ndarray:
        """The hash of every string of ``width`` bytes, by its start."""
        n = len(self._sums) - width
        return mix((self._sums[width:] - self._sums[:n]) * self._down[:n])

    def some(self, start: np.ndarray, width: np.ndarray) -> np.ndarray:
        """Hashes of single strings; those of different length differ."""
        raw = (self._sums[start + width] - self._sums[start]) * self._down[start]
        return mix(raw + mix(width.astype(np.uint64)))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


@dataclass
class Anchors:
    """Runs of neighbouring starts whose windows share an anchor.

    start, count: the starts of a run. place: the anchor's distance from the first. suffix: hash of the
    anchor's prefix. run: hash of all bytes that the run's windows cover, and of the anchor's place in them.
    """

    start: np.ndarray
    count: np.ndarray
    place: np.ndarray
    suffix: np.ndarray
    run: np.ndarray


def anchors(data: bytes, width: int, prefix: int) -> Anchors:
    """The sampled suffixes of ``data``: each window of ``width`` bytes is stood for by one suffix that starts in it.

    It is the window's leftmost ``prefix``-byte string of least hash, so equal windows are stood for by
    suffixes at equal places. Neighbouring windows mostly share theirs.
    """
    whole = np.frombuffer(data, np.uint8)
    starts = len(whole) - width + 1
    found: list[tuple[np.ndarray, ...]] = []
    for low in range(0, max(0, starts), CHUNK):
        n = min(CHUNK, starts - low)
        rolling = Rolling(whole[low : low + n + width - 1])
        hashed = rolling.each(prefix)
        keys = (hashed & ~_PLACE) | np.arange(len(hashed), dtype=np.uint64)
        place = (_sliding_least(keys, width - prefix + 1) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        count = np.diff(np.append(first, n))
        anchor = place[first]
        run = mix(rolling.some(first, count + (width - 1)) ^ (anchor - first).astype(np.uint64))
        found.append((first + low, count, anchor - first, hashed[anchor], run))
    if not found:
        empty = np.zeros(0, np.int64)
        return Anchors(empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64))
    return Anchors(*map(np.concatenate, zip(*found, strict=True)))


def window_hashes(piece: bytes, width: int) -> np.ndarray:
    """The hash of every window of ``width`` bytes."""
    return Rolling(np.frombuffer(piece, np.uint8)).each(width)
