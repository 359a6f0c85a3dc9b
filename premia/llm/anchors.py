"""Winnowed cells: a partition of a string's windows that equal windows share."""

from __future__ import annotations

import numpy as np

GRAM = 32
#: Cells to either side of an anchor.
CELLS = 2
TABLE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict = {"n": 0}


def _powers(n: int) -> tuple:
    """BASE ** i and BASE ** -i modulo 2 ** 64, i < n."""
    if _POWERS["n"] < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, BASE, np.uint64), np.full(size, INVERSE, np.uint64)
        up[0] = down[0] = 1
        _POWERS.update(n=size, up=np.multiply.accumulate(up), down=np.multiply.accumulate(down))
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Hashes:
    """64-bit hashes of any substrings of one string of bytes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(TABLE[data] * up[:-1], dtype=np.uint64)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, size: int) -> np.ndarray:
        """Of every substring of ``size`` bytes."""
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.down[:n])


def chosen_places(h: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` neighbours the place of their least value; of equal ones (in 40 bits) the leftmost."""
    n, out = len(h), []
    piece = 1 << 23
    for a in range(0, n - width + 1, piece):  # a place within a piece takes 24 bits
        part = h[a : a + piece + width - 1]
        key = (part & ~np.uint64((1 << 24) - 1)) | np.arange(len(part), dtype=np.uint64)
        full = np.full(-(-len(part) // width) * width, ~np.uint64(0))
        full[: len(part)] = key
        blocks = full.reshape(-1, width)
        head = np.minimum.accumulate(blocks, axis=1).ravel()
        tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(tail[: len(part) - width + 1], head[width - 1 : len(part)])
        out.append((least & np.uint64((1 << 24) - 1)).astype(np.int64) + a)
    return np.concatenate(out)


def cells(data: np.ndarray, length: int) -> tuple:
    """(key, whole, first, last) of the cells of a string of at least ``length`` bytes.

    A window's anchor is the least gram in it, which is a matter of its bytes alone. Windows of an anchor whose offset lies in the same
    part of the possible ones form a cell, first .. last. ``key`` hashes bytes that all windows of such a cell contain, so
    equal windows lie in cells of equal key; ``whole`` hashes all bytes of the cell's windows and where the anchor is.
    """
    hashes = Hashes(data)
    place = chosen_places(hashes.all(GRAM), length - GRAM + 1)
    at = np.arange(len(place))
    wide = -(-(length - GRAM + 1) // CELLS)
    part = (place - at) // wide
    change = np.flatnonzero((place[1:] != place[:-1]) | (part[1:] != part[:-1])) + 1
    first = np.concatenate(([0], change))
    last = np.concatenate((change - 1, [len(place) - 1]))
    anchor, part = place[first], part[first]
    least, most = part * wide, np.minimum(part * wide + wide, length - GRAM + 1) - 1  # offsets of the anchor
    key = mixed(hashes.of(anchor - least, anchor - most + length) + part.astype(np.uint64))
    whole = mixed(hashes.of(first, last + length) + (anchor - first).astype(np.uint64))
    return key, whole, first, last
