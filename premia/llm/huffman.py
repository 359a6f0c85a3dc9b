"""Canonical length-limited Huffman codes of whole numbers: lengths, blocks of bits, table-driven decoding."""

from __future__ import annotations

import numpy as np

#: Longest code in bits. A window of 32 bits holds any code at any bit of a byte.
LIMIT = 20
#: Numbers from one checkpoint to the next.
STRIDE = 128


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal lengths of at most ``limit`` bits for the numbers 0 .. len(counts) - 1; 0: never occurs. Package-merge:
    on each level the leaves are merged with pairs of the level below; the first 2 n - 2 items of the last level count."""
    used = np.flatnonzero(counts)
    n, out = len(used), np.zeros(len(counts), np.uint8)
    if n > 1 << limit:
        raise ValueError("more numbers than codes of this length")
    if n < 2:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    items, levels = leaves, []
    for _ in range(limit):
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, packages))
        place = np.argsort(both, kind="stable")
        levels.append(place < n)
        items = both[place]
    # The last list was made for one level more than needed: the levels in use are leaves and all lists but the last.
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed([np.ones(n, bool), *levels[:-1]]):
        mine = int(is_leaf[:take].sum())
        lengths[:mine] += 1
        take = 2 * (min(take, len(is_leaf)) - mine)
    out[order] = lengths
    return out


class Codebook:
    """Canonical codes: by length, then by number."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.order = np.lexsort((np.arange(len(lengths)), lengths))
        self.order = self.order[lengths[self.order] > 0]
        sizes = lengths[self.order].astype(np.int64)
        self.limit = int(sizes.max(initial=1))
        spans = np.left_shift(1, self.limit - sizes)  # codes of the longest length that begin with this code
        firsts = np.cumsum(spans) - spans
        self.codes = np.zeros(len(lengths), np.uint32)
        self.codes[self.order] = firsts >> (self.limit - sizes)
        if spans.sum() > 1 << self.limit:
            raise ValueError("these lengths are no prefix code")
        fill = (1 << self.limit) - int(spans.sum())
        self.symbol = np.concatenate((np.repeat(self.order, spans), np.zeros(fill, np.int64))).astype(np.uint32)
        self.length = np.concatenate((np.repeat(sizes, spans), np.ones(fill, np.int64))).astype(np.int64)

    def encode(self, ids: np.ndarray, stride: int = STRIDE) -> tuple:
        """(payload, bit offsets of every ``stride``-th number)."""
        size = self.lengths[ids].astype(np.int64)
        if len(ids) and not size.all():
            raise ValueError("a number has no code")
        ends = np.cumsum(size)
        at = ends - size
        total = int(ends[-1]) if len(ids) else 0
        word = self.codes[ids].astype(np.uint64) << (32 - size - (at & 7)).astype(np.uint64)
        out = np.zeros(-(-total // 8) + 4)
        for k in range(4):  # bits of different codes never meet, so adding is joining
            part = (word >> np.uint64(24 - 8 * k)) & np.uint64(255)
            out += np.bincount((at >> 3) + k, weights=part, minlength=len(out))[: len(out)]
        return out[: -(-total // 8)].astype(np.uint8).tobytes(), at[::stride].astype("<u4").tobytes()

    def decode(self, payload: bytes, checkpoints: bytes, n: int, stride: int = STRIDE) -> np.ndarray:
        """All checkpoints at once: step j reads the j-th number after each of them."""
        data = np.concatenate((np.frombuffer(payload, np.uint8), np.zeros(8, np.uint8))).astype(np.uint32)
        window = data[:-3] << np.uint32(24) | data[1:-2] << np.uint32(16) | data[2:-1] << np.uint32(8) | data[3:]
        at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
        out = np.zeros((stride, len(at)), np.uint32)
        down = np.uint32(32 - self.limit)
        for j in range(min(stride, n)):
            code = (window[np.minimum(at >> 3, len(window) - 1)] << (at & 7).astype(np.uint32)) >> down
            out[j] = self.symbol[code]
            at += self.length[code]
        return out.T.ravel()[:n]
