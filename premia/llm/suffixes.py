"""Suffix arrays by induced sorting, and permuted common prefixes, on whole arrays at a time.

Suffixes are classified; the leftmost-smaller (LMS) substrings are sorted by one induction and named; the order of
the LMS suffixes, which is that of the string of names, is found by doubling ranks until as many characters as asked
for are decided; a second induction gives the shard's array. An induction goes through the buckets of first characters
in order and handles all entries of a bucket that are known at once, instead of one by one.
"""

from __future__ import annotations

import numpy as np


def classify(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S); the last character is a unique least one."""
    n = len(t)
    differs = np.flatnonzero(t[:-1] != t[1:])
    after = np.searchsorted(differs, np.arange(n - 1))
    small = np.ones(n, bool)
    at = differs[after]
    small[:-1] = t[at] < t[at + 1]
    return small


def _deal(preds: np.ndarray, chars: np.ndarray, lists: list) -> None:
    """Appends the entries to the lists of their characters, in order."""
    if not len(preds):
        return
    order = np.argsort(chars, kind="stable")
    preds, chars = preds[order], chars[order]
    cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
    starts = [0, *cuts.tolist(), len(preds)]
    for a, b in zip(starts, starts[1:]):
        lists[chars[a]].append(preds[a:b])


def induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array induced from the LMS suffixes, which are given in order (of first characters at least)."""
    large_lists: list = [[] for _ in range(sigma)]
    lms_lists: list = [[] for _ in range(sigma)]
    small_lists: list = [[] for _ in range(sigma)]
    _deal(lms, t[lms], lms_lists)

    def handle(entries, lists, kind):
        preds = entries[entries > 0] - 1
        preds = preds[small[preds] == kind]
        _deal(preds, t[preds], lists)

    for c in range(sigma):
        i = 0
        while i < len(large_lists[c]):  # grows while a bucket induces into itself
            handle(large_lists[c][i], large_lists, False)
            i += 1
        for entries in lms_lists[c]:
            handle(entries, large_lists, False)
    none = np.zeros(0, lms.dtype)
    large = [np.concatenate(x) if x else none for x in large_lists]
    for c in reversed(range(sigma)):
        i = 0
        while i < len(small_lists[c]):
            handle(small_lists[c][i], small_lists, True)
            i += 1
        handle(large[c][::-1], small_lists, True)
    small_lists[int(t[-1])].append(np.array([len(t) - 1], lms.dtype))  # nothing induces the last suffix
    out = []
    for c in range(sigma):
        out.append(large[c])
        if small_lists[c]:
            out.append(np.concatenate(small_lists[c])[::-1])
    return np.concatenate(out)


def names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the LMS substrings, in text order; equal substrings have equal ranks."""
    n = len(lms)
    place = np.zeros(len(t), np.int64)
    place[lms] = np.arange(n)
    length = np.append(lms[1:] - lms[:-1] + 1, 1)[place[ordered]]
    a, b = ordered[:-1].astype(np.int64), ordered[1:].astype(np.int64)
    same = np.zeros(n - 1, bool)
    left = np.flatnonzero(length[:-1] == length[1:])
    step = 0
    while len(left):
        left = left[t[a[left] + step] == t[b[left] + step]]
        done = length[left] == step + 1
        same[left[done]] = True
        left, step = left[~done], step + 1
    ranks = np.zeros(n, np.int64)
    ranks[place[ordered]] = np.concatenate(([0], np.cumsum(~same)))
    return ranks


def suffix_array(t: np.ndarray, sigma: int, decided: int | None = None) -> np.ndarray:
    """Suffixes in order, at least by their first ``decided`` characters (None: by all). t ends in a unique least character."""
    small = classify(t)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int64)
    if len(lms) > 1:
        first = induce(t, small, lms, sigma)
        is_lms = np.zeros(len(t), bool)
        is_lms[lms] = True
        ranks = names(t, lms, first[is_lms[first]])
        span = 1  # names in a rank; each is of one character or more beyond the one it shares with the next
        while ranks.max() + 1 < len(lms) and (decided is None or span < decided):
            behind = np.concatenate((ranks[span:] + 1, np.zeros(min(span, len(ranks)), np.int64)))[: len(ranks)]
            ranks = np.unique(ranks * (len(lms) + 2) + behind, return_inverse=True)[1]
            span *= 2
        lms = lms[np.argsort(ranks, kind="stable")]
    return induce(t, small, lms, sigma)


def permuted_prefixes(t: np.ndarray, sa: np.ndarray, most: int, starts: np.ndarray | None = None) -> tuple:
    """(plcp, phi): the common prefix of each suffix with the one before it in the array, up to ``most``, and that suffix (-1: none).

    Only where phi does not simply move on are characters compared, and at ``starts``; elsewhere the prefix is one shorter than at the place before.
    """
    n = len(t)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    fresh = np.ones(n, bool)
    fresh[1:] = phi[1:] != phi[:-1] + 1
    if starts is not None:
        fresh[starts] = True
    fresh[np.flatnonzero(phi < 0)] = True
    fresh[np.flatnonzero(phi[:-1] < 0) + 1] = True
    wide = np.concatenate((t.astype(np.uint64), np.zeros(most + 8, np.uint64)))
    four = wide[:-3] << np.uint64(48) | wide[1:-2] << np.uint64(32) | wide[2:-1] << np.uint64(16) | wide[3:]
    at = np.flatnonzero(fresh & (phi >= 0))
    prefix = np.zeros(n, np.int64)
    left, step = at, 0
    while len(left) and step < most:
        same = four[left + step] == four[phi[left] + step]
        end = left[~same]
        if len(end):
            more = np.zeros(len(end), np.int64)
            going = np.ones(len(end), bool)
            for k in range(3):
                going &= wide[end + step + k] == wide[phi[end] + step + k]
                more += going
            prefix[end] = step + more
        left, step = left[same], step + 4
    prefix[left] = most
    last = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    return np.maximum(prefix[last] - (np.arange(n) - last), 0), phi


def repeated(parts: list, length: int) -> list:
    """For each part (bytes), a mask over its windows of ``length`` bytes: True if the window occurs again in this or another part."""
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    t = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.uint16) + np.uint16(2)
    t[ends - 1] = 1  # between two parts: no byte
    t = np.append(t, np.uint16(0))
    most = int(sizes.max()) + length
    sa = suffix_array(t, 258, length)
    plcp, phi = permuted_prefixes(t, sa, most, starts)
    hit = plcp >= length
    hit[phi[np.flatnonzero(hit)]] = True
    return [hit[a : a + max(0, n - length + 1)] for a, n in zip(starts.tolist(), sizes.tolist())]
