"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai common prefixes, to a fixed depth."""

from __future__ import annotations

import numpy as np


def words(text: np.ndarray, pad: int) -> np.ndarray:
    """The eight bytes from each position as one big-endian number (zeros after the end); ``pad`` more positions."""
    raw = np.zeros(len(text) + pad + 8, np.uint8)
    raw[: len(text)] = text
    out = np.zeros(len(text) + pad, np.uint64)
    for n in range(8):
        out = (out << np.uint64(8)) | raw[n: n + len(out)]
    return out


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``(sa, rank)``: positions sorted by their next ``depth`` bytes (zeros after the end).

    Starts with groups of equal eight bytes.  Each round refines a group by the rank of
    the suffixes ``step`` places on, which doubles the sorted depth; groups of one are
    done and leave the rounds.  A rank is the place of the first of its group.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = words(text, 0)
    sa = np.argsort(first, kind="stable")
    new = np.r_[True, first[sa][1:] != first[sa][:-1]]
    rank = np.empty(n + depth + 1, np.int64)
    rank[n:] = -1  # after the end
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 8
    while h < depth:
        step = min(h, depth - h)
        size = np.bincount(rank[:n], minlength=n)
        active = sa[size[rank[sa]] > 1]  # in group order
        if not len(active):
            break
        group, second = rank[active], rank[active + step]
        order = np.lexsort((second, group))
        active, group, second = active[order], group[order], second[order]
        fresh = np.r_[True, group[1:] != group[:-1]]
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(active)), 0))
        place = group + np.arange(len(active)) - start
        split = fresh | np.r_[True, second[1:] != second[:-1]]
        sa[place] = active
        rank[active] = np.maximum.accumulate(np.where(split, place, 0))
        h += step
    return sa, rank[:n]


def common_prefix(word: np.ndarray, p: np.ndarray, q: np.ndarray, known: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``p`` and ``q`` up to ``depth``, of which ``known`` are equal."""
    out = known.astype(np.int64)
    todo = np.flatnonzero(out < depth)
    while len(todo):
        at = out[todo]
        diff = word[p[todo] + at] ^ word[q[todo] + at]
        same = np.full(len(todo), 8)
        odd = diff != 0
        # leading zero bytes of the difference
        d = diff[odd]
        lead = np.zeros(len(d), np.int64)
        for n in range(1, 8):
            lead += d >> np.uint64(64 - 8 * n) == 0
        same[odd] = lead
        out[todo] = np.minimum(at + same, depth)
        todo = todo[~odd & (out[todo] < depth)]
    return out


def kasai(text: np.ndarray, sa: np.ndarray, depth: int, stride: int = 16) -> np.ndarray:
    """Common prefix (up to ``depth``) of each suffix in ``sa`` order with the one before it; 0 for the first.

    Kasai's bound, that the value at position p + d is at least the value at p less d, is
    used by halving strides: every ``stride``-th position first, then those between.  It
    holds where the order at p is decided within ``depth``; after a tie the count starts anew.
    """
    n = len(sa)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    word = words(text, 2 * depth + 8)
    value = np.zeros(n, np.int64)

    def fill(p: np.ndarray, gap: int) -> None:
        p = p[before[p] >= 0]
        known = np.zeros(len(p), np.int64)
        if gap:
            left = value[p - gap]
            known = np.where(left < depth, np.maximum(left - gap, 0), 0)
        value[p] = common_prefix(word, p, before[p], known, depth)

    fill(np.arange(0, n, stride), 0)
    while stride > 1:
        stride //= 2
        fill(np.arange(stride, n, 2 * stride), stride)
    return value[sa]
