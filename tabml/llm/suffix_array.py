"""Two-stage suffix sorting of a byte string in numpy, to a given depth.

Suffixes smaller than their successors are sorted directly. All others are
induced: scanning the buckets of first bytes in ascending order, the suffix
before each one met, if it is larger than its successor, is next in the front
part of its own bucket (Itoh and Tanaka, 1999). Only wanted suffixes take part.
"""

from __future__ import annotations

import numpy as np


def words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as a big-endian number; ``text`` has spare bytes behind."""
    return np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))[at].astype(np.uint64)


def descending(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is larger than its successor (equal bytes: as the next one; the last is)."""
    n = len(text)
    at = np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64)
    differs = np.append(text[:-1] != text[1:], True)
    down = np.append(text[:-1] > text[1:], True)
    nxt = np.minimum.accumulate(np.where(differs, at, at.dtype.type(n - 1))[::-1])[::-1]
    return down[nxt]


def _direct(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by their first ``depth`` bytes; only ties are looked at again, eight bytes on."""
    order = at[np.argsort(words(text, at), kind="stable")]
    key = words(text, order)
    group = np.cumsum(np.r_[True, key[1:] != key[:-1]]) if len(order) else np.empty(0, int)
    for k in range(8, depth, 8):
        tied = np.zeros(len(order), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        open_ = np.flatnonzero(tied)
        if not len(open_):
            break
        part = order[open_]
        key = words(text, part + k)
        by = np.lexsort((key, group[open_]))
        order[open_] = part[by]
        key, g = key[by], group[open_]
        # groups keep their numbers' order: a new number wherever group or key changes
        new = np.zeros(len(order), bool)
        new[open_] = np.r_[False, (key[1:] != key[:-1]) & (g[1:] == g[:-1])]
        group = np.cumsum(np.r_[True, group[1:] != group[:-1]] | new)
    return order


def two_stage(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions in the order of their suffixes, exact to ``depth`` bytes.

    ``text``: uint8, with at least ``depth`` spare bytes behind the last wanted
    position; ``wanted``: a mask of its length.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)])
    falls = descending(text)
    # an induced suffix needs its successor, up to one that is sorted directly
    ends = np.flatnonzero(wanted & falls & ~np.append(wanted[1:], False))
    rises = np.append(np.flatnonzero(~falls), n - 1)
    stop = rises[np.searchsorted(rises, ends)]
    mark = np.zeros(n + 1, np.int32)
    np.add.at(mark, ends + 1, 1)
    np.add.at(mark, stop + 1, -1)
    need = wanted | (np.cumsum(mark[:-1]) > 0)

    direct = _direct(padded, np.flatnonzero(need & ~falls), depth)
    first = text[direct]
    cuts = np.searchsorted(first, np.arange(257))
    front: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []
    if need[-1]:  # the last suffix is the smallest of its bucket
        front[text[-1]].append(np.array([n - 1]))

    def induce(met: np.ndarray, c: int) -> np.ndarray:
        """Deals the larger predecessors to their buckets; returns those of the bucket ``c`` itself."""
        p = met[met > 0] - 1
        p = p[need[p] & falls[p] & (text[p] >= c)]
        if not len(p):
            return p
        ch = text[p]
        by = np.argsort(ch, kind="stable")
        p, ch = p[by], ch[by]
        edge = np.flatnonzero(np.r_[True, ch[1:] != ch[:-1]])
        own = p[:0]
        for a, b in zip(edge, [*edge[1:], len(p)], strict=True):
            if ch[a] == c:
                own = p[a:b]
            else:
                front[ch[a]].append(p[a:b])
        return own

    for c in range(256):
        met = np.concatenate(front[c]) if front[c] else np.empty(0, np.int64)
        front[c] = []
        while len(met):
            out.append(met)
            met = induce(met, c)
        met = direct[cuts[c]:cuts[c + 1]]
        if len(met):
            out.append(met)
            induce(met, c)
    order = np.concatenate(out) if out else np.empty(0, np.int64)
    return order[wanted[order]]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """``text`` has ``depth`` + 8 spare bytes. Length of the common prefix of each position in ``order`` with the one before, ``depth`` at most (first: 0)."""
    a, b = order[:-1], order[1:]
    lcp, open_ = np.zeros(len(order), np.int64), np.arange(1, len(order))
    for k in range(0, depth, 8):
        if not len(open_):
            break
        x = words(text, a[open_ - 1] + k) ^ words(text, b[open_ - 1] + k)
        # bytes before the first difference: leading zero bits of the difference
        same = np.where(x == 0, 8, 0)
        for j in range(7, 0, -1):
            same = np.where((x >> np.uint64(8 * (8 - j))) == 0, np.maximum(same, j), same)
        lcp[open_] = k + same
        open_ = open_[x == 0]
    return np.minimum(lcp, depth)
