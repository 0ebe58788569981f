"""Banded alignment of many pairs of word sequences at once."""

from __future__ import annotations

from collections import Counter

import numpy as np

_FAR = 1 << 28


def banded(a: list[np.ndarray], b: list[np.ndarray], t: int) -> np.ndarray:
    """Edit distances of pairs along diagonals -t..t: exact where the result is at most t."""
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    n, rows, width = len(a), int(la.max(initial=0)), 2 * t + 1
    left = np.full((n, rows), -1, np.int64)
    right = np.full((n, t + 1 + max(int(lb.max(initial=0)), rows + t) + 2), -2, np.int64)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        left[i, : len(x)] = x
        right[i, t + 1 : t + 1 + len(y)] = y
    k = np.arange(width, dtype=np.int32)
    # cell k of row i stands for place i + k - t of b
    v = np.broadcast_to(np.where(k >= t, k - t, _FAR), (n, width)).astype(np.int32)
    last = lb - la + t
    inside = (last >= 0) & (last < width)
    out = np.full(n, _FAR, np.int64)
    ends: dict[int, np.ndarray] = {int(r): np.flatnonzero(inside & (la == r)) for r in np.unique(la)}
    if 0 in ends:
        out[ends[0]] = v[ends[0], last[ends[0]]]
    for i in range(1, rows + 1):
        nxt = v + (right[:, i : i + width] != left[:, i - 1, None])
        np.minimum(nxt[:, :-1], v[:, 1:] + 1, out=nxt[:, :-1])
        nxt -= k
        np.minimum.accumulate(nxt, axis=1, out=nxt)
        nxt += k
        v = nxt
        if i in ends:
            out[ends[i]] = v[ends[i], last[ends[i]]]
    return out


def _trimmed(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sequences without their common beginning and end, which cost no edit."""
    n = min(len(x), len(y))
    apart = np.flatnonzero(x[:n] != y[:n])
    head = int(apart[0]) if len(apart) else n
    n -= head
    apart = np.flatnonzero(x[len(x) - n :] != y[len(y) - n :])
    tail = n - 1 - int(apart[-1]) if len(apart) else n
    return x[head : len(x) - tail], y[head : len(y) - tail]


def distances(a: list[np.ndarray], b: list[np.ndarray], limit: np.ndarray) -> np.ndarray:
    """Edit distance of each pair, or limit + 1 where it is above the limit.

    Bands widen fourfold for the pairs that need it, so near copies cost a few diagonals a word. Lengths and, before
    a wide band, common words give lower bounds that spare the alignment of pairs that can't pass."""
    a, b = map(list, zip(*map(_trimmed, a, b), strict=True)) if len(a) else (a, b)
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    out = limit + 1
    todo = np.flatnonzero(np.abs(la - lb) <= limit)
    t = 8
    while len(todo):
        todo = todo[np.argsort(la[todo], kind="stable")]
        rest = []
        at = 0
        while at < len(todo):
            size = 1
            while at + size < len(todo) and size < 512 and (size + 1) * (2 * t + 1) <= 1 << 16 and (size + 1) * (max(la[todo[at + size]], lb[todo[at : at + size + 1]].max()) + t) <= 1 << 20:
                size += 1
            part = todo[at : at + size]
            d = banded([a[i] for i in part], [b[i] for i in part], t)
            good = d <= np.minimum(t, limit[part])
            out[part[good]] = d[good]
            rest.append(part[~good & (limit[part] > t)])
            at += size
        todo = np.concatenate(rest)
        if len(todo) and t >= 32:
            common = [sum((Counter(a[i].tolist()) & Counter(b[i].tolist())).values()) for i in todo]
            todo = todo[np.maximum(la[todo], lb[todo]) - common <= limit[todo]]
        t *= 4
    return out
