"""Suffix arrays by the difference-cover algorithm, in numpy."""

from __future__ import annotations

import numpy as np


def names_of(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, bool]:
    """(order, names, all names differ) of tuples given by their columns, all below 2**31."""
    key = parts[0].astype(np.int64)
    for part in parts[1:]:
        width = int(part.max(initial=0)) + 1
        if int(key.max(initial=0)) >= (1 << 62) // width:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * width + part
    order = np.argsort(key, kind="stable")
    steps = np.zeros(len(order), np.int64)
    steps[1:] = key[order[1:]] != key[order[:-1]]
    ranks = np.cumsum(steps)
    names = np.empty(len(order), np.int64)
    names[order] = ranks
    return order, names, len(order) == 0 or int(ranks[-1]) == len(order) - 1


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``s`` (integers of at least 0; a suffix that ends comes first).

    Triples at positions that leave 1 or 2 divided by three are sorted and named; if names repeat,
    the suffixes of the name string are sorted by recursion; the suffixes at the other positions are
    sorted by their first character and the next suffix's rank; and both orders are merged.
    """
    n = len(s)
    if n < 2:
        return np.arange(n)
    t = np.zeros(n + 3, np.int64)
    t[:n] = s
    t[:n] += 1
    one = np.arange(1, n + (n % 3 == 1), 3)  # with a dummy at n, so that the last triple of each kind ends in zeros
    two = np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    order, names, distinct = names_of([t[sample], t[sample + 1], t[sample + 2]])
    if not distinct:
        order = suffix_array(names)
    order = sample[order]
    rank = np.zeros(n + 3, np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    order = order[order < n]
    rest = np.arange(0, n, 3)
    width = int(rank.max()) + 1
    key = t[rest] * width + rank[rest + 1]
    by = np.argsort(key, kind="stable")
    rest, key = rest[by], key[by]
    # how many sample suffixes precede each of the rest
    first = order[order % 3 == 1]
    before = np.searchsorted(t[first] * width + rank[first + 1], key)
    second = order[order % 3 == 2]
    if int(t.max()) < (1 << 31) // width * 2 and int(t.max()) ** 2 * width < 1 << 62:
        high = int(t.max()) + 1
        pair = lambda i: (t[i] * high + t[i + 1]) * width + rank[i + 2]
        before += np.searchsorted(pair(second), pair(rest))
    else:
        both = np.unique(np.concatenate([t[second] * (int(t.max()) + 1) + t[second + 1], t[rest] * (int(t.max()) + 1) + t[rest + 1]]), return_inverse=True)[1]
        before += np.searchsorted(both[: len(second)] * width + rank[second + 2], both[len(second) :] * width + rank[rest + 2])
    out = np.empty(n, np.int64)
    at = before + np.arange(len(rest))
    out[at] = rest
    free = np.ones(n, bool)
    free[at] = False
    out[free] = order
    return out


def equal_prefixes(text: np.ndarray, ordered: np.ndarray, length: int) -> np.ndarray:
    """For each neighbouring pair of positions in suffix order: are their first ``length`` bytes equal?

    Every position must have ``length`` bytes of text.
    """
    a, b = ordered[:-1], ordered[1:]
    out = np.zeros(len(a), bool)
    alive = np.arange(len(a))
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    for at in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        if not len(alive):
            break
        same = np.ascontiguousarray(words[a[alive] + at]).view(np.uint64) == np.ascontiguousarray(words[b[alive] + at]).view(np.uint64)
        alive = alive[same[:, 0]]
    out[alive] = True
    return out
