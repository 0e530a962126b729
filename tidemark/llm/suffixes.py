"""Suffix arrays by linear grouping, without recursive renaming.

Suffixes start out grouped by their first symbol. Groups are taken from the highest down:
each suffix of a group points to the nearest suffix to its left in a lower group, its
previous smaller one; suffixes that are pointed to equally often move to a group of their
own, right above the rest of their old one. In the end a group holds the suffixes with one
Lyndon prefix. Then the order inside the groups follows from a single scan of the array as
it fills: the suffixes whose next smaller suffix is the one just met are found along the
same pointers.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``symbols`` (non-negative integers) in ascending order."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    order = np.argsort(symbols, kind="stable")
    sorted_symbols = np.asarray(symbols)[order]
    starts = np.flatnonzero(np.append(True, sorted_symbols[1:] != sorted_symbols[:-1]))
    size_at = np.diff(np.append(starts, n))
    at = order.tolist()  # suffixes, group after group
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    place = place.tolist()
    group = np.empty(n, np.int64)  # where a suffix's group starts
    group[order] = np.repeat(starts, size_at)
    group = group.tolist()
    size = [0] * n
    for s, z in zip(starts.tolist(), size_at.tolist()):
        size[s] = z
    smaller = [-1] * n

    end = n
    while end:
        start = group[at[end - 1]]
        pointed: dict[int, int] = {}
        for i in sorted(at[start:end]):
            p = i - 1
            while p >= 0:
                g = group[p]
                if g < start:
                    break
                p = smaller[p]  # same group, to the left and known already, or a higher one
            smaller[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        end = start
        if not pointed:
            continue
        times: dict[int, list[int]] = {}
        for p, count in pointed.items():
            times.setdefault(count, []).append(p)
        for count in sorted(times, reverse=True):
            moved = times[count]
            touched: dict[int, int] = {}
            for p in moved:
                g = group[p]
                touched[g] = touched.get(g, 0) + 1
                last = g + size[g] - touched[g]
                here, other = place[p], at[last]
                at[here], at[last] = other, p
                place[other], place[p] = here, last
            for g, number in touched.items():
                size[g] -= number
            for p in moved:
                g = group[p]
                group[p] = g + size[g]
            for g, number in touched.items():
                size[g + size[g]] = number

    # The first suffix is the last symbol's own group front: what follows the text sorts lowest.
    result = [0] * n
    following = list(range(n))  # next free place of the group that starts here
    done = bytearray(n)
    s = n - 1
    i = -1
    while True:
        while s >= 0 and not done[s]:
            done[s] = 1
            g = group[s]
            result[following[g]] = s
            following[g] += 1
            s = smaller[s]
        i += 1
        if i == n:
            break
        s = result[i] - 1
    return np.array(result, np.int64)
