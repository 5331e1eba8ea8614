"""Suffix array by grouping on Lyndon prefixes, in linear time and without renaming.

First all suffixes are grouped by their first value. The groups are visited in descending
order. A visited suffix gets its previous-smaller pointer: the nearest suffix before it in
a lower group. Suffixes that are pointed at from the visited group k times have k more
copies of its prefix behind their own, so they leave their group for one right above it,
most copies first. When all groups have been visited, suffixes share a group exactly when
they share their Lyndon prefix, and the groups are in order.

Then the array is filled from the least suffix on: the suffix before each entry goes to the
next free place of its group, and so do its previous-smaller ancestors, until one is placed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of all suffixes of ``text`` (non-negative numbers) in ascending order."""
    n = len(text)
    if n == 0:
        return []
    values = np.asarray(text)
    sorted_ = np.argsort(values, kind="stable")
    new = np.ones(n, bool)
    new[1:] = values[sorted_[1:]] != values[sorted_[:-1]]
    begins = np.flatnonzero(new)
    place, head, last = np.zeros(n, int), np.zeros(n, int), np.zeros(n + 1, int)
    place[sorted_] = np.arange(n)
    head[sorted_] = begins[np.cumsum(new) - 1]  # of a suffix: where its group begins
    last[begins] = np.append(begins[1:], n) - 1  # of a group, by its begin: where it ends
    groups = head.tolist()
    smaller = group_by_lyndon_prefix(sorted_.tolist(), place.tolist(), groups, last.tolist())
    return emit(n, groups, smaller)


def group_by_lyndon_prefix(order: list[int], place: list[int], head: list[int], last: list[int]) -> list[int]:
    """Refine the groups in place; returns the previous-smaller pointers (-1: none)."""
    smaller = [-1] * len(order)
    end = len(order) - 1
    while end >= 0:
        begin = head[order[end]]
        counts: dict[int, int] = {}
        for i in sorted(order[begin : end + 1]) if end > begin else (order[begin],):
            j = i - 1
            # Higher groups have been visited and lead further back; so do earlier suffixes of this one.
            while j >= 0 and head[j] >= begin:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                counts[j] = counts.get(j, 0) + 1
        if counts:
            split(counts, order, place, head, last)
        end = begin - 1
    return smaller


def split(counts: dict[int, int], order: list[int], place: list[int], head: list[int], last: list[int]) -> None:
    """Move suffixes right above the rest of their group, those with the greatest counts first."""
    parts: dict[tuple[int, int], list[int]] = {}
    for j, k in counts.items():
        parts.setdefault((-k, head[j]), []).append(j)
    for (_, begin), members in sorted(parts.items()) if len(parts) > 1 else parts.items():
        top = end = last[begin]
        if end - begin + 1 == len(members):
            continue
        for j in members:
            at, other = place[j], order[top]
            order[at], order[top] = other, j
            place[other], place[j] = at, top
            top -= 1
        last[begin] = top
        last[top + 1] = end
        for j in members:
            head[j] = top + 1


def emit(n: int, head: list[int], smaller: list[int]) -> list[int]:
    """Fill the array from the least suffix on."""
    out = [-1] * n
    free = list(range(n))  # of a group, by its begin: the next free place
    placed = [False] * n
    # The suffix behind the text is the empty one; it is the least.
    for rank in range(-1, n):
        j = (n if rank < 0 else out[rank]) - 1
        while j >= 0 and not placed[j]:
            begin = head[j]
            out[free[begin]] = j
            free[begin] += 1
            placed[j] = True
            j = smaller[j]
    return out
