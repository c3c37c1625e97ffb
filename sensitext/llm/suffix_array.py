"""Suffix sorting by linear grouping.

Suffixes are grouped by their Lyndon prefixes, highest group first: each suffix of a group
points back to the nearest suffix of a smaller group, and the suffixes pointed at move to
a new group right behind their own, those pointed at most often highest. Afterwards the
order inside the groups follows from the smallest suffix upwards along the same pointers;
nothing is renamed and nothing recurses.
"""

from __future__ import annotations


def suffix_array(text: bytes) -> list[int]:
    """Places of all suffixes of ``text`` in order; the empty suffix is left out."""
    n = len(text) + 1
    counts = [0] * 258
    counts[0] = 1
    for c in text:
        counts[c + 1] += 1
    start, total = [0] * 258, 0
    for c, k in enumerate(counts):
        start[c] = total
        total += k
    size = [0] * n
    for c, k in enumerate(counts):
        if k:
            size[start[c]] = k
    # group[i]: first place of the group that suffix i is in; at[i]: its own place.
    group = [start[c + 1] for c in text]
    group.append(0)
    order = [0] * n
    at = [0] * n
    fill = start.copy()
    for i, c in enumerate(text):
        p = fill[c + 1]
        fill[c + 1] = p + 1
        order[p] = i
        at[i] = p
    order[0] = n - 1
    before = [-1] * n

    right = n - 1
    while right > 0:
        left = group[order[right]]
        if left == right:
            i = order[right]
            j = i - 1
            while j >= 0 and group[j] >= left:
                j = before[j]
            before[i] = j
            if j >= 0:
                h = group[j]
                e = h + size[h] - 1
                if e != h:
                    p = at[j]
                    k = order[e]
                    order[p], order[e] = k, j
                    at[k], at[j] = p, e
                    size[h] -= 1
                    size[e] = 1
                    group[j] = e
            right = left - 1
            continue
        pointed: dict[int, int] = {}
        for i in sorted(order[left : right + 1]):
            j = i - 1
            while j >= 0 and group[j] >= left:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        by_count: dict[int, list[int]] = {}
        for j, k in pointed.items():
            by_count.setdefault(k, []).append(j)
        for k in sorted(by_count, reverse=True):
            moved: dict[int, list[int]] = {}
            for j in by_count[k]:
                moved.setdefault(group[j], []).append(j)
            for h, members in moved.items():
                e = h + size[h]
                new = e - len(members)
                if new == h:
                    continue
                for j in members:
                    e -= 1
                    p = at[j]
                    other = order[e]
                    order[p], order[e] = other, j
                    at[other], at[j] = p, e
                    group[j] = new
                size[h] -= len(members)
                size[new] = len(members)
        right = left - 1

    free = list(range(n))
    placed = bytearray(n)
    placed[n - 1] = 1
    out = [0] * n
    out[0] = n - 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = before[j]
    return out[1:]
