"""Suffix array by linear grouping.

Phase 1 groups the suffixes by their longest Lyndon prefix: groups are processed from the
highest to the lowest, and the previous smaller suffixes of a group's members, whose prefixes
grow by the group's word, move up behind what is left of their own groups. Phase 2 goes
through the groups from the lowest suffix on and places, behind each suffix in hand, those that
end at it. Nothing is renamed or sorted again.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of text in lexicographic order; an end sorts before any symbol."""
    n = len(text)
    if n < 2:
        return list(range(n))
    # Groups are segments of order; a suffix's group is the start of its segment.
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    start = 0
    for at, i in enumerate(order):
        if text[i] != text[order[start]]:
            start = at
        place[i], group[i] = at, start
        size[start] += 1
    smaller = [-1] * n
    end = n
    while end > 0:
        first = group[order[end - 1]]
        counts: dict[int, int] = {}
        members = order[first:end]
        if end - first > 1:
            members.sort()
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= first:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        if len(counts) == 1:
            (p, _), = counts.items()
            g = group[p]
            if size[g] > 1:
                size[g] -= 1
                to = g + size[g]
                other, at = order[to], place[p]
                order[at], place[other] = other, at
                order[to], place[p], group[p], size[to] = p, to, to, 1
        elif counts:
            moved: dict[int, list[tuple[int, int]]] = {}
            for p, times in counts.items():
                moved.setdefault(group[p], []).append((times, p))
            for g, rows in moved.items():
                # More repetitions of the group's word are larger: they go further up.
                rows.sort(reverse=True)
                to = g + size[g]
                size[g] -= len(rows)
                k = 0
                while k < len(rows):
                    times, begin = rows[k][0], k
                    while k < len(rows) and rows[k][0] == times:
                        p = rows[k][1]
                        to -= 1
                        other, at = order[to], place[p]
                        order[at], place[other] = other, at
                        order[to], place[p] = p, to
                        k += 1
                    for _, p in rows[begin:k]:
                        group[p] = to
                    size[to] = k - begin
        end = first
    # Phase 2: of each group the next free place; suffix n, the empty one, comes before all.
    free, out = [0] * n, [-1] * n
    for i in range(n):
        free[group[i]] = group[i]
    done = [False] * n
    for at in range(-1, n):
        i = n - 1 if at < 0 else out[at] - 1
        while i >= 0 and not done[i]:
            done[i] = True
            g = group[i]
            out[free[g]] = i
            free[g] += 1
            i = smaller[i]
    return out
