"""Linear-time suffix sorting by grouping (Baier, 2016), on lists of integers.

Phase 1 visits groups of suffixes in descending order. All suffixes of a group
start with the group's context, a Lyndon word. Each finds its previous smaller
suffix, the nearest one to the left that lies in a lower group; those pointed at are
followed by the context, so they split off their group upwards, the more often
they are pointed at the higher. Phase 2 walks the suffix array from its start and
emits every group's members in order along the same pointers. Nothing is renamed
or sorted again."""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of non-negative integers below some bound; a virtual smallest end symbol is implied."""
    n = len(text)
    if not n:
        return []
    # Position n is the end symbol. Groups are ranges of the rank space: a group's
    # name is the rank of its first member, so names compare as the groups do.
    size: dict[int, int] = {}
    for c in text:
        size[c] = size.get(c, 0) + 1
    start, at = {}, 1
    for c in sorted(size):
        start[c] = at
        at += size[c]
    group = [start[c] for c in text]
    group.append(0)
    count = [0] * (n + 1)  # members of the group that starts at this rank
    for c, s in start.items():
        count[s] = size[c]
    count[0] = 1
    order = [0] * (n + 1)  # members by rank, unordered inside a group
    place = [0] * (n + 1)
    fill = dict(start)
    for i, c in enumerate(text):
        r = fill[c]
        order[r] = i
        place[i] = r
        fill[c] = r + 1
    order[0], place[n] = n, 0
    prev = [-1] * (n + 1)
    end = n  # last rank of the group in hand
    while end >= 0:
        first = group[order[end]]
        members = order[first:end + 1]
        members.sort()
        hits: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= first:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                hits[j] = hits.get(j, 0) + 1
        if hits:
            levels: dict[int, list[int]] = {}
            for j, k in hits.items():
                levels.setdefault(k, []).append(j)
            for k in sorted(levels, reverse=True):
                split: dict[int, list[int]] = {}
                for j in levels[k]:
                    split.setdefault(group[j], []).append(j)
                for g, js in split.items():
                    m = count[g]
                    if len(js) == m:
                        continue  # the whole group moves: nothing to split
                    new = g + m - len(js)
                    r = g + m - 1
                    for j in js:  # swap to the upper end of the group
                        other, p = order[r], place[j]
                        order[p], place[other] = other, p
                        order[r], place[j] = j, r
                        r -= 1
                    for j in js:
                        group[j] = new
                    count[g], count[new] = m - len(js), len(js)
        end = first - 1
    out = [0] * (n + 1)
    out[0] = n
    free = [i for i in range(n + 1)]  # next free rank of the group that starts here
    done = [False] * (n + 1)
    for r in range(n + 1):
        j = out[r] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            done[j] = True
            j = prev[j]
    return out[1:]
