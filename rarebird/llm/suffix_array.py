"""Suffix sorting by linear grouping (no recursion, no renaming).

Phase 1 puts suffixes into groups by their Lyndon prefix, kept in lexicographic order. Groups are
taken in descending order. For each suffix of the taken group the nearest earlier suffix of a lower
group is found along previous-smaller pointers; the suffixes so reached are extended by the group's
Lyndon word, once for each suffix that reaches them, so they leave their group for new groups right
behind it, those extended more often further behind. Phase 2 emits suffixes in ascending order: each
emitted suffix lets the suffixes that end just before it, found along the same pointers, take the
next free place of their groups.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def suffix_array(symbols: Sequence[int]) -> np.ndarray:
    """Starts of the suffixes in lexicographic order; a suffix sorts before those it is a prefix of."""
    text = list(symbols)
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)

    # groups by first symbol, as a list linked from the highest to the lowest
    order = np.argsort(np.asarray(text), kind="stable").tolist()
    members: list[list[int]] = []
    group = [0] * n  # of each suffix; the highest number of a taken group does not change any more
    last = None
    for i in order:
        if text[i] != last:
            members.append([])
            last = text[i]
        members[-1].append(i)
        group[i] = len(members) - 1
    lower = list(range(-1, len(members) - 1))  # the next lower group
    higher = list(range(1, len(members) + 1))
    higher[-1] = -1
    size = [len(m) for m in members]

    def insert(below: int, new: int) -> None:
        above_ = higher[below]
        lower.append(below)
        higher.append(above_)
        lower[above_] = higher[below] = new

    done = bytearray(n)
    prev = [-1] * n
    taken: list[int] = []
    g = len(members) - 1
    while g >= 0:
        mine = members[g]
        if size[g] != len(mine):
            mine = [i for i in mine if group[i] == g]
        if not mine:
            g = lower[g]
            continue
        if len(mine) == 1:
            i = mine[0]
            p = i - 1
            while p >= 0 and done[p]:
                p = prev[p]
            prev[i] = p
            done[i] = 1
            if p >= 0:
                # p alone is extended: a group of its own right behind its group
                h = group[p]
                if size[h] > 1:
                    size[h] -= 1
                    size.append(1)
                    members.append([p])
                    new = len(members) - 1
                    group[p] = new
                    insert(h, new)
        else:
            mine.sort()
            reached: dict[int, int] = {}
            for i in mine:
                p = i - 1
                while p >= 0:
                    if done[p]:
                        p = prev[p]
                    elif group[p] == g:
                        p = prev[p]  # ascending order: set already
                    else:
                        break
                prev[i] = p
                if p >= 0:
                    reached[p] = reached.get(p, 0) + 1
            for i in mine:
                done[i] = 1
            split: dict[tuple[int, int], list[int]] = {}
            for p, times in reached.items():
                split.setdefault((group[p], times), []).append(p)
            above: dict[int, list[tuple[int, list[int]]]] = {}
            for (h, times), ps in split.items():
                above.setdefault(h, []).append((times, ps))
            for h, parts in above.items():
                parts.sort()
                moved = sum(len(ps) for _, ps in parts)
                if moved == size[h]:  # the least extended ones keep the group
                    moved -= len(parts[0][1])
                    members[h] = parts[0][1]
                    parts = parts[1:]
                size[h] -= moved
                below = h
                for _, ps in parts:
                    size.append(len(ps))
                    members.append(ps)
                    new = len(members) - 1
                    for p in ps:
                        group[p] = new
                    insert(below, new)
                    below = new
        taken.append(g)
        members[g] = mine
        g = lower[g]

    # places: groups in ascending order
    place = [0] * len(members)
    at = 0
    for g in reversed(taken):
        place[g] = at
        at += len(members[g])
    out = [0] * n
    placed = bytearray(n)
    s = n - 1  # as if the empty suffix had been emitted
    k = -1
    while True:
        while s >= 0 and not placed[s]:
            g = group[s]
            out[place[g]] = s
            place[g] += 1
            placed[s] = 1
            s = prev[s]
        k += 1
        if k == n:
            break
        s = out[k] - 1
    return np.array(out, np.int64)
