"""Suffix order of a block of bytes by linear grouping.

Suffixes start in groups by their first symbol. Groups are handled in descending order: every member's nearest suffix
to the left that lies in a lower group is its previous smaller one, found by following earlier pointers. A suffix that
is the pointer of some members of the group is continued by the group's prefix as often as it has such members, so it
moves behind the rest of its own group, the more often the further. In the end each group has one Lyndon prefix. The
order inside the groups is then emitted in one pass: each suffix in its final place sends the chain of its
left neighbours to the next free places of their groups. No name is ever replaced by a rank.
"""

from __future__ import annotations

from itertools import accumulate


def grouped_by_prefix(symbols: list[int]) -> tuple[list[int], list[int]]:
    """The first place of each suffix's group, and each suffix's previous smaller one (-1 if there is none)."""
    n = len(symbols)
    members: dict[int, list[int]] = {}
    for i, s in enumerate(symbols):
        members.setdefault(s, []).append(i)
    starts = dict(zip(sorted(members), accumulate([0, *(len(members[s]) for s in sorted(members))])))
    group = [starts[s] for s in symbols]
    members = {starts[s]: m for s, m in members.items()}
    start_of_end = {start + len(m): start for start, m in members.items()}
    end_of_start = {start: end for end, start in start_of_end.items()}
    previous = [-1] * n
    end = n
    while end:
        start = start_of_end[end]
        counts: dict[int, int] = {}
        for i in members[start]:
            if group[i] != start:
                continue  # it has moved behind its old group
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                counts[j] = counts.get(j, 0) + 1
        if counts:
            moved: dict[tuple[int, int], list[int]] = {}
            for j, times in counts.items():
                moved.setdefault((times, group[j]), []).append(j)
            for times, old in sorted(moved, reverse=True):
                js = moved[times, old]
                old_end = end_of_start[old]
                new = old_end - len(js)
                if new == old:
                    continue  # the whole group moves together
                js.sort()
                for j in js:
                    group[j] = new
                members[new] = js
                end_of_start[new], end_of_start[old] = old_end, new
                start_of_end[old_end], start_of_end[new] = new, old
        end = start
    return group, previous


def suffix_order(text: bytes) -> list[int]:
    """Start positions of all suffixes in ascending order; a suffix that is a prefix of another comes first."""
    if not text:
        return []
    symbols = [b + 1 for b in text]
    symbols.append(0)
    group, previous = grouped_by_prefix(symbols)
    n = len(symbols)
    free = list(range(n))  # by a group's first place, its next free one
    order = [-1] * n
    order[0] = n - 1
    placed = bytearray(n)
    placed[n - 1] = 1
    for at in range(n):
        i = order[at] - 1
        while i >= 0 and not placed[i]:
            start = group[i]
            order[free[start]] = i
            free[start] += 1
            placed[i] = 1
            i = previous[i]
    return order[1:]
