"""Suffix arrays by linear grouping along Lyndon prefixes.

The suffixes are first grouped by their first symbol. Groups are taken from
the highest to the lowest; each suffix of a group looks up the nearest
smaller position before it (skipping over higher groups by the pointers found
so far), and the positions found move behind their own group, those found
most often highest. When all groups are done, every group holds the suffixes
with one Lyndon prefix, and the order inside the groups follows from one walk
over the array. Nothing is renamed and nothing is solved recursively.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """The start positions of all suffixes of ``symbols`` (each at least 1) in ascending order."""
    text = [*symbols, 0]  # the end is smaller than any symbol
    n = len(text)
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        by_symbol.setdefault(c, []).append(i)

    # A group is named by its first place in the array. Members that have
    # moved on are skipped when the group's turn comes.
    group = [0] * n
    members: dict[int, list[int]] = {}
    last_of: dict[int, int] = {}
    first_of: dict[int, int] = {}

    def settle(first: int, last: int, positions: list[int]) -> None:
        for i in positions:
            group[i] = first
        members[first] = positions
        last_of[first] = last
        first_of[last] = first

    at = 0
    for c in sorted(by_symbol):
        settle(at, at + len(by_symbol[c]) - 1, by_symbol[c])
        at = last_of[at] + 1

    smaller = [-1] * n
    place = n - 1
    while place >= 0:
        current = first_of[place]
        place = current - 1
        pointed: dict[int, int] = {}
        for i in members.pop(current):
            if group[i] != current:
                continue
            j = i - 1
            while j >= 0 and group[j] >= current:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        by_count: dict[int, list[int]] = {}
        for j, count in pointed.items():
            by_count.setdefault(count, []).append(j)
        for count in sorted(by_count, reverse=True):
            moving: dict[int, list[int]] = {}
            for j in by_count[count]:
                moving.setdefault(group[j], []).append(j)
            for old, positions in moving.items():
                last = last_of[old]
                first = last - len(positions) + 1
                if first == old:  # the whole group moves: it stays where it is
                    continue
                last_of[old] = first - 1
                first_of[first - 1] = old
                if len(positions) > 1:
                    positions.sort()
                settle(first, last, positions)

    order = [-1] * n
    order[0] = n - 1
    placed = bytearray(n)
    placed[n - 1] = 1
    free: dict[int, int] = {}
    for i in range(n):
        j = order[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            spot = free.get(g, g)
            order[spot] = j
            free[g] = spot + 1
            placed[j] = 1
            j = smaller[j]
    return order[1:]
