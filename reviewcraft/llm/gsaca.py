"""Suffix array by grouping, without recursion or renaming.

Phase one sorts suffixes into groups by their Lyndon prefixes: groups start from the first
symbols and are processed in descending order; each member points to the nearest previous
suffix of a lower group, and pointed-to suffixes move to new groups right after their own,
the more pointers the higher. Phase two runs along the growing array and emits, for each
suffix, the chain of previous-smaller pointers before it into the front of their groups.
"""

from __future__ import annotations


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of all suffixes of ``symbols`` in ascending order.

    Symbols are integers of at least 1; an end mark, smaller than all of them, is implied.
    """
    if not symbols:
        return []
    text = [*symbols, 0]
    n = len(text)
    slots = sorted(range(n), key=text.__getitem__)
    place = [0] * n  # of each suffix in ``slots``
    group = [0] * n  # first slot of each suffix's group, which also orders the groups
    size = [0] * n  # of the group that starts at a slot
    start, symbol = 0, -1
    for at, suffix in enumerate(slots):
        if text[suffix] != symbol:
            start, symbol = at, text[suffix]
        place[suffix], group[suffix] = at, start
        size[start] += 1
    smaller = [-1] * n
    end = n
    while end:
        first = group[slots[end - 1]]
        pointed: dict[int, int] = {}
        for suffix in sorted(slots[first:end]) if end - first > 1 else slots[first:end]:
            before = suffix - 1
            while before >= 0 and group[before] >= first:
                before = smaller[before]
            smaller[suffix] = before
            if before >= 0:
                pointed[before] = pointed.get(before, 0) + 1
        end = first
        if not pointed:
            continue
        moves: dict[tuple[int, int], list[int]] = {}
        for suffix, pointers in pointed.items():
            moves.setdefault((-pointers, group[suffix]), []).append(suffix)
        for key in sorted(moves) if len(moves) > 1 else moves:
            old, moved = key[1], moves[key]
            tail = old + size[old]
            for suffix in moved:
                tail -= 1
                here, other = place[suffix], slots[tail]
                slots[here], slots[tail] = other, suffix
                place[other], place[suffix] = here, tail
            if tail != old:
                size[tail] = len(moved)
                size[old] -= len(moved)
                for suffix in moved:
                    group[suffix] = tail
    order = [-1] * n
    fill = list(range(n))  # next free slot of each group
    order[0] = n - 1
    placed = bytearray(n)
    placed[n - 1] = 1
    for at in range(n):
        suffix = order[at] - 1
        while suffix >= 0 and not placed[suffix]:
            front = group[suffix]
            order[fill[front]] = suffix
            fill[front] += 1
            placed[suffix] = 1
            suffix = smaller[suffix]
    return order[1:]
