"""Suffix arrays of many short texts at once by linear grouping (after Baier, 2016).

Suffixes are grouped by their Lyndon prefixes. Groups are processed in descending order; the
previous-smaller pointers of a group's suffixes tell which suffixes in front of them begin
with a longer Lyndon prefix than was known, and those move up into groups of their own, by
how often the group's word repeats behind them. The final groups stand in order, and one
pass over the suffix array emits each group's own order along the same pointers. Nothing is
renamed and nothing recurses.

The texts of a batch are independent, so each numpy step treats one group of every text.
"""

from __future__ import annotations

import numpy as np


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for every start, as many as its size."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def suffix_arrays(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The suffix array of each text, one behind the other, as positions in ``text``.

    ``text`` holds small non-negative numbers; text k goes from starts[k] to the next start.
    A suffix that is a prefix of another one comes first, as if a least letter stood behind
    every text.
    """
    n, ends = len(text), np.append(starts[1:], len(text))
    sizes = ends - starts
    starts, ends = starts[sizes > 0], ends[sizes > 0]
    sizes = sizes[sizes > 0]
    if not len(starts):
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(starts)), sizes)
    order = np.lexsort((text, owner))  # suffixes by first letter
    fresh = np.append(True, (text[order][1:] != text[order][:-1]) | (owner[order][1:] != owner[order][:-1]))
    heads = np.flatnonzero(fresh)
    group, size = np.empty(n, np.int64), np.zeros(n + 1, np.int64)  # by suffix; by group, named by its first place
    size[heads] = np.diff(np.append(heads, n))
    group[order] = np.repeat(heads, size[heads])
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    first = np.repeat(starts, sizes)
    pointer = np.full(n, -1, np.int64)  # previous smaller suffix, -1 if there is none
    linked = np.full(n, -1, np.int64)
    marked = np.zeros(n, bool)

    # Behind a text lies its least suffix, the empty one. Its group comes last and needs no turn.
    top = ends - 1
    live = np.arange(len(starts))
    while len(live):
        head = group[order[top[live]]]
        members = order[_spread(head, size[head])]
        own = np.repeat(head, size[head])
        top[live] = head - 1
        live = live[top[live] >= starts[live]]

        at, low = members - 1, first[members]
        walk = np.arange(len(members))
        while len(walk):  # leftwards over larger suffixes, whose pointers are known
            here = at[walk]
            walk = walk[here >= low[walk]]
            here = at[walk]
            walk = walk[group[here] > own[walk]]
            at[walk] = pointer[at[walk]]
        at[at < low] = -1
        mate = at >= 0
        mate[mate] = group[at[mate]] == own[mate]
        pointer[members[~mate]] = at[~mate]
        chained, target = members[mate], at[mate]
        linked[chained] = target
        while len(chained):  # a member of the same group passes on its own pointer, by doubling
            onward = linked[target]
            done = onward < 0
            pointer[chained[done]] = pointer[target[done]]
            chained, target = chained[~done], onward[~done]
            if len(chained):
                linked[chained] = target
        linked[members] = -1

        before = pointer[members]
        before = np.sort(before[before >= 0])
        if not len(before):
            continue
        new = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        times, moved = np.diff(np.append(new, len(before))), before[new]
        by = np.lexsort((times, group[moved]))
        moved, times = moved[by], times[by]
        from_group = group[moved]
        cut = np.append(True, from_group[1:] != from_group[:-1])
        heads = np.flatnonzero(cut)
        counts = np.diff(np.append(heads, len(moved)))
        whole = from_group[heads]
        zone = _spread(whole + size[whole] - counts, counts)  # the last places of the group
        zone_start = np.repeat(whole + size[whole] - counts, counts)
        marked[moved] = True
        there = order[zone]
        displaced = there[~marked[there]]
        was = place[moved]
        vacated = was[was < zone_start]
        order[vacated], place[displaced] = displaced, vacated
        order[zone], place[moved] = moved, zone
        marked[moved] = False
        runs = np.flatnonzero(cut | np.append(True, times[1:] != times[:-1]))
        lengths = np.diff(np.append(runs, len(moved)))
        size[whole] -= counts
        size[zone[runs]] = lengths
        group[moved] = np.repeat(zone[runs], lengths)

    result = np.full(n, -1, np.int64)
    slot = np.arange(n)  # the next free place, by group
    emitted = np.zeros(n, bool)

    def emit(at: np.ndarray) -> None:
        while len(at):
            at = at[~emitted[at]]
            result[slot[group[at]]] = at
            slot[group[at]] += 1
            emitted[at] = True
            at = pointer[at]
            at = at[at >= 0]

    emit(ends - 1)  # the suffix in front of the empty one
    live, turn = np.arange(len(starts)), 0
    while len(live := live[starts[live] + turn < ends[live]]):
        at = result[starts[live] + turn] - 1
        emit(at[at >= starts[live]])
        turn += 1
    return result
