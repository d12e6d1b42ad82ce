"""Suffix arrays of many texts at once, by grouping suffixes in linear time.

Every suffix begins with its Lyndon prefix: the part up to the next smaller suffix. The first
phase sorts suffixes into groups by Lyndon prefix. It takes the groups from the highest to the
lowest; each member points to the last suffix before it that is smaller (in a lower group), and
the suffixes that members point to move to the top of their group, those that more members
point to higher, because their prefix has grown by that of the members. Each suffix is handled
once. The second phase emits the order: it goes through the suffix array from the front, and
puts the suffix before the current one, and the smaller ones it points back to, at the next
place of their group. Nothing is renamed or sorted again.

Both phases are steps of one text; here they run in step over all texts of a batch, as numpy
operations on the members of the current group of every text. A step costs much the same for one
text as for TOGETHER of them, so that the few texts that are much longer than the others take
their steps one by one instead, in the same two phases.
"""

import numpy as np

from tremor.llm.common import offsets, ragged

#: Texts that are as dear in step as one by one.
TOGETHER = 16


def suffix_arrays(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix arrays of consecutive texts, as places in ``symbols``.

    Each text has to end with a symbol that is smaller than all others in it.
    """
    bounds = offsets(lengths)
    if not len(symbols):
        return np.zeros(0, np.int64), bounds
    order = np.empty(len(symbols), np.int64)
    usual = np.sort(lengths)[-TOGETHER] if len(lengths) >= TOGETHER else 0
    alone = lengths > 2 * usual
    for i in np.flatnonzero(alone).tolist():
        lo, hi = bounds[i], bounds[i + 1]
        order[lo:hi] = _alone(symbols[lo:hi])
        order[lo:hi] += lo
    rest = lengths[~alone]
    at = ragged(bounds[:-1][~alone], rest)
    if len(at):
        inner = offsets(rest)
        group, back = _groups(symbols[at], np.repeat(np.arange(len(rest)), rest), inner)
        order[at] = at[_emitted(group, back, inner)]
    return order, bounds


def _alone(symbols: np.ndarray) -> list[int]:
    """The suffix array of one text, step by step."""
    size = len(symbols)
    by_symbol = np.argsort(symbols, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(symbols[by_symbol].astype(np.int64)) != 0])
    many = np.diff(np.r_[first, size])
    slots, place, group, members = (np.zeros(size, np.int64) for _ in range(4))
    slots[:] = by_symbol
    place[by_symbol] = np.arange(size)
    group[by_symbol] = np.repeat(first, many)
    members[first] = many
    slots, place, group, members = (x.tolist() for x in (slots, place, group, members))
    back = list(range(-1, size - 1))
    top = size
    while top > 0:
        start = group[slots[top - 1]]
        times: dict[int, int] = {}
        for i in slots[start:top]:
            to = back[i]
            while to >= 0 and group[to] >= start:
                to = back[to]
            back[i] = to
            if to >= 0:
                times[to] = times.get(to, 0) + 1
        top = start
        lifted: dict[tuple[int, int], list[int]] = {}
        for to, n in times.items():
            lifted.setdefault((-n, group[to]), []).append(to)
        # Those that more members point to go first. What is lifted has a group of its own then.
        for (_, old), moved in sorted(lifted.items()) if len(lifted) > 1 else lifted.items():
            slot = old + members[old]
            fresh = slot - len(moved)
            for i in moved:
                slot -= 1
                there, free = slots[slot], place[i]
                slots[free], slots[slot] = there, i
                place[there], place[i] = free, slot
                group[i] = fresh
            members[old] -= len(moved)
            members[fresh] = len(moved)
    order, done, free = [-1] * size, [False] * size, list(range(size))
    order[0] = size - 1
    done[-1] = True
    free[group[-1]] += 1
    for rank in range(size):
        to = order[rank] - 1
        while to >= 0 and not done[to]:
            head = group[to]
            order[free[head]] = to
            free[head] += 1
            done[to] = True
            to = back[to]
    return order


def _groups(symbols: np.ndarray, text: np.ndarray, bounds: np.ndarray):
    """For each suffix the first slot of its group, and the last smaller suffix before it."""
    size = len(symbols)
    slots = np.lexsort((symbols, text))  # the suffix in each slot, groups side by side
    new = np.ones(size, bool)
    new[1:] = (symbols[slots[1:]] != symbols[slots[:-1]]) | (text[slots[1:]] != text[slots[:-1]])
    first = np.flatnonzero(new)
    members = np.zeros(size, np.int64)
    members[first] = np.diff(np.r_[first, size])
    group = np.empty(size, np.int64)
    group[slots] = np.repeat(first, members[first])
    place = np.empty(size, np.int64)
    place[slots] = np.arange(size)
    back = np.arange(-1, size - 1)
    back[bounds[:-1][np.diff(bounds) > 0]] = -1
    chosen = np.zeros(size, bool)

    low, top = bounds[:-1], bounds[1:].copy()
    live = np.flatnonzero(top > low)
    while len(live):
        start = group[slots[top[live] - 1]]
        now = slots[ragged(start, top[live] - start)]
        floor = np.repeat(start, top[live] - start)
        top[live] = start
        live = live[start > low[live]]
        # What lies in this group or a higher one is not smaller; its own pointer skips it.
        to = back[now]
        wait = np.flatnonzero((to >= 0) & (group[to] >= floor))
        while len(wait):
            to[wait] = back[to[wait]]
            wait = wait[(to[wait] >= 0) & (group[to[wait]] >= floor[wait])]
        back[now] = to
        targets = np.sort(to[to >= 0])
        if not len(targets):
            continue
        begins = np.flatnonzero(np.r_[True, targets[1:] != targets[:-1]])
        times = np.diff(np.r_[begins, len(targets)])
        targets = targets[begins]
        for count in np.unique(times)[::-1] if times.max() > 1 else (1,):
            lifted = targets[times == count]
            lifted = lifted[np.argsort(group[lifted], kind="stable")]
            old = group[lifted]
            begins = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
            many = np.diff(np.r_[begins, len(old)])
            old = old[begins]
            fresh = old + members[old] - many
            # They swap places with those that stand at the top of the group.
            chosen[lifted] = True
            there = slots[ragged(fresh, many)]
            leaving = there[~chosen[there]]
            chosen[lifted] = False
            start_of = np.repeat(fresh, many)
            coming = lifted[place[lifted] < start_of]
            a, b = place[coming], place[leaving]
            slots[a], slots[b] = leaving, coming
            place[leaving], place[coming] = a, b
            members[old] -= many
            members[fresh] = many
            group[lifted] = start_of
    return group, back


def _emitted(group: np.ndarray, back: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    size = len(group)
    order = np.full(size, -1, np.int64)
    free = np.arange(size)  # the next place of the group that starts here
    done = np.zeros(size, bool)
    lengths = np.diff(bounds)
    full = np.flatnonzero(lengths > 0)
    last = bounds[1:][full] - 1
    order[bounds[:-1][full]] = last  # the least symbol is the least suffix
    done[last] = True
    free[group[last]] += 1
    start = bounds[:-1]
    is_first = np.zeros(size, bool)
    is_first[start[full]] = True
    live = full[np.argsort(-lengths[full], kind="stable")]
    shrinking = -lengths[live]
    for rank in range(int(lengths.max(initial=0))):
        live = live[: np.searchsorted(shrinking, -rank)]
        shrinking = shrinking[: len(live)]
        at = order[start[live] + rank]
        to = at[~is_first[at]] - 1
        to = to[~done[to]]
        while len(to):
            head = group[to]
            order[free[head]] = to
            free[head] += 1
            done[to] = True
            to = back[to]
            to = to[to >= 0]
            to = to[~done[to]]
    return order
