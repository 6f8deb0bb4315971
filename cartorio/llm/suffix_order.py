"""Suffix arrays by linear grouping.

Suffixes are kept in groups by a growing prefix; in the end a group is all suffixes with one Lyndon prefix (the
longest Lyndon word a suffix starts with), and groups stand in the order of those words. Groups are taken from the
highest down. Every member of the group taken has a previous-smaller pointer: the nearest position before it that lies
in a group not taken yet. Suffixes so pointed at have their prefix followed by the group's word, so they move up,
next to where they were: those pointed at oftener, higher. Once all groups are taken, one upward pass over the result
emits each group's order: what starts right before a placed suffix, and the chain of pointers from there, comes next
in its group. No ranks are ever renamed and no suffixes compared.

suffix_order() does so for one text; suffix_orders() for many short ones at once, in numpy: each takes its next group, and later
places its next suffix, in step with the others.
"""

from __future__ import annotations

import numpy as np

#: Letters of a text from which it is sorted by itself, and texts of about equal length that are worth a step together.
ALONE, TOGETHER = 4096, 12


def suffix_order(text: list[int]) -> list[int]:
    """Starts of all non-empty suffixes of the text (small non-negative integers), in ascending order."""
    n = len(text)
    if not n:
        return []
    letters = sorted(set(text))
    number = {c: g for g, c in enumerate(letters)}
    group = [number[c] for c in text]
    members: list[list[int]] = [[] for _ in letters]
    for i, g in enumerate(group):
        members[g].append(i)
    lower = [*range(-1, len(letters) - 1)]
    higher = [*range(1, len(letters)), -1]
    # jump[i + 1] is i + 1 while i's group isn't taken, else somewhere before; 0 stands before the text.
    jump = [*range(n + 1)]
    pointer = [-1] * n
    taken: list[int] = []
    at = len(letters) - 1
    while at >= 0:
        own = [i for i in members[at] if group[i] == at]
        members[at] = own
        for i in own:
            jump[i + 1] = i
        times: dict[int, int] = {}
        for i in own:
            k = i
            while (j := jump[k]) != k:
                jump[k] = k = jump[j]
            jump[i + 1] = k
            pointer[i] = k - 1
            if k:
                times[k - 1] = times.get(k - 1, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for i, t in times.items():
            key = (group[i], t)
            if key in parts:
                parts[key].append(i)
            else:
                parts[key] = [i]
        last: dict[int, int] = {}
        for g, t in sorted(parts) if len(parts) > 1 else parts:
            below = last.get(g, g)
            new = len(members)
            moved = parts[g, t]
            members.append(moved)
            for i in moved:
                group[i] = new
            above = higher[below]
            lower.append(below)
            higher.append(above)
            higher[below] = new
            if above >= 0:
                lower[above] = new
            last[g] = new
        taken.append(at)
        at = lower[at]
    slot = [0] * len(members)
    total = 0
    for g in reversed(taken):
        slot[g] = total
        total += len(members[g])
    order = [-1] * n
    placed = bytearray(n + 1)
    placed[n] = 1  # so that the chain stops before the text: index -1
    i, k = n, 0
    while True:
        s = i - 1
        while s >= 0 and not placed[s]:
            placed[s] = 1
            g = group[s]
            order[slot[g]] = s
            slot[g] += 1
            s = pointer[s]
        if k == n:
            return order
        i = order[k]
        k += 1


def suffix_orders(letters: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of each text letters[first[t]:first[t + 1]], in ascending order text by text; a suffix ends with its text."""
    out = np.empty(len(letters), np.int64)
    sizes = np.diff(first)
    # Of about equal length, so that few wait for others.
    level = np.where(sizes > 0, np.ceil(2 * np.log2(np.maximum(sizes, 1))), -1).astype(int)
    for k in np.unique(level[level >= 0]):
        texts = np.flatnonzero(level == k)
        if len(texts) >= TOGETHER and sizes[texts].max() < ALONE:
            at = np.repeat(first[texts] - (np.cumsum(sizes[texts]) - sizes[texts]), sizes[texts]) + np.arange(sizes[texts].sum())
            out[at] = at[_in_step(letters[at], sizes[texts])]
        else:
            for t in texts:
                out[first[t] : first[t + 1]] = first[t] + np.array(suffix_order(letters[first[t] : first[t + 1]].tolist()))
    return out


def _heads(x: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before; the first does."""
    out = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=out[1:])
    return out


def _gaps(x: np.ndarray, end: int) -> np.ndarray:
    """How far it is from each to the next, or to the end."""
    out = np.empty(len(x), np.int64)
    np.subtract(x[1:], x[:-1], out=out[:-1])
    out[-1] = end - x[-1]
    return out


def _in_step(letters: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """suffix_order() of texts that follow each other, none empty, all at once."""
    n, t = len(letters), len(sizes)
    text = np.repeat(np.arange(t), sizes)
    end = np.cumsum(sizes)
    # Places have one more before each text, which is never taken: where pointers end that find nothing.
    place = np.arange(n) + text + 1
    before = end - sizes + np.arange(t)
    log = np.empty(2 * n, np.int64)  # members of groups, some of which move on later
    order = np.lexsort((letters, text))
    fresh = np.r_[True, (letters[order[1:]] != letters[order[:-1]]) | (text[order[1:]] != text[order[:-1]])]
    number = np.cumsum(fresh) - 1
    groups, logged = int(number[-1]) + 1, n
    log[:n] = place[order]
    group = np.full(n + t, -1)
    group[place[order]] = number
    start, size, lower, higher, step = (np.full(groups + n, -1) for _ in range(5))
    start[:groups] = np.flatnonzero(fresh)
    size[:groups] = np.diff(np.r_[start[:groups], n])
    of = text[order[fresh]]
    lower[:groups] = np.where(np.r_[True, of[1:] != of[:-1]], -1, np.arange(groups) - 1)
    higher[:groups] = np.where(np.r_[of[1:] != of[:-1], True], -1, np.arange(groups) + 1)
    now = np.flatnonzero(np.r_[of[1:] != of[:-1], True])
    jump, pointer = np.arange(n + t), np.arange(n + t)
    taken = 0
    while len(now):
        step[now] = taken
        taken += 1
        m = size[now]
        ends = np.cumsum(m)
        own = log[np.repeat(start[now] - ends + m, m) + np.arange(ends[-1])]
        own = own[group[own] == np.repeat(now, m)]
        if len(own):
            jump[own] = own - 1
            near = own - 1
            while ((further := jump[near]) != near).any():
                jump[own] = near = further
            pointer[own] = near
            near = np.sort(near[group[near] >= 0])
            if len(near):
                one = np.flatnonzero(_heads(near))
                times, near = _gaps(one, len(near)), near[one]
                below = group[near]
                by = np.lexsort((times, below))
                near, times, below = near[by], times[by], below[by]
                new = np.flatnonzero(_heads(below) | _heads(times))
                ids = groups + np.arange(len(new))
                start[ids] = logged + new
                size[ids] = many = _gaps(new, len(near))
                log[logged : logged + len(near)] = near
                logged += len(near)
                group[near] = np.repeat(ids, many)
                below = below[new]
                lowest = _heads(below)
                highest = np.ones(len(below), bool)
                highest[:-1] = lowest[1:]
                above = higher[below]
                lower[ids] = np.where(lowest, below, ids - 1)
                higher[ids] = np.where(highest, above, ids + 1)
                higher[below[lowest]] = ids[lowest]
                lower[above[highest]] = ids[highest]  # all have one above: the group just taken at least
                groups += len(new)
        now = lower[now]
        now = now[now >= 0]

    # Groups stand in the opposite order of being taken.
    rank = step[group[place]]
    order = np.lexsort((-rank, text))
    sorted_ = group[place[order]]
    heads = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
    slot = np.zeros(groups, np.int64)
    slot[sorted_[heads]] = heads
    out = np.empty(n, np.int64)
    placed = np.zeros(n + t, bool)
    placed[before] = True
    k, last = end - sizes, end.copy()
    s = place[last - 1]
    while len(s):
        go = np.flatnonzero(~placed[s])
        p = s[go]
        placed[p] = True
        g = group[p]
        out[slot[g]] = p
        slot[g] += 1
        s[go] = pointer[p]
        done = np.flatnonzero(placed[s])
        some = done[k[done] < last[done]]
        s[some] = out[k[some]] - 1
        k[some] += 1
        if len(some) < len(done):
            stay = np.ones(len(s), bool)
            stay[done] = k[done] < last[done]
            stay[some] = True
            s, k, last = s[stay], k[stay], last[stay]
    return out - text - 1
