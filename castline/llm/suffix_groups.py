"""Suffix arrays of many short texts at once, by linear grouping construction.

A suffix belongs to the group of its longest Lyndon prefix.  Groups start as the
suffixes of one first symbol.

First phase: groups are taken in descending order.  For each suffix of the group
its *previous smaller* suffix is looked up: the nearest one to the left in a lower
group.  That one's prefix goes on with the prefix of the group taken, as often as
it was found; suffixes of a lower group whose prefix grows (more often) move to a new
group behind the rest of theirs.  When all are taken, every group holds the suffixes
with one longest Lyndon prefix, in the order of these prefixes.

Second phase: from the smallest suffix on, each suffix in its final place puts the
suffix before it, and along the previous smaller pointers further ones, at the next
free place of their groups.  No group is renamed or sorted again.

Texts don't depend on each other, so all advance together, each by one group a step:
a step is a few numpy calls over the groups of all texts.  A text lies between a mark
in front (smaller than all, never a suffix) and an end (the smallest suffix).
"""

from __future__ import annotations

import numpy as np

#: Symbols: the mark in front, the end, the seam between joined pieces, then bytes.
FRONT, END, SEAM, FIRST = 0, 1, 2, 3
#: Numbers of places and of repetitions fit these bits of a packed number.
PLACE_BITS = 24
MOST_TIMES = (1 << 16) - 1


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + length - 1`` of each pair, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


class Texts:
    """Texts side by side in one array of symbols; ``start`` is the place of each text's mark."""

    def __init__(self, texts: list[list[bytes]]) -> None:
        parts: list[bytes] = []
        lengths = []
        self.pieces: list[tuple[int, int]] = []      # start and length of each piece
        at = 0
        for pieces in texts:
            began = at
            parts.append(b"\0")
            at += 1
            for k, piece in enumerate(pieces):
                if k:
                    parts.append(b"\0")
                    at += 1
                self.pieces.append((at, len(piece)))
                parts.append(piece)
                at += len(piece)
            parts.append(b"\0")
            at += 1
            lengths.append(at - began)
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.length = np.array(lengths, np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.symbols = np.full(len(self.bytes), SEAM, np.int64)
        inside = ragged(*np.array(self.pieces, np.int64).reshape(-1, 2).T)
        self.symbols[inside] = self.bytes[inside].astype(np.int64) + FIRST
        self.symbols[self.start] = FRONT
        self.symbols[self.start + self.length - 1] = END
        self.text = np.repeat(np.arange(len(texts)), self.length)


def group_suffixes(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """First phase: the start of each suffix's group among the places, and its previous smaller suffix."""
    n = len(t.symbols)
    if n >= 1 << (PLACE_BITS - 1) or t.length.max(initial=0) > MOST_TIMES:
        raise ValueError("too many symbols at once")
    keyed = np.sort(((t.text * (256 + FIRST) + t.symbols) << 32) | np.arange(n))
    order = keyed & 0xFFFFFFFF                           # suffixes by place
    edge = np.flatnonzero(np.concatenate([[True], keyed[1:] >> 32 != keyed[:-1] >> 32]))
    size = np.zeros(n, np.int64)
    size[edge] = np.diff(np.append(edge, n))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    group = np.empty(n, np.int64)
    group[order] = np.repeat(edge, size[edge])
    group[t.start] = -1                                  # the marks are below all groups
    before = np.zeros(n, np.int64)
    moved = np.zeros(n, bool)
    stop = t.start + 2                                   # behind the mark and the end
    top = t.start + t.length
    live = np.flatnonzero(top > stop)
    while live.size:
        high = top[live]
        low = group[order[high - 1]]
        if (high - low).max() == 1:
            suffixes, own = order[low], low
        else:
            suffixes, own = order[ragged(low, high - low)], np.repeat(low, high - low)
        found = suffixes - 1
        seek = np.flatnonzero(group[found] > own)
        while seek.size:                                 # higher groups are done: their pointers lead on
            found[seek] = before[found[seek]]
            seek = seek[group[found[seek]] > own[seek]]
        before[suffixes] = found
        same = np.flatnonzero(group[found] == own)
        while same.size:                                 # a member of the same group: on to what that one found
            found[same] = before[found[same]]
            before[suffixes[same]] = found[same]
            same = same[group[found[same]] == own[same]]
        grow(np.sort(found[group[found] >= 0]), order, place, group, size, moved)
        top[live] = low
        live = live[low > stop[live]]
    return group, before


def grow(found: np.ndarray, order: np.ndarray, place: np.ndarray, group: np.ndarray, size: np.ndarray, moved: np.ndarray) -> None:
    """Suffixes in ``found`` (ascending, as often as they were found) go to new groups behind the rest of theirs."""
    if not found.size:
        return
    first = changes(found)
    times = np.diff(first, append=len(found))
    found = found[first]
    # By group, more often found ones further back: one sort of packed numbers.
    packed = np.sort((group[found] << 40) | (times << PLACE_BITS) | found)
    found, kind = packed & ((1 << PLACE_BITS) - 1), packed >> PLACE_BITS
    of = kind >> (40 - PLACE_BITS)
    run = changes(of)
    count = np.diff(run, append=len(of))
    old = of[run]
    target = old + size[old] - count                     # the last places of the group
    if len(run) == len(of):                              # one a group
        places, ends = target, target
    else:
        places, ends = ragged(target, count), np.repeat(target, count)
    was = place[found]
    there = order[places]
    moved[found] = True
    out = there[~moved[there]]                           # as many as come from further ahead, group by group
    moved[found] = False
    hole = was[was < ends]
    order[hole] = out
    place[out] = hole
    order[places] = found
    place[found] = places
    size[old] -= count
    begin = changes(kind)
    held = np.diff(begin, append=len(of))
    size[places[begin]] = held
    group[found] = np.repeat(places[begin], held)


def changes(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    new = np.empty(len(values), bool)
    new[0] = True
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return np.flatnonzero(new)


def emit(t: Texts, group: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Second phase: the suffixes by their final places (each text's from ``start + 1`` on)."""
    n = len(t.symbols)
    final = np.zeros(n, np.int64)
    free = np.arange(n)
    done = np.zeros(n, bool)
    done[t.start] = True
    last = t.start + t.length - 1
    final[t.start + 1] = last
    done[last] = True
    at, end = t.start + 1, t.start + t.length
    now = last - 1
    while at.size:
        fresh = ~done[now]
        put = now[fresh]
        own = group[put]
        to = free[own]
        final[to] = put
        free[own] = to + 1
        done[put] = True
        now[fresh] = before[put]
        back = np.flatnonzero(~fresh)                    # nothing left on this way: the next place
        at[back] += 1
        over = at[back] >= end[back]
        now[back] = final[np.where(over, 0, at[back])] - 1
        if over.any():
            stay = np.ones(len(at), bool)
            stay[back[over]] = False
            at, end, now = at[stay], end[stay], now[stay]
    return final


def suffix_arrays(t: Texts) -> np.ndarray:
    """The suffix arrays of all texts, each from its ``start + 1`` on (the first one is the end)."""
    return emit(t, *group_suffixes(t))


def common_prefixes(t: Texts, order: np.ndarray, first: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
    """How many symbols the suffix at each place shares with that at the place before (0 for the first of a text).

    Suffix by suffix in the order of the text: one less than the last is shared for certain.  With
    ``first`` and ``stop`` only for the suffixes that start in one of these stretches (0 for all others).
    All stretches advance together, six symbols a step.
    """
    n = len(t.symbols)
    six = np.zeros(n + 8, np.uint64)
    shifted = np.concatenate([t.symbols.astype(np.uint64), np.zeros(16, np.uint64)])
    for k in range(6):                                   # six symbols of nine bits
        six |= shifted[k:k + n + 8] << np.uint64(9 * k)
    place = np.empty(n, np.int64)
    real = np.ones(n, bool)
    real[t.start] = False
    place[order[real]] = np.flatnonzero(real)
    shared = np.zeros(n, np.int64)
    # the end itself shares nothing
    now, end = (t.start + 1, t.start + t.length - 1) if first is None else (first, stop)
    keep = now < end
    now, end = now[keep], end[keep]
    length = np.zeros(len(now), np.int64)
    other = order[place[now] - 1]
    while now.size:
        differ = six[now + length] ^ six[other + length]
        more = differ == 0
        low = differ & (~differ + np.uint64(1))          # the lowest bit in which they differ
        length += np.where(more, 6, np.log2(np.maximum(low, np.uint64(1)).astype(float)).astype(np.int64) // 9)
        step = np.flatnonzero(~more)
        here = now[step]
        shared[place[here]] = length[step]
        length[step] = np.maximum(length[step] - 1, 0)
        here += 1
        now[step] = here
        over = here >= end[step]
        if over.any():
            stay = np.ones(len(now), bool)
            stay[step[over]] = False
            step = (np.cumsum(stay) - 1)[step[~over]]
            now, end, length, other = now[stay], end[stay], length[stay], other[stay]
            here = now[step]
        other[step] = order[place[here] - 1]
    return shared
