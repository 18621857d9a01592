"""Suffix arrays by induced sorting: of many small shards at once, or of one large shard.

A stack holds the texts of ``G`` shards of equal length ``M`` as a matrix ``text[place, shard]`` of numbers; each
column ends in a 0 that occurs nowhere else in it. The scans of induced sorting go through the places one by
one, for all shards together. A large shard, with few of its size to stack it with, is sorted by itself.
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than their successor (the last one, too)."""
    small = np.empty(text.shape, dtype=bool)
    small[-1] = True
    for i in range(len(text) - 2, -1, -1):
        small[i] = (text[i] < text[i + 1]) | ((text[i] == text[i + 1]) & small[i + 1])
    return small


def _at_ends(places: np.ndarray, shards: np.ndarray, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """An array with the suffixes (given in ascending order within each shard and letter) at the ends of their letters' buckets."""
    size, width = text.shape
    bucket = shards * len(ends) + text[places, shards]
    last = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True))
    from_end = np.repeat(last, np.diff(np.concatenate([[-1], last]))) - np.arange(len(bucket))
    out = np.full(size * width, -1, dtype=np.int64)
    out[(ends[text[places, shards], shards] - 1 - from_end) * width + shards] = places
    return out.reshape(size, width)


def _induce(order: np.ndarray, text: np.ndarray, small: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
    """Fill in the larger suffixes from the left, then the smaller ones anew from the right."""
    size, width = text.shape
    shard = np.arange(width)
    flat = order.ravel()
    for kind, step, heads in ((False, 1, starts), (True, -1, ends)):
        letter = np.where(small == kind, text, -1).ravel()
        head = heads.copy().ravel()
        for i in range(size)[::step]:
            before = order[i] - 1
            c = letter[np.maximum(before, 0) * width + shard]
            own = np.flatnonzero((before >= 0) & (c >= 0))
            if not len(own):
                continue
            b = c[own] * width + own
            at = head[b] - (step < 0)
            flat[at * width + own] = before[own]
            head[b] = at + (step > 0)


def suffix_arrays(text: np.ndarray) -> np.ndarray:
    """``order[rank, shard]``: the start of the suffix of each rank."""
    size, width = text.shape
    if size == 1:
        return np.zeros((1, width), dtype=np.int64)
    letters = int(text.max()) + 1
    shard = np.broadcast_to(np.arange(width), text.shape)
    counts = np.bincount((text * width + shard).ravel(), minlength=letters * width).reshape(letters, width)
    ends = np.cumsum(counts, axis=0)
    starts = ends - counts
    small = _types(text)
    left = np.zeros(text.shape, dtype=bool)  # leftmost smaller ones
    left[1:] = small[1:] & ~small[:-1]

    # sort the substrings between leftmost smaller suffixes
    g, p = np.nonzero(left.T)
    by_letter = np.argsort(g * letters + text[p, g], kind="stable")
    order = _at_ends(p[by_letter], g[by_letter], text, ends)
    _induce(order, text, small, starts, ends)
    ranked = order.T
    mask = left[ranked, np.arange(width)[:, None]]
    p = ranked[mask]  # by shard, then rank; `g` stays as it was
    name = _names(p, g, text, small, left)

    many = np.bincount(g, minlength=width)
    first = np.cumsum(many) - many
    if (name[np.cumsum(many) - 1] + 1 < many).any():
        # names in text order make a shorter text; shards with fewer are filled up behind their own end
        by_place = np.lexsort((p, g))
        short = np.ones((int(many.max()) + 1, width), dtype=np.int64)
        short[-1] = 0
        rank = np.arange(len(g)) - first[g]
        short[rank, g] = name[by_place] + 1
        deeper = suffix_arrays(short).T
        real = deeper < many[:, None]
        p = p[by_place][(first[:, None] + deeper)[real]]
    order = _at_ends(p, g, text, ends)
    _induce(order, text, small, starts, ends)
    return order


def _names(p: np.ndarray, g: np.ndarray, text: np.ndarray, small: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Numbers of the sorted substrings within each shard, equal ones alike."""
    new = np.ones(len(p), dtype=np.int64)
    open_ = np.flatnonzero(g[1:] == g[:-1]) + 1
    d = 0
    while len(open_):
        a, b, s = p[open_ - 1] + d, p[open_] + d, g[open_]
        inside = np.maximum(a, b) < len(text)  # only equal substrings go on; the final 0 ends all others
        open_, a, b, s = open_[inside], a[inside], b[inside], s[inside]
        same = (text[a, s] == text[b, s]) & (small[a, s] == small[b, s])
        ended = same & left[a, s] & left[b, s] if d else np.zeros(len(open_), dtype=bool)
        new[open_[ended]] = 0
        open_ = open_[same & ~ended]
        d += 1
    total = np.cumsum(new)
    return total - np.repeat(total[np.flatnonzero(np.append(True, g[1:] != g[:-1]))], np.bincount(g)[np.unique(g)])


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place, in text order: the common prefix (up to ``cap``) with the suffix ranked before it, and that suffix's start.

    A place keeps all but one letter of its predecessor's prefix and extends it four letters at a time; each shard
    goes through its places at its own pace.
    """
    size, width = text.shape
    shard = np.arange(width)
    before = np.full((size, width), -1, dtype=np.int64)
    before[order[1:], shard] = order[:-1]
    padded = np.concatenate([text, np.zeros((cap + 4, width), dtype=np.int64)]).astype(np.uint64)
    word = padded[:-3] | padded[1:-2] << np.uint64(16) | padded[2:-1] << np.uint64(32) | padded[3:] << np.uint64(48)
    word = word.ravel()
    out = np.zeros(size * width, dtype=np.int64)
    earlier = before.ravel()
    live, place, held = shard.copy(), np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
    while len(live):
        at = place * width + live
        other = earlier[at]
        x = word[at + held * width] ^ word[np.maximum(other, 0) * width + held * width + live]
        more = ((x & np.uint64(0xFFFF)) == 0).astype(np.int64)
        more += (x & np.uint64(0xFFFFFFFF)) == 0
        more += (x & np.uint64(0xFFFFFFFFFFFF)) == 0
        more += x == 0
        held = np.where(other < 0, 0, held + more)
        ready = (more < 4) | (held >= cap) | (other < 0)
        out[at[ready]] = np.minimum(held[ready], cap)
        held = np.where(ready, np.maximum(np.minimum(held, cap) - 1, 0), held)
        place = place + ready
        on = place < size
        if not on.all():
            live, place, held = live[on], place[on], held[on]
    return out.reshape(size, width), before


def suffix_array(text: list[int]) -> list[int]:
    """The suffix array of one text of numbers that ends in a 0 that occurs nowhere else in it."""
    n = len(text)
    small = bytearray(n)
    small[-1] = 1
    for i in range(n - 2, -1, -1):
        small[i] = text[i] < text[i + 1] or (text[i] == text[i + 1] and small[i + 1])
    left = [i for i in range(1, n) if small[i] and not small[i - 1]]
    ends = [0] * (max(text) + 1)
    for c in text:
        ends[c] += 1
    total = 0
    for c, many in enumerate(ends):
        total += many
        ends[c] = total

    def induced(seeds: list[int]) -> list[int]:
        order = [-1] * n
        tail = ends[:]
        for i in reversed(seeds):
            tail[text[i]] -= 1
            order[tail[text[i]]] = i
        head = [0, *ends[:-1]]
        for r in range(n):  # larger suffixes, from the left
            i = order[r] - 1
            if i >= 0 and not small[i]:
                c = text[i]
                order[head[c]] = i
                head[c] += 1
        tail = ends[:]
        for r in range(n - 1, -1, -1):  # smaller ones, from the right
            i = order[r] - 1
            if i >= 0 and small[i]:
                c = text[i]
                tail[c] -= 1
                order[tail[c]] = i
        return order

    if len(left) > 1:
        until = dict(zip(left, [*left[1:], n - 1], strict=True))
        name, names, last = -1, {}, None
        for i in induced(left):
            if i in until:
                # equal substrings have equal letters and so equal kinds, up to the next leftmost one
                now = tuple(text[i:until[i] + 1])
                name += now != last
                names[i], last = name, now
        if name + 1 < len(left):
            left = [left[j] for j in suffix_array([names[i] for i in left])]
        else:
            left.sort(key=names.__getitem__)
    return induced(left)


def _repeated_in_one(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """As ``repeated_starts``, for one shard."""
    text: list[int] = []
    for k, piece in enumerate(pieces):
        text.extend(b + 1 + len(pieces) for b in piece)
        text.append(1 + k)
    text.append(0)
    order = suffix_array(text)
    before = [-1] * len(text)
    for a, b in zip(order, order[1:], strict=False):
        before[b] = a
    again, held = np.zeros(len(text), dtype=bool), 0
    for i, j in enumerate(before):  # in text order, a place keeps all but one letter of its predecessor's prefix
        if j < 0:
            held = 0
            continue
        while held < length and text[i + held] == text[j + held]:
            held += 1
        if held >= length:
            again[i] = again[j] = True
        held = max(held - 1, 0)
    found, at = [], 0
    for piece in pieces:
        found.append(again[at:at + max(0, len(piece) - length + 1)])
        at += len(piece) + 1
    return found


def repeated_starts(shards: list[list[bytes]], length: int) -> list[list[np.ndarray]]:
    """For each piece of each shard: which of its ``length``-byte strings occur at another place in the shard's pieces.

    Letters: 0 ends a column, 1 fills it up, then one end mark for each piece, then the bytes.
    """
    if not shards:
        return []
    if len(shards) == 1:
        return [_repeated_in_one(shards[0], length)]
    marks = max(map(len, shards))
    size = max(sum(map(len, pieces)) + len(pieces) for pieces in shards) + 1
    text = np.ones((size, len(shards)), dtype=np.int64)
    text[-1] = 0
    for s, pieces in enumerate(shards):
        at = 0
        for k, piece in enumerate(pieces):
            text[at:at + len(piece), s] = np.frombuffer(piece, dtype=np.uint8) + np.int64(2 + marks)
            text[at + len(piece), s] = 2 + k
            at += len(piece) + 1
    prefix, before = common_prefixes(text, suffix_arrays(text), length)
    again = prefix >= length
    p, g = np.nonzero(again)
    again[before[p, g], g] = True
    found = []
    for s, pieces in enumerate(shards):
        at, own = 0, []
        for piece in pieces:
            own.append(again[at:at + max(0, len(piece) - length + 1), s])
            at += len(piece) + 1
        found.append(own)
    return found
