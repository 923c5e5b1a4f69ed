"""Suffix arrays by induced sorting, and permuted common prefixes, as array steps.

The text may be of any alphabet of whole numbers, so the string of names that one level leaves is
sorted by the same steps, down to a string whose names all differ.

Induced sorting visits suffixes in the order that it produces: each puts its predecessor next
into the bucket of the predecessor's symbol. Here several buckets are visited at once, as many as
have no predecessor among themselves (the number adapts); a bucket whose suffixes lead back to
itself is visited in waves, one for each symbol of its longest run.
"""

from __future__ import annotations

import numpy as np


def classify(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (type S); the last one is larger than the empty suffix."""
    n = len(text)
    smaller = np.zeros(n, bool)
    if n < 2:
        return smaller
    step = np.sign(text[1:].astype(np.int64) - text[:-1])
    # equal neighbours take the type of the next position that differs
    at = np.where(step != 0, np.arange(n - 1), n)
    ahead = np.minimum.accumulate(at[::-1])[::-1]
    known = ahead < n
    smaller[:-1][known] = step[ahead[known]] > 0
    return smaller


def _spread(text: np.ndarray, own: np.ndarray, seeds: np.ndarray, first: np.ndarray, top: int) -> np.ndarray:
    """The suffixes of one type (own), in order: they are led to by their successors in the text.

    seeds: the suffixes of the other type that may lead to them, in order. first: a suffix that
    stands before all others of its bucket. Within a bucket, own suffixes come before seeds.
    """
    n = len(text)
    counts = np.bincount(text[own], minlength=top)
    ends = np.cumsum(counts)
    fill = ends - counts
    begins = fill.copy()
    seed_ends = np.cumsum(np.bincount(text[seeds], minlength=top))
    seed_begins = np.append(0, seed_ends[:-1])
    out = np.zeros(int(ends[-1]), np.int64)
    used = np.flatnonzero(np.bincount(text, minlength=top))  # the buckets that there are

    def put(who: np.ndarray) -> None:
        """Append suffixes to their buckets."""
        keys = text[who]
        if len(who) == 1:
            out[fill[keys[0]]] = who[0]
            fill[keys[0]] += 1
            return
        order = np.argsort(keys, kind="stable")
        who, keys = who[order], keys[order]
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        size = np.diff(np.append(start, len(keys)))
        out[np.repeat(fill[keys[start]] - start, size) + np.arange(len(keys))] = who
        fill[keys[start]] += size

    def before(who: np.ndarray) -> np.ndarray:
        who = who[who > 0] - 1
        return who[own[who]]

    if len(first):
        put(first)
    at, width = 0, 1
    while at < len(used):
        c = used[at]
        stop = min(at + width, len(used))
        last = used[stop - 1]
        if stop > at + 1:
            mine = out[begins[c] : ends[last]]
            if (fill[c : last + 1] < ends[c : last + 1]).any():  # leave out places that are not filled yet
                buckets = used[at:stop]
                size = fill[buckets] - begins[buckets]
                mine = mine[np.arange(int(size.sum())) + np.repeat(begins[buckets] - begins[c] - (np.cumsum(size) - size), size)]
            others = seeds[seed_begins[c] : seed_ends[last]]
            who = np.concatenate([mine, others])
            bucket = np.concatenate([2 * text[mine].astype(np.int64), 2 * text[others].astype(np.int64) + 1])
            order = np.argsort(bucket, kind="stable")
            who, bucket = who[order], bucket[order] >> 1
            lead = (who > 0) & own[who - 1]
            lands = text[who[lead] - 1]
            inside = lands <= last
            if inside.any():  # go as far as the first bucket that is led to from here
                limit = int(lands[inside].min())
                lead &= bucket < limit
                stop = int(np.searchsorted(used, limit))
                width = max(1, (stop - at) * 2)
            else:
                width = min(width * 2, n)
            if stop > at:
                if lead.any():
                    put(who[lead] - 1)
                at = stop
                continue
        done = begins[c]
        while done < fill[c]:
            wave = out[done : fill[c]]
            done = int(fill[c])
            found = before(wave)
            if len(found):
                put(found)
        found = before(seeds[seed_begins[c] : seed_ends[c]])
        if len(found):
            put(found)
        at += 1
        width = max(2, width)
    return out


def induce(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The order of all suffixes, given the leftmost-smaller ones in order."""
    n, top = len(text), int(text.max()) + 1
    larger = _spread(text, ~smaller, seeds, np.array([n - 1]), top)  # the last one follows the empty suffix
    if not smaller.any():
        return larger
    down = _spread(top - 1 - text, smaller, larger[::-1], np.zeros(0, np.int64), top)[::-1]
    # larger ones first within a bucket
    after = np.cumsum(np.bincount(text[larger], minlength=top))
    before = np.cumsum(np.bincount(text[down], minlength=top)) - np.bincount(text[down], minlength=top)
    out = np.empty(n, np.int64)
    out[np.arange(len(larger)) + before[text[larger]]] = larger
    out[np.arange(len(down)) + after[text[down]]] = down
    return out


def _names(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Ranks from 0 of the leftmost-smaller substrings (each with the symbol at which the next one starts).

    Symbols count with their types, so none is the beginning of another. Each round takes in as many
    symbols as fit into 64 bits, of those substrings only that are still equal to others.
    """
    n, m = len(text), len(lms)
    bits = (2 * int(text.max()) + 3).bit_length()
    take = 64 // bits
    code = np.zeros(n + 1, np.uint64)  # the end is the smallest of all
    code[:n] = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(2) + smaller
    length = np.append(np.diff(lms) + 1, n - lms[-1] + 1)
    rank = np.zeros(m, np.int64)  # how many are smaller
    open_, k = np.arange(m), 0
    while len(open_):
        key, at, left = np.zeros(len(open_), np.uint64), lms[open_] + k, length[open_] - k
        for j in range(take):
            key = key << np.uint64(bits) | np.where(left > j, code[np.minimum(at + j, n)], np.uint64(0))
        group = rank[open_]
        order = np.lexsort((key, group)) if k else np.argsort(key, kind="stable")
        key, group, who = key[order], group[order], open_[order]
        head = np.append(True, group[1:] != group[:-1])
        fresh = head | np.append(True, key[1:] != key[:-1])
        start, first = np.flatnonzero(fresh), np.flatnonzero(head)
        size = np.diff(np.append(start, len(who)))
        rank[who] = group + np.repeat(start, size) - np.repeat(first, np.diff(np.append(first, len(who))))
        k += take
        open_ = who[(np.repeat(size, size) > 1) & (length[who] > k)]
    present = np.zeros(m, np.int64)
    present[rank] = 1
    return (np.cumsum(present) - 1)[rank]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of an array of whole numbers from 0, in order."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    top = int(text.max())
    text = text.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.int64)  # short symbols sort faster
    smaller = classify(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) < 2:
        return induce(text, smaller, lms)
    names = _names(text, smaller, lms)
    if int(names.max()) + 1 == len(names):  # all different: their ranks are their order
        order = np.empty(len(names), np.int64)
        order[names] = np.arange(len(names))
    else:
        order = suffix_array(names)
    return induce(text, smaller, lms[order])


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position, how many bytes its suffix shares with the one before it in order.

    Where the bytes before both suffixes are equal, the value is one less than that of the
    position before; only the others are compared, eight bytes at a time.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    i = np.arange(n)
    reducible = (i > 0) & (before > 0)
    reducible[reducible] = text[i[reducible] - 1] == text[before[reducible] - 1]
    # the position before must have the same neighbour, one to the left
    reducible[1:] &= before[:-1] == before[1:] - 1
    reducible[0] = False
    start = np.flatnonzero(~reducible)
    padded = np.append(text.astype(np.uint8), np.zeros(16, np.uint8))
    words = np.ndarray((n + 8,), np.uint64, padded.tobytes(), strides=(1,))
    value = np.zeros(len(start), np.int64)
    left = np.flatnonzero(before[start] >= 0)
    while len(left):
        a, b = start[left] + value[left], before[start[left]] + value[left]
        inside = np.maximum(a, b) < n
        left, a, b = left[inside], a[inside], b[inside]
        x = words[a] ^ words[b]
        equal = x == 0
        low = x & (~x + np.uint64(1))  # the lowest set bit lies in the first byte that differs
        bytes_same = np.where(equal, 8, (np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64)) // 8)
        value[left] += bytes_same
        left = left[equal]
    limit = n - np.maximum(start, before[start])
    value = np.minimum(value, limit)
    run = np.cumsum(~reducible) - 1
    return np.maximum(value[run] - (i - start[run]), 0)
