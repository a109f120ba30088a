"""Two-stage suffix sorting of a byte array, in whole-array steps.

Suffixes smaller than their successors are sorted directly, eight bytes and more at a time,
and only as far as asked. The rest are induced: buckets of equal first bytes are scanned in
order, and each suffix found puts its larger predecessor behind what that one's bucket holds.
A bucket is scanned at once; only runs of one byte need further turns.
"""

from __future__ import annotations

import numpy as np


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as a number that sorts like them."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(data), np.uint64)
    for i in range(8):
        words |= padded[i:i + len(data)] << np.uint64(56 - 8 * i)
    return words


def _smaller_than_next(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it (the last one is not)."""
    step = np.sign(np.diff(data.astype(np.int16), append=-1))
    place = np.where(step != 0, np.arange(len(data)), len(data) - 1)
    following = np.minimum.accumulate(place[::-1])[::-1]  # where the run of one byte ends
    return step[following] > 0


def _direct_order(starts: np.ndarray, data: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` sorted by their first ``depth`` bytes, or a little more."""
    words = _words(data)
    ranks = np.unique(words, return_inverse=True)[1].astype(np.uint64)
    # Two words make a name; names of two pairs and the group so far fit one number.
    beyond = np.uint64(len(data))

    def after(x: np.ndarray, by: int) -> np.ndarray:
        moved = np.zeros(len(x), np.uint64)
        moved[:max(len(x) - by, 0)] = x[by:] + np.uint64(1)
        return moved

    names = np.unique(ranks * (beyond + np.uint64(2)) + after(ranks, 8), return_inverse=True)[1]
    names = names.astype(np.uint64)
    bits = int(len(data) + 1).bit_length()
    far = after(names, 16)
    order = np.asarray(starts)
    group = np.zeros(len(order), np.uint64)
    tied = np.arange(len(order))  # places in the order that are not settled yet
    for at in range(0, depth, 32):
        if not len(tied):
            break
        places = order[tied] + at
        inside = places < len(data)
        places = np.minimum(places, len(data) - 1)
        first = np.where(inside, names[places] + np.uint64(1), 0)
        second = np.where(inside, far[places], 0)
        if 3 * bits <= 64:
            key = group[tied] << np.uint64(2 * bits) | first << np.uint64(bits) | second
            by = np.argsort(key, kind="stable")
            new = np.diff(key[by]) != 0
        else:
            by = np.lexsort((second, first, group[tied]))
            new = (
                (np.diff(group[tied][by]) != 0) | (np.diff(first[by]) != 0)
                | (np.diff(second[by]) != 0)
            )
        order[tied] = order[tied][by]
        heads = np.concatenate([[True], new])
        group[tied] = np.cumsum(heads)
        alone = heads & np.append(heads[1:], True)
        tied = tied[~alone]
    return order


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """All positions, sorted by their first ``depth`` bytes at least."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    smaller = _smaller_than_next(data)
    direct = _direct_order(np.flatnonzero(smaller), data, depth)
    cuts = np.searchsorted(data[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[data[-1]].append(np.array([n - 1]))
    buckets = []
    for byte in range(256):
        waves = induced[byte]
        at = 0
        while at < len(waves):  # predecessors of the same byte join the bucket under scan
            before = waves[at] - 1
            before = before[before >= 0]
            same = before[(data[before] == byte) & ~smaller[before]]
            if len(same):
                waves.append(same)
            at += 1
        bucket = np.concatenate([*waves, direct[cuts[byte]:cuts[byte + 1]]])
        buckets.append(bucket)
        before = bucket - 1
        before = before[before >= 0]
        larger = before[data[before] > byte]
        first = data[larger]
        by = np.argsort(first, kind="stable")
        larger, first = larger[by], first[by]
        heads = np.flatnonzero(np.diff(first, prepend=-1))
        for head, end in zip(heads, np.append(heads[1:], len(first))):
            induced[first[head]].append(larger[head:end])
    return np.concatenate(buckets)


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """How many bytes each position of ``order`` has in common with the one before, up to ``most``."""
    lengths = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = _words(data)
    for at in range(0, most, 8):
        a, b = order[alive] + at, order[alive - 1] + at
        inside = (a < len(data)) & (b < len(data))
        alive, a, b = alive[inside], a[inside], b[inside]
        same = words[a] == words[b]
        for i, x, y in ((alive[~same], a[~same], b[~same]),):
            left, going = np.zeros(len(i), np.int64), np.ones(len(i), bool)
            for k in range(8):
                going &= (padded[x + k] == padded[y + k]) & (np.maximum(x, y) + k < len(data))
                left += going
            lengths[i] = at + left
        alive, a, b = alive[same], a[same], b[same]
        lengths[alive] = at + np.minimum(8, len(data) - np.maximum(a, b))
    return np.minimum(lengths, most)
