"""Burrows-Wheeler transforms of shards of strings, merged by iterative interleave refinement.

Each shard's suffixes are sorted on their own; no suffix is compared with one of
another shard. The merge holds one thing only, the interleave: which shard each
place of the merged order belongs to. A shard's first place is its first suffix
in its own order, the second place its second, and so on.

A round reads, for every place of the interleave, the ``step`` symbols before
that suffix from the shard's transform, in the shard's order, and deals the
places by them, keeping their order otherwise: the stable sort of the interleave
is the interleave of the suffixes that are ``step`` symbols longer. After r
rounds it is in order of the first r * step symbols, and neighbours between
which no dealing has parted have these symbols as common prefix. After length /
step rounds these are the repeated intervals.

The symbols before a suffix are one number, the same for all shards of a merge;
``step`` bytes make one symbol of a larger alphabet. Suffixes with fewer symbols
left than the rounds have dealt by, and such that stand alone already, leave the
interleave and the shards' orders alike.
"""

from __future__ import annotations

import numpy as np

_SYMBOL = 9  # bits
_PACKED = 5  # symbols in one packed word


def _packed(text: np.ndarray, count: int) -> np.ndarray:
    """The next ``count`` symbols from each place on as one word."""
    word = np.zeros(len(text), np.int64)
    for k in range(count):
        word <<= _SYMBOL
        word[: max(len(text) - k, 0)] |= text[k:]
    return word


def _dense(words: np.ndarray) -> np.ndarray:
    """The words' ranks among the distinct ones, in the narrowest type, which sorts fastest."""
    order = np.argsort(words, kind="stable")
    fresh = np.zeros(len(words), np.int64)
    fresh[1:] = words[order[1:]] != words[order[:-1]]
    rank = np.empty(len(words), np.int64)
    rank[order] = np.cumsum(fresh)
    most = int(rank.max(initial=0))
    return rank.astype(np.uint16 if most < 1 << 16 else np.uint32)


def steps_of(length: int) -> int:
    """The largest step of at most ten symbols that divides the length."""
    return next(s for s in (10, 9, 8, 7, 6, 5, 4, 3, 2, 1) if length % s == 0)


def grams(text: np.ndarray, step: int) -> np.ndarray:
    """A number for the ``step`` symbols from each place on; equal for equal symbols."""
    first = _dense(_packed(text, min(step, _PACKED)))
    if step <= _PACKED:
        return first
    rest = np.zeros(len(text), np.int64)
    rest[: max(len(text) - _PACKED, 0)] = _dense(_packed(text, step - _PACKED))[_PACKED:]
    return _dense((first.astype(np.int64) << 32) | rest)


def shard_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes of one shard in order.

    ``text`` holds symbols 1..256 and a 0 after each string; ``ends`` are the
    zeros' places. Terminators sort before all symbols, in string order.
    """
    n = len(text)
    string = np.searchsorted(ends, np.arange(n))
    left = ends[string] - np.arange(n)
    packed = np.zeros(n, np.int64)
    for k in range(_PACKED):  # nothing after a terminator counts
        packed <<= _SYMBOL
        packed[: max(n - k, 0)] |= np.where(left[: max(n - k, 0)] >= k, text[k:], 0)
    size, key = _PACKED, packed
    keys = [np.where(left < size, string, -1), key]
    order = np.lexsort(keys)
    while True:
        changed = np.zeros(n, np.int64)
        for k in keys:
            changed[1:] |= k[order[1:]] != k[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(changed)
        if rank[order[-1]] == n - 1:
            return order
        follow = np.zeros(n, np.int64)
        follow[: n - size] = rank[size:] + 1  # behind a terminator it does not matter: the rank is unique already
        keys = [rank * (n + 1) + follow]
        order = np.argsort(keys[0], kind="stable")
        size *= 2


def repeated_intervals(strings: list[bytes], length: int, shard_bytes: int = 1 << 14) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes whose first ``length`` bytes occur at least twice: (string, offset, interval number)."""
    nothing = np.zeros(0, np.int64)
    if not strings:
        return nothing, nothing, nothing
    size = np.array([len(s) + 1 for s in strings], np.int64)
    text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int16) + 1
    ends = np.cumsum(size) - 1
    text[ends] = 0
    begins = ends + 1 - size
    orders, owner = [], []
    at = 0
    while at < len(strings):
        stop = max(at + 1, int(np.searchsorted(ends, begins[at] + shard_bytes, "right")))
        low, high = begins[at], ends[stop - 1] + 1
        orders.append(shard_order(text[low:high], ends[at:stop] - low) + low)
        owner.append(np.full(high - low, len(orders) - 1))
        at = stop
    orders = np.concatenate(orders)
    shard = np.concatenate(owner).astype(np.uint8 if len(owner) <= 256 else np.uint16 if len(owner) <= 1 << 16 else np.int64)
    step = steps_of(length)
    before = grams(text, step)
    offset = np.arange(len(text)) - np.repeat(begins, size)
    sequence, interleave, block = orders, shard, np.zeros(len(text), np.int64)
    for _ in range(length // step):
        places = np.argsort(interleave, kind="stable")
        suffix = np.empty(len(sequence), np.int64)
        suffix[places] = sequence  # each shard is read in its own order
        moves = offset[suffix] >= step
        suffix, interleave, block = suffix[moves] - step, interleave[moves], block[moves]
        if not len(suffix):
            return nothing, nothing, nothing
        symbol = before[suffix]
        dealt = np.argsort(symbol, kind="stable")
        symbol, block, suffix = symbol[dealt], block[dealt], suffix[dealt]
        fresh = np.ones(len(dealt) + 1, bool)
        fresh[1:-1] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        stays = ~(fresh[:-1] & fresh[1:])
        interleave, block = interleave[dealt][stays], (np.cumsum(fresh[:-1]) - 1)[stays]
        kept = np.zeros(len(text), bool)
        kept[suffix[stays]] = True
        sequence = orders[kept[orders]]
    places = np.argsort(interleave, kind="stable")
    suffix = np.empty(len(sequence), np.int64)
    suffix[places] = sequence
    string = np.searchsorted(ends, suffix, "left")
    return string, offset[suffix], block
