"""Suffix order and common prefixes of many short sequences at once.

The sequences lie one after another in one array. Equal symbols have equal codes; codes of
different sequences differ where no prefix may be shared between sequences.
"""

from __future__ import annotations

import numpy as np


def _group_starts(keys: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys that fill `slots`: the first slot of each key's run, and whether
    the run has more than one key."""
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    begin = np.flatnonzero(first)
    sizes = np.diff(np.append(begin, len(keys)))
    return np.repeat(slots[begin], sizes), np.repeat(sizes > 1, sizes)


def suffix_order(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order, ranks): the starts of all suffixes in order, and per level t the rank of
    each position by its first 2^t symbols. A suffix ends at `ends[position]`, the end of
    its sequence; a shorter suffix comes first.

    Prefix doubling: a level sorts only the positions that share their prefix with
    another one, so texts with few repeats cost little more than one sort.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    rank = np.zeros(n + 1, np.int64)
    rank[n] = -1
    begin, shared = _group_starts(codes[order], np.arange(n))
    rank[order] = begin
    ranks, width = [rank.copy()], 1
    slots = np.flatnonzero(shared)
    while len(slots):
        open_ = order[slots]
        after = open_ + width
        second = np.where(after < ends[open_], rank[np.minimum(after, n)] + 1, 0)
        keys = rank[open_] * (n + 1) + second
        by = np.argsort(keys, kind="stable")
        open_, keys = open_[by], keys[by]
        order[slots] = open_
        begin, shared = _group_starts(keys, slots)
        rank[open_] = begin
        ranks.append(rank.copy())
        slots, width = slots[shared], width * 2
    return order, ranks


def common_prefixes(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Symbols that the suffixes at a and at b (a <> b) share from their starts on."""
    length = np.zeros(len(a), np.int64)
    for t in range(len(ranks) - 1, -1, -1):
        length += (ranks[t][a + length] == ranks[t][b + length]).astype(np.int64) << t
    return length


def longest_repeats(codes: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Per position, the length of the longest substring that starts there and also
    elsewhere; 0 where that is shorter than `least`.

    A suffix belongs to the longest-common-prefix interval of its nearer neighbour in
    suffix order; the interval's common prefix is that substring.
    """
    order, ranks = suffix_order(codes, ends)
    out = np.zeros(len(codes), np.int64)
    if len(codes) < 2:
        return out
    # Neighbours with a common prefix of 2^t <= least symbols; all others are too short.
    level = min(least.bit_length() - 1, len(ranks) - 1)
    near = np.flatnonzero(ranks[level][order[1:]] == ranks[level][order[:-1]])
    a, b = order[near], order[near + 1]
    length = common_prefixes(ranks, a, b)
    length[length < least] = 0
    np.maximum.at(out, a, length)
    np.maximum.at(out, b, length)
    return out


def maximal(repeats: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Positions whose repeat is no tail of the one before: what starts a symbol earlier
    does not repeat with it. `begins` is each position's sequence start."""
    before = np.zeros(len(repeats), np.int64)
    before[1:] = repeats[:-1]
    at = np.arange(len(repeats))
    return np.flatnonzero((repeats > 0) & ((at == begins) | (before <= repeats)))


def covered(positions: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n symbols lies in one of the spans: their union."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, positions, 1)
    np.add.at(edges, positions + lengths, -1)
    return np.cumsum(edges[:-1]) > 0
