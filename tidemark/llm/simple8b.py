"""Simple-8b coding of unsigned integers in arrays.

A word of 64 bits holds a selector in its top four bits and, below, as many integers
as fit at the selector's width. Selector 15 is an escape: the next word is one integer
as it is. Integers are coded in runs of `RUN`, each of which starts a new word, so that
all runs are packed and unpacked side by side.
"""

from __future__ import annotations

import numpy as np

RUN = 1024
#: Count and width of a word's integers, by selector.
LAYOUTS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
COUNTS = np.array([c for c, _ in LAYOUTS] + [0, 1], np.int64)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that a value needs, one too many for some above 2 ** 53."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each run, with the number of words at the end)."""
    n = len(values)
    runs = -(-n // RUN)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32)
    wide = np.zeros((runs, RUN + LAYOUTS[0][0]), np.uint64)
    wide[:, :RUN].flat[:n] = values
    need = _bits(wide)
    selector = np.full((runs, RUN), ESCAPE, np.int8)
    # bits of the widest of the next `count` integers, for growing counts; the last layout that fits has the most integers
    widest, have = need, 1
    for s in range(len(LAYOUTS) - 1, -1, -1):
        count, width = LAYOUTS[s]
        if count > have:
            end = widest.shape[1] - (count - have)
            widest, have = np.maximum(widest[:, :end], widest[:, count - have:]), count
        np.copyto(selector, np.int8(s), where=widest[:, :RUN] <= width)
    lengths = np.full(runs, RUN)
    lengths[-1] = n - (runs - 1) * RUN
    at, active = np.zeros(runs, np.int64), np.arange(runs)
    picked_run, picked_at, picked = [], [], []
    while len(active):
        own = selector[active, at[active]]
        picked_run.append(active)
        picked_at.append(at[active])
        picked.append(own)
        at[active] += COUNTS[own]
        active = active[at[active] < lengths[active]]
    run, place, chosen = np.concatenate(picked_run), np.concatenate(picked_at), np.concatenate(picked)
    order = np.argsort(run * RUN + place)
    run, place, chosen = run[order], place[order], chosen[order]
    size = 1 + (chosen == ESCAPE)
    start = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    flat, origin = wide.ravel(), run * wide.shape[1] + place
    for s, (count, width) in enumerate(LAYOUTS):
        own = np.flatnonzero(chosen == s)
        if len(own):
            word = np.full(len(own), s << 60, np.uint64)
            for j in range(count):
                word |= flat[origin[own] + j] << np.uint64(j * width)
            words[start[own]] = word
    own = np.flatnonzero(chosen == ESCAPE)
    words[start[own]] = np.uint64(ESCAPE << 60)
    words[start[own] + 1] = flat[origin[own]]
    first = np.zeros(runs + 1, np.uint32)
    first[1:] = np.cumsum(np.bincount(run, size, runs))
    return words, first


def decode(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """The n values of `encode`."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[chosen]
    escapes = np.flatnonzero(chosen == ESCAPE)
    if len(escapes):
        # a raw word may look like an escape: of neighbours, every second is one
        raw = -1
        real = []
        for e in escapes.tolist():
            if e != raw:
                real.append(e)
                raw = e + 1
        escapes = np.array(real)
        chosen[escapes + 1] = ESCAPE
        counts[escapes], counts[escapes + 1] = 1, 0
        chosen[escapes] = ESCAPE
    run = np.repeat(np.arange(len(first) - 1), np.diff(first.astype(np.int64)))
    before = np.cumsum(counts) - counts
    place = run * RUN + before - before[first[:-1].astype(np.int64)][run]
    end = np.minimum((run + 1) * RUN, n)
    for s, (count, width) in enumerate(LAYOUTS):
        own = np.flatnonzero(chosen == s)
        if len(own):
            mask = np.uint64((1 << width) - 1)
            for j in range(count):
                at = place[own] + j
                ok = at < end[own]
                out[at[ok]] = (words[own[ok]] >> np.uint64(j * width)) & mask
    if len(escapes):
        out[place[escapes]] = words[escapes + 1]
    return out
