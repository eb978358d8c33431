"""Words of whole texts as arrays of hashes.

The texts of an Arrow column lie one after another in one buffer, so a batch is
cut into words, and the words are hashed, by a few array operations. Work is done
in chunks of some megabytes of text, whole texts each, to bound memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is a chunk of its own.
CHUNK = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Letters, digits and bytes of longer code points; all else separates.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK + 1), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[int(base)] = have
    return have[:n]


@dataclass
class Words:
    """Words of a chunk of texts, in order."""

    first_row: int  # of the chunk, in its batch
    rows: int
    row: np.ndarray  # of each word, from 0
    hash: np.ndarray  # uint64
    bounds: np.ndarray  # the words of row r are bounds[r]:bounds[r + 1]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is an empty text."""
    texts = texts.fill_null("") if texts.null_count else texts
    wide = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide, len(texts) + 1, texts.offset * np.dtype(wide).itemsize).astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows that hold about CHUNK bytes."""
    if not len(texts):
        return
    data, offsets = buffers(texts)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def fold_latin(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the Latin-1 capitals in UTF-8."""
    out = LOWER[data]
    if len(out) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 0x20
    return out


def running_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial sums of the bytes up to each place, from which `span_hashes` takes any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans of bytes starts[i]:ends[i], the same wherever the bytes stand."""
    return (sums[ends] - sums[starts]) * _power(_BASE_INVERSE, len(sums))[starts]


def words_of(texts: pa.Array, alnum: bool = False) -> Iterator[Words]:
    """Words of each text: runs of bytes other than ASCII white space with A-Z
    in lower case, or with `alnum` runs of letters and digits of any script, with
    Latin capitals in lower case."""
    for first, data, offsets in chunks(texts):
        rows = len(offsets) - 1
        inside = ALNUM[data] if alnum else ~SPACES[data]
        data = fold_latin(data) if alnum else LOWER[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        hashes = mix(span_hashes(running_hashes(data), starts, ends))
        bounds = np.searchsorted(starts, offsets)
        yield Words(first, rows, np.repeat(np.arange(rows), np.diff(bounds)), hashes, bounds)


_STEPS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles_of(words: Words, k: int = 5) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its runs of k words; of all its
    words where it has fewer; none where it has no word."""
    n = len(words.hash)
    runs = np.zeros(max(n - k + 1, 0), np.uint64)
    for j in range(k):
        runs += words.hash[j:n - k + 1 + j] * _STEPS[j] if n >= k else runs
    runs = mix(runs)
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= k:
            s = np.sort(runs[a:b - k + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            whole = (words.hash[a:b] * _STEPS[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
