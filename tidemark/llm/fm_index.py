"""A bidirectional FM-index of a delimited vocabulary, searched for many words at once.

The words stand in one text, a delimiter around each. One index of the text extends a match
to the left, one of the reversed text to the right; a match is a suffix-rank interval in
each, kept in step. Symbols are the code points of Latin-1 words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidemark.llm.suffixes import suffix_order

END, DELIMITER = 0, 1
#: Rows of an interval that are looked at one by one; of larger ones every symbol is tried.
ROWS = 48
#: Words searched at once.
AT_ONCE = 16_384
_BLOCK = 64


class _Ranks:
    """Suffix ranks of one text: extends intervals of matches by a symbol before them."""

    def __init__(self, text: np.ndarray, symbols: int):
        n = len(text)
        self.n, self.symbols = n, symbols
        self.order, _ = suffix_order(text.astype(np.int64), np.full(n, n))
        self.before = text[self.order - 1]
        # By (symbol, row): the place of (c, i) is how many suffixes are below c and row i's match.
        self.keys = np.sort(self.before.astype(np.int64) * (n + 1) + np.arange(n))
        blocks = -(-n // _BLOCK) + 1
        counts = np.zeros((blocks, symbols + 1), np.int32)
        np.add.at(counts, (np.arange(n) // _BLOCK + 1, self.before + 1), 1)
        self.smaller_before = np.cumsum(np.cumsum(counts, axis=0, dtype=np.int32), axis=1, dtype=np.int32)
        self.padded = np.append(self.before, np.full(_BLOCK, symbols, self.before.dtype))

    def extend(self, c: np.ndarray, row: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, c.astype(np.int64) * (self.n + 1) + row)

    def smaller(self, c: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Rows above `row` whose symbol before is less than c."""
        block = row // _BLOCK
        within = self.padded[(block * _BLOCK)[:, None] + np.arange(_BLOCK)]
        inside = np.arange(_BLOCK) < (row % _BLOCK)[:, None]
        return self.smaller_before[block, c] + ((within < c[:, None]) & inside).sum(axis=1)

    def choices(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, symbol): the letters that stand before the matches of each interval."""
        size = hi - lo
        small = np.flatnonzero(size <= ROWS)
        state = np.repeat(small, size[small])
        offset = np.cumsum(size[small]) - size[small]
        rows = np.arange(len(state)) - np.repeat(offset - lo[small], size[small])
        pairs = np.unique(state * self.symbols + self.before[rows])
        large = np.flatnonzero(size > ROWS)
        if len(large):
            pairs = np.concatenate((pairs, (large[:, None] * self.symbols + np.arange(self.symbols)).ravel()))
        state, symbol = pairs // self.symbols, pairs % self.symbols
        letter = symbol > DELIMITER
        return state[letter], symbol[letter]


@dataclass
class _Sequences:
    """Symbols of many sequences, each ended by a delimiter."""

    flat: np.ndarray
    start: np.ndarray
    length: np.ndarray  # with the delimiter

    @staticmethod
    def of(parts: list[bytes], symbol_of: np.ndarray) -> _Sequences:
        size = np.array([len(p) + 1 for p in parts], np.int64)
        return _Sequences(symbol_of[np.frombuffer(b"".join([p + b"\0" for p in parts]), np.uint8)].astype(np.int64), np.cumsum(size) - size, size)

    def at(self, i: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.flat[self.start[i] + place]


class Vocabulary:
    """Index of distinct Latin-1 words (bytes, none with a zero byte)."""

    def __init__(self, words: list[bytes], asked: list[bytes] = ()):
        letters = np.unique(np.frombuffer(b"".join([*words, *asked]), np.uint8))
        self.symbol_of = np.zeros(256, np.uint8)
        self.symbol_of[letters] = np.arange(len(letters)) + DELIMITER + 1
        self.symbol_of[0] = DELIMITER
        text = self.symbol_of[np.frombuffer(b"\0" + b"".join([w + b"\0" for w in words]), np.uint8)]
        self.delimiters = np.flatnonzero(text == DELIMITER)
        self.size = len(text)
        end = np.array([END], np.uint8)
        self.sides = (_Ranks(np.append(text, end), len(letters) + 2), _Ranks(np.append(text[::-1], end), len(letters) + 2))

    def with_one_error(self, words: list[bytes], halves: np.ndarray, right_exact: bool) -> tuple[np.ndarray, np.ndarray]:
        """(i, j), each once: indexed words j that differ from word i by exactly one inserted,
        deleted or replaced symbol, and hold its first halves[i] symbols unchanged in
        front, or with `right_exact` all others unchanged at the end."""
        found = [np.zeros((0, 2), np.int64)]
        for a in range(0, len(words), AT_ONCE):
            part, half = words[a:a + AT_ONCE], halves[a:a + AT_ONCE].tolist()
            left = [w[:h][::-1] for w, h in zip(part, half)]
            right = [w[h:] for w, h in zip(part, half)]
            exact, free = (right, left) if right_exact else (left, right)
            i, j = self._search(_Sequences.of(exact, self.symbol_of), _Sequences.of(free, self.symbol_of), int(right_exact))
            found.append(np.stack((i + a, j), axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def _search(self, exact: _Sequences, free: _Sequences, side: int) -> tuple[np.ndarray, np.ndarray]:
        i, lo, hi = self._exact(exact, side)
        ranks = self.sides[1 - side]
        step = 0
        # States with the error behind them: word, next place, interval.
        done_i, done_row = [], []
        e_i = e_p = e_lo = e_hi = np.zeros(0, np.int64)
        while len(i) or len(e_i):
            if len(e_i):
                c = free.at(e_i, e_p)
                e_lo, e_hi, e_p = ranks.extend(c, e_lo), ranks.extend(c, e_hi), e_p + 1
                alive = e_lo < e_hi
                last = alive & (e_p == free.length[e_i])
                done_i.append(e_i[last])
                done_row.append(e_lo[last])
                alive &= ~last
                e_i, e_p, e_lo, e_hi = e_i[alive], e_p[alive], e_lo[alive], e_hi[alive]
            if len(i):
                place = np.full(len(i), step)
                c = free.at(i, place)
                ends = c == DELIMITER
                state, symbol = ranks.choices(lo, hi)
                other = symbol != c[state]
                state, symbol = state[other], symbol[other]
                new_lo, new_hi = ranks.extend(symbol, lo[state]), ranks.extend(symbol, hi[state])
                real = new_lo < new_hi
                state, new_lo, new_hi = state[real], new_lo[real], new_hi[real]
                replaced = ~ends[state]
                # of a run of equal symbols only the last is deleted
                deleted = np.flatnonzero(~ends)
                deleted = deleted[c[deleted] != free.at(i[deleted], place[deleted] + 1)]
                e_i = np.concatenate((e_i, i[state], i[state[replaced]], i[deleted]))
                e_p = np.concatenate((e_p, place[state], place[state[replaced]] + 1, place[deleted] + 1))
                e_lo = np.concatenate((e_lo, new_lo, new_lo[replaced], lo[deleted]))
                e_hi = np.concatenate((e_hi, new_hi, new_hi[replaced], hi[deleted]))
                lo, hi = ranks.extend(c, lo), ranks.extend(c, hi)
                alive = (lo < hi) & ~ends
                i, lo, hi, step = i[alive], lo[alive], hi[alive], step + 1
        i = np.concatenate([np.zeros(0, np.int64), *done_i])
        at = ranks.order[np.concatenate([np.zeros(0, np.int64), *done_row])]
        # The match begins at the word's first delimiter, in the reversed text at its last.
        word = np.searchsorted(self.delimiters, at) if side else np.searchsorted(self.delimiters, self.size - 1 - at) - 1
        return i, word

    def _exact(self, exact: _Sequences, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words whose exact half, up to the delimiter, is in the text, and its interval on
        the other side, which is kept in step while the half grows on its own."""
        ranks = self.sides[side]
        i = np.arange(len(exact.start))
        lo, hi = np.zeros(len(i), np.int64), np.full(len(i), ranks.n)
        other = np.zeros(len(i), np.int64)
        out = [np.zeros((3, 0), np.int64)]
        step = 0
        while len(i):
            c = exact.at(i, np.full(len(i), step))
            other += ranks.smaller(c, hi) - ranks.smaller(c, lo)
            lo, hi, step = ranks.extend(c, lo), ranks.extend(c, hi), step + 1
            alive = lo < hi
            last = alive & (c == DELIMITER)
            out.append(np.stack((i[last], other[last], other[last] + hi[last] - lo[last])))
            alive &= ~last
            i, lo, hi, other = i[alive], lo[alive], hi[alive], other[alive]
        return tuple(np.concatenate(out, axis=1))
