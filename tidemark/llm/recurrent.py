"""Bidirectional gated recurrent networks over symbols, in numpy.

Symbols are bytes, and `PAD` after a text's end. Gates use x / (1 + |x|), whose slope is
as easy to form, in place of exponentials. A network reads many windows side by side:
every step is a few array operations over all of them. Training is backpropagation
through time with Adam; gradients are exact and tested against differences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PAD = 256
SYMBOLS = 257
#: Windows read side by side.
LANES = 8192


def squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


class Cell:
    """A GRU or LSTM in one direction: `table` holds each symbol's gate inputs, `state`
    the gates' weights on the previous state. Gates of a GRU are update, reset, new; of
    an LSTM input, forget, output, new."""

    def __init__(self, gates: int, hidden: int, rng: np.random.Generator):
        self.gates, self.hidden = gates, hidden
        self.table = rng.normal(0, 0.5, (SYMBOLS, gates, hidden)).astype(np.float32)
        self.state = rng.normal(0, hidden ** -0.5, (gates, hidden, hidden)).astype(np.float32)
        if gates == 4:
            self.table[:, 1] += 1  # remember at first

    def parameters(self) -> list[np.ndarray]:
        return [self.table, self.state]

    # -- training: keeps what the way back needs

    def forward(self, symbols: np.ndarray) -> tuple[np.ndarray, list]:
        """States (time, windows, hidden) for symbols (time, windows)."""
        n = symbols.shape[1]
        h = np.zeros((n, self.hidden), self.table.dtype)
        c = np.zeros_like(h)
        out, kept = [], []
        for t in range(len(symbols)):
            x = self.table[symbols[t]]
            u = np.stack([h @ w for w in self.state], axis=1)
            if self.gates == 3:
                z, r = 0.5 + 0.5 * squash(x[:, 0] + u[:, 0]), 0.5 + 0.5 * squash(x[:, 1] + u[:, 1])
                new = squash(x[:, 2] + r * u[:, 2])
                kept.append((h, z, r, new, u[:, 2]))
                h = new + z * (h - new)
            else:
                i, f, o = (0.5 + 0.5 * squash(x[:, g] + u[:, g]) for g in range(3))
                new = squash(x[:, 3] + u[:, 3])
                before, c = c, f * c + i * new
                s = squash(c)
                kept.append((h, i, f, o, new, before, c, s))
                h = o * s
            out.append(h)
        return np.stack(out), kept

    def backward(self, symbols: np.ndarray, kept: list, grad: np.ndarray) -> list[np.ndarray]:
        """Gradients of the parameters, given those of the states."""
        table, state = np.zeros_like(self.table), np.zeros_like(self.state)
        dh = np.zeros_like(grad[0])
        dc = np.zeros_like(dh)
        gate = lambda s: 2 * np.minimum(s, 1 - s) ** 2  # noqa: E731  slope of 0.5 + 0.5 * squash
        new_slope = lambda s: (1 - np.abs(s)) ** 2
        for t in range(len(symbols) - 1, -1, -1):
            dh = dh + grad[t]
            if self.gates == 3:
                h, z, r, new, un = kept[t]
                d_new = dh * (1 - z) * new_slope(new)
                d = [dh * (h - new) * gate(z), d_new * un * gate(r), d_new]
                du = [d[0], d[1], d_new * r]
                dh = dh * z
            else:
                h, i, f, o, new, before, c, s = kept[t]
                dc = dc + dh * o * new_slope(s)
                d = [dc * new * gate(i), dc * before * gate(f), dh * s * gate(o), dc * i * new_slope(new)]
                du = d
                dc = dc * f
                dh = np.zeros_like(dh)
            for g in range(self.gates):
                state[g] += h.T @ du[g]
                dh = dh + du[g] @ self.state[g].T
            np.add.at(table, symbols[t], np.stack(d, axis=1))
        return [table, state]

    # -- inference: writes into buffers that are used again

    def states(self, symbols: np.ndarray, backward: bool = False) -> Iterator[tuple[int, np.ndarray]]:
        """(time, states) step by step; the array is overwritten by the next step."""
        n = symbols.shape[1]
        tables = [np.ascontiguousarray(self.table[:, g]) for g in range(self.gates)]
        weights = [np.ascontiguousarray(w) for w in self.state]
        h, c = np.zeros((n, self.hidden), np.float32), np.zeros((n, self.hidden), np.float32)
        a, size = [np.empty_like(h) for _ in range(self.gates)], np.empty_like(h)
        at = np.empty(n, np.intp)

        def squashed(x: np.ndarray) -> None:
            np.abs(x, out=size)
            np.add(size, 1, out=size)
            np.divide(x, size, out=x)

        def opened(x: np.ndarray) -> None:
            squashed(x)
            np.multiply(x, 0.5, out=x)
            np.add(x, 0.5, out=x)

        last = self.gates - 1
        for t in range(len(symbols) - 1, -1, -1) if backward else range(len(symbols)):
            at[:] = symbols[t]
            for g in range(self.gates):
                np.take(tables[g], at, axis=0, out=a[g], mode="clip")
                if g < last or self.gates == 4:
                    np.dot(h, weights[g], out=size)
                    np.add(a[g], size, out=a[g])
                if g < last:
                    opened(a[g])
            if self.gates == 3:
                np.dot(h, weights[2], out=size)
                np.multiply(size, a[1], out=size)
                np.add(a[2], size, out=a[2])
                squashed(a[2])
                np.subtract(h, a[2], out=h)
                np.multiply(h, a[0], out=h)
                np.add(h, a[2], out=h)
            else:
                squashed(a[3])
                np.multiply(c, a[1], out=c)
                np.multiply(a[3], a[0], out=a[3])
                np.add(c, a[3], out=c)
                h[:] = c
                squashed(h)
                np.multiply(h, a[2], out=h)
            yield t, h


class Bidirectional:
    """Scores of `outputs` labels at every position, from a cell in each direction."""

    def __init__(self, gates: int, hidden: int, outputs: int, seed: int):
        rng = np.random.default_rng(seed)
        self.cells = [Cell(gates, hidden, rng), Cell(gates, hidden, rng)]
        self.out = rng.normal(0, hidden ** -0.5, (2, hidden, outputs)).astype(np.float32)
        self.bias = np.zeros(outputs, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.cells[0].parameters(), *self.cells[1].parameters(), self.out, self.bias]

    def forward(self, symbols: np.ndarray) -> tuple[np.ndarray, tuple]:
        a, kept_a = self.cells[0].forward(symbols)
        b, kept_b = self.cells[1].forward(symbols[::-1])
        return a @ self.out[0] + b[::-1] @ self.out[1] + self.bias, (symbols, a, kept_a, b, kept_b)

    def backward(self, kept: tuple, grad: np.ndarray) -> list[np.ndarray]:
        symbols, a, kept_a, b, kept_b = kept
        flat = grad.reshape(-1, grad.shape[-1])
        out = np.stack([a.reshape(-1, a.shape[-1]).T @ flat, b[::-1].reshape(-1, b.shape[-1]).T @ flat])
        return [*self.cells[0].backward(symbols, kept_a, grad @ self.out[0].T),
                *self.cells[1].backward(symbols[::-1], kept_b, (grad @ self.out[1].T)[::-1]), out, flat.sum(axis=0)]

    def scores(self, symbols: np.ndarray) -> np.ndarray:
        """(time, windows, outputs) without what training keeps."""
        out = np.empty((*symbols.shape, len(self.bias)), np.float32)
        step = np.empty(out.shape[1:], np.float32)
        for t, h in self.cells[0].states(symbols):
            np.dot(h, self.out[0], out=out[t])
        for t, h in self.cells[1].states(symbols, backward=True):
            np.dot(h, self.out[1], out=step)
            out[t] += step
            out[t] += self.bias
        return out


class Adam:
    def __init__(self, parameters: list[np.ndarray], rate: float):
        self.parameters, self.rate, self.t = parameters, rate, 0
        self.m = [np.zeros_like(p) for p in parameters]
        self.v = [np.zeros_like(p) for p in parameters]

    def step(self, grads: list[np.ndarray], scale: float = 1.0) -> None:
        self.t += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        clip = min(1.0, 1.0 / max(norm, 1e-12))
        for p, g, m, v in zip(self.parameters, grads, self.m, self.v):
            g = g * np.float32(clip)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (self.rate * scale * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.99 ** self.t)) + 1e-8)).astype(p.dtype)


def windows_of(lengths: np.ndarray, size: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, first position) of windows that cover texts of these lengths, empty ones
    having none: each starts a stride after the one before, the last reaches the end."""
    count = np.where(lengths > 0, np.maximum(1, -(-(lengths - size) // stride) + 1), 0)
    text = np.repeat(np.arange(len(lengths)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return text, number * stride


def gathered(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """(time, windows) of the symbols from `starts`, PAD from `ends` on."""
    padded = np.full(len(symbols) + size, PAD, np.int16)
    padded[:len(symbols)] = symbols
    rows = np.lib.stride_tricks.sliding_window_view(padded, size)[starts]
    cut = np.flatnonzero(ends < starts + size)
    rows[cut] = np.where(np.arange(size)[None, :] < (ends - starts)[cut, None], rows[cut], PAD)
    return np.ascontiguousarray(rows.T)
