"""The seeded draws as statements: the 64-bit hash of key columns, and what is made of it.

A hash starts from the seed and the draw's name, which are constants, and takes in one key
column after another, 4 bytes for an integer or a date and 8 for a bigint.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import xxhash

# The multipliers of the 64-bit hash.
M1, M2, M3, M4, M5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
SPARK_SEED = 42
ALL = (1 << 64) - 1


def _n(x: int) -> str:
    return f"{x}::uhugeint"


def _let(name: str, value: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def _mod(x: str) -> str:
    return f"({x}) & {_n(ALL)}"


def _rotated(x: str, bits: int) -> str:
    return _mod(f"({x} << {bits}) | ({x} >> {64 - bits})")


def _finished(h: str) -> str:
    last = "xor(c, c >> 32)"
    third = _let("c", _mod(f"xor(b, b >> 29) * {_n(M3)}"), last)
    return _let("a", h, _let("b", _mod(f"xor(a, a >> 33) * {_n(M2)}"), third))


def taken_in(h: str, key: str, size: int) -> str:
    """Hash `h` after a key of 4 or 8 bytes."""
    x = f"((({key})::hugeint + {1 << 8 * size}::hugeint) % {1 << 8 * size}::hugeint)::uhugeint"
    begun = _mod(f"{h} + {_n(M5 + size)}")
    if size == 4:
        mixed = f"xor({begun}, {_mod(f'{x} * {_n(M1)}')})"
        out = _let("m", mixed, _mod(f"({_rotated('m', 23)}) * {_n(M2)} + {_n(M3)}"))
    else:
        turned = _let("k", _mod(f"{x} * {_n(M2)}"), _mod(f"({_rotated('k', 31)}) * {_n(M1)}"))
        out = _let("m", f"xor({begun}, {turned})", _mod(f"({_rotated('m', 27)}) * {_n(M1)} + {_n(M4)}"))
    return _finished(out)


def _seeded(seed: int, name: str, n: int) -> int:
    h = SPARK_SEED
    for data in (struct.pack("<i", seed), name.encode(), struct.pack("<i", n)):
        h = xxhash.xxh64_intdigest(data, h)
    return h


@dataclass(frozen=True)
class Keyed:
    """Draws for rows with key columns (expression, bytes)."""

    seed: int
    keys: tuple[tuple[str, int], ...]

    def _unit(self, start: str) -> str:
        for key, size in self.keys:
            start = taken_in(start, key, size)
        return f"((({start}) >> 11)::double * {2.0 ** -53!r}::double)"

    def uniform(self, name: str, n: int = 0) -> str:
        return self._unit(_n(_seeded(self.seed, name, n)))

    def _z(self, name: str, n: int) -> str:
        return f"(sqrt(-2.0::double * ln(1.0::double - {self.uniform(name + '.r', n)})) * cos({self.uniform(name + '.a', n)} * 2.0::double * pi()))"

    def normal(self, name: str, mean: str, std: str, n: int = 0) -> str:
        return f"({mean} + {self._z(name, n)} * {std})"

    def _redrawn(self, value, holds: str, other: str) -> str:
        rest = ", ".join(value(n) for n in range(1, 10))
        later = f"coalesce(list_filter([{rest}], lambda w: {holds.replace('@', 'w')})[1], {other})"
        return _let("v", value(0), f"case when {holds.replace('@', 'v')} then v else {later} end")

    def bell(self, name: str, low: str, high: str, k: float = 4, bound: bool = True) -> str:
        middle = f"({low} + ({high} - {low}) / 2.0::double)"
        value = lambda n: f"round_even({self.normal(name, middle, f'(({high} - {low}) / 2.0::double / {float(k)}::double)', n)}, 0)::bigint"
        return self._redrawn(value, f"@ between {low} and {high}", f"round_even({middle}, 0)::bigint") if bound else value(0)

    def two_bells(self, name: str, low1: str, high1: str, low2: str, high2: str) -> str:
        return f"case when {self.uniform(name + '.hump')} < 0.5 then {self.bell(name + '.1', low1, high1)} else {self.bell(name + '.2', low2, high2)} end"

    def half_bell(self, name: str, low: str, high: str, k: float = 3, bound: bool = True) -> str:
        value = lambda n: _let("x", self.normal(name, low, f"(({high} - {low}) / 2.0::double / {float(k)}::double)", n),
                               f"round_even(case when x < {low} then abs(x) + {low} else x end, 0)::bigint")
        return self._redrawn(value, f"@ <= {high}", f"{low}::bigint") if bound else value(0)

    def power(self, name: str, low: int, high: int, n: int) -> str:
        a, b = float(low) ** (n + 1), float(high + 1) ** (n + 1)
        x = f"pow({b - a!r}::double * {self.uniform(name)} + {a!r}::double, {1.0 / (n + 1)!r}::double)"
        return f"least({high}, greatest({low}, {high + low} - floor({x})::bigint))::bigint"

    def whole(self, name: str, low: str | int, high: str | int) -> str:
        return f"({low} + floor({self.uniform(name)} * ({high} - {low} + 1)))::bigint"

    def flag(self, name: str, p: float) -> str:
        return f"({self.uniform(name)} <= {p!r}::double)"
