"""Seeded random columns.

Every draw is a hash of (seed, draw name, key columns), so a row's values do
not depend on partitioning, task order or reruns. All are built-in column
expressions; none calls Python per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

REDRAWS = 10  # draws before a bounded value falls back to its centre


class Draws:
    """Named draws for rows identified by key columns."""

    def __init__(self, seed: int, *keys: str | Column):
        self.seed, self.keys = seed, keys

    def uniform(self, name: str, n: Column | None = None) -> Column:
        """Uniform in [0, 1), from the upper 53 bits of the hash."""
        h = F.xxhash64(F.lit(self.seed), F.lit(name), F.lit(0) if n is None else n, *self.keys)
        return F.shiftrightunsigned(h, 11).cast("double") * F.lit(2.0**-53)

    def normal(self, name: str, mean: float | Column = 0.0, std: float | Column = 1.0, n: Column | None = None) -> Column:
        """Normal draw from two uniforms."""
        u = F.lit(1.0) - self.uniform(f"{name}.r", n)  # in (0, 1]: the logarithm is finite
        angle = self.uniform(f"{name}.a", n) * F.lit(2.0 * math.pi)
        z = F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(angle)
        return _col(mean) + z * _col(std)

    def _bounded(self, draw, accept, fallback: Column) -> Column:
        """First accepted of ten draws. The other nine are evaluated only where
        the first fails, which is rare."""
        first = F.filter(F.array(draw(F.lit(0))), accept)
        others = F.filter(F.transform(F.sequence(F.lit(1), F.lit(REDRAWS - 1)), draw), accept)
        return F.coalesce(F.try_element_at(first, F.lit(1)), F.try_element_at(others, F.lit(1)), fallback)

    def bell(self, name: str, low, high, k: float = 4, bound: bool = True) -> Column:
        """Whole number, normal around the middle of a range with a deviation of
        half the range over k; redrawn until inside, else the middle."""
        low, high = _col(low), _col(high)
        half = (high - low) / 2.0
        middle = low + half

        def value(n: Column | None = None) -> Column:
            return F.rint(self.normal(name, middle, half / float(k), n)).cast("bigint")

        if not bound:
            return value()
        return self._bounded(value, lambda v: v.between(low, high), F.rint(middle).cast("bigint"))

    def two_bells(self, name: str, low1, high1, low2, high2, k: float = 4, bound: bool = True) -> Column:
        """One of two bells, each for half of the rows."""
        return F.when(self.uniform(f"{name}.hump") < 0.5, self.bell(f"{name}.1", low1, high1, k, bound)).otherwise(
            self.bell(f"{name}.2", low2, high2, k, bound))

    def half_bell(self, name: str, low, high, k: float = 3, bound: bool = True) -> Column:
        """Whole number at or above `low`, densest there. A draw below becomes its
        absolute value plus `low`; one above `high` is redrawn, else `low`."""
        low, high = _col(low), _col(high)
        std = (high - low) / 2.0 / float(k)

        def value(n: Column | None = None) -> Column:
            x = self.normal(name, low, std, n)
            return F.rint(F.when(x < low, F.abs(x) + low).otherwise(x)).cast("bigint")

        if not bound:
            return value()
        return self._bounded(value, lambda v: v <= high, F.rint(low).cast("bigint"))

    def power(self, name: str, low: int, high: int, n: int) -> Column:
        """Whole number in low..high whose frequency falls with a power law."""
        top = float(high + 1)
        a, b = float(low) ** (n + 1), top ** (n + 1)
        x = F.pow(F.lit(b - a) * self.uniform(name) + F.lit(a), F.lit(1.0 / (n + 1)))
        # x lies in [low, high + 1); its whole part counted down from the top.
        return F.least(F.lit(high), F.greatest(F.lit(low), F.lit(high + low) - F.floor(x))).cast("bigint")

    def whole(self, name: str, low, high) -> Column:
        """Uniform whole number in low..high."""
        low, high = _col(low), _col(high)
        return (low + F.floor(self.uniform(name) * (high - low + 1))).cast("bigint")

    def flag(self, name: str, p) -> Column:
        """True with probability p."""
        return self.uniform(name) <= _col(p)


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)
