"""Column and frame helpers shared by all suites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LOW_BITS = 20


def col(c: str | Column) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def exact(c: str | Column, scale: int = 4) -> Column:
    """Money as DECIMAL."""
    return col(c).cast(f"decimal(18,{scale})")


def total(c: str | Column) -> Column:
    """Sum of an exact column, shown as double."""
    return F.sum(col(c)).cast("double")


def exact_total(c: str | Column, scale: int = 4) -> Column:
    """Sum of a double column of money, exact to `scale` digits, as double.

    Sums of doubles depend on the order of rows. Here each value becomes whole
    units of its last digit, and the upper and lower bits of the units are summed
    apart: neither sum overflows, both stay in primitive longs, and casting every
    row to DECIMAL, which goes through text, is avoided.
    """
    units = F.rint(col(c) * F.lit(10.0**scale)).cast("bigint")
    upper = F.sum(F.shiftright(units, LOW_BITS)).cast("decimal(38,0)")
    lower = F.sum(units.bitwiseAND(F.lit((1 << LOW_BITS) - 1))).cast("decimal(38,0)")
    whole = upper * F.lit(1 << LOW_BITS).cast("decimal(8,0)") + lower
    return whole.cast("double") / F.lit(10.0**scale)


def mean(c: str | Column) -> Column:
    """Average of an exact column: exact sum over count, null for no rows."""
    return F.try_divide(F.sum(col(c)).cast("double"), F.count(col(c)))


def exact_mean(c: str | Column, scale: int = 2) -> Column:
    return F.try_divide(exact_total(c, scale), F.count(col(c)))


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b in double; null where b is zero."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def when(cond: str | Column, value: str | Column) -> Column:
    """The value where the condition holds, else null: a conditional aggregate's input."""
    return F.when(col(cond), col(value))


def sort_key(key: str) -> Column:
    """'x' ascending with nulls last, '-x' descending with nulls first."""
    return F.col(key[1:]).desc_nulls_first() if key.startswith("-") else F.col(key).asc_nulls_last()


def ordered(df: DataFrame, *keys: str, limit: int | None = None) -> DataFrame:
    df = df.orderBy(*[sort_key(k) for k in keys])
    return df.limit(limit) if limit else df
