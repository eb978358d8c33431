"""Bounded samples of rows for training on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F

#: Rows looked for, over those wanted, when the bound on the hash is chosen.
MARGIN = 1.5


def window_at(text: str, characters: int, hashed: Column) -> Column:
    """Characters of a text from a place that a hash chooses, anywhere in it: the whole text
    if it has no more."""
    places = F.greatest(F.length(text) - characters + 1, F.lit(1))
    return F.substring(F.col(text), (F.pmod(hashed, places) + 1).cast("int"), F.lit(characters))


def least_hashed(rows: DataFrame, limit: int, *ties: str) -> list[Row]:
    """The `limit` rows of the least hash in their column `h` (a long, spread evenly), all if
    there are fewer. A bound on the hash is set first, so that tasks send to the driver about
    MARGIN times the rows wanted in all, however many tasks there are."""
    n = rows.count()
    chosen = rows
    if n > 2 * MARGIN * limit:
        below = rows.filter(F.col("h") < int(-(1 << 63) + (1 << 64) * (MARGIN * limit / n)))
        if below.count() >= limit:
            chosen = below
    return chosen.orderBy("h", *ties).limit(limit).collect()
