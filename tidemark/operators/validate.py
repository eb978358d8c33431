"""Checks of a result against an expected one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


def _comparable(df: DataFrame, ignore: tuple[str, ...]) -> DataFrame:
    """Columns by name without the volatile ones."""
    return df.select(*sorted(c for c in df.columns if c not in ignore))


def difference(actual: DataFrame, expected: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Rows held more often by one side, with the number of surplus copies.

    Copies are counted, not repeated: a row that one side holds a million times
    more stays one row. `side` is '+' for surplus in the actual result.
    """
    a, e = _comparable(actual, ignore), _comparable(expected, ignore)
    if a.columns != e.columns:
        raise ValueError(f"columns differ: {a.columns} and {e.columns}")
    both = a.withColumn("_n", F.lit(1)).unionByName(e.withColumn("_n", F.lit(-1)))
    surplus = both.groupBy(*a.columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    return surplus.select(*a.columns, F.when(F.col("_n") > 0, "+").otherwise("-").alias("side"), F.abs("_n").alias("copies"))


def digest(df: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """One row: the number of rows and a sum of row hashes.

    The sum does not depend on the order of rows. A row's hash is the first 60
    bits of the MD5 of its values as text, so other engines can form it too.
    """
    rows = _comparable(df, ignore)
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in rows.columns])
    value = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.agg(F.count("*").alias("row_count"), F.coalesce(F.sum(value), F.lit(0)).cast("string").alias("hash_sum"))


@dataclass(frozen=True)
class Check:
    status: str  # PASS, FAIL or ERROR
    how: str
    diff: DataFrame | None = None


def check(actual: DataFrame, answer: DataFrame | None = None, expected_digest: tuple[int, str] | None = None, ignore: tuple[str, ...] = ()) -> Check:
    """By the answer if there is one, else by the digest; without either it is an error."""
    if answer is not None:
        diff = difference(actual, answer, ignore)
        return Check("PASS" if diff.isEmpty() else "FAIL", "answer", diff)
    if expected_digest is not None:
        row = digest(actual, ignore).first()
        return Check("PASS" if (row["row_count"], row["hash_sum"]) == expected_digest else "FAIL", "digest")
    return Check("ERROR", "nothing to compare with")


def row_counts(frames: dict[str, DataFrame], least: dict[str, int]) -> DataFrame:
    """Count of each table and whether it reaches the least expected."""
    out = None
    for name, df in frames.items():
        row = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows", (F.col("rows") >= least.get(name, 1)).alias("passed"))
        out = row if out is None else out.unionByName(row)
    return out
