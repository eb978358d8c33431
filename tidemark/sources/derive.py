"""Tables the suites need and the stored data lacks, as integer arithmetic on keys.

A definition is a list of projection stages over a base. The same expression
text runs in Spark and in the checking engine; the few functions that differ
are written as @days(x) (days since 1970-01-01), @secs(n) (interval of n
seconds), @date(n) (date of day n), @epoch(t) (seconds since 1970) and
@run_events (half of the event ids, rounded up).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

JULIAN = 2440588  # Julian day number of 1970-01-01, the origin of date keys


def to_spark(text: str) -> str:
    text = text.replace("@epoch(", "timestampdiff(second, timestamp_ntz '1970-01-01', ")
    text = text.replace("@days(", "unix_date(").replace("@date(", "date_from_unix_date(")
    return text.replace("@secs(", "make_dt_interval(0,0,0,").replace("@run_events", "__run_events")


def to_duckdb(text: str) -> str:
    text = text.replace("@days(", "date_diff('day', date '1970-01-01', ")
    text = text.replace("@run_events", "(select max(event_id) // 2 + 1 from events)")
    text = text.replace("@secs(", "to_seconds(").replace("@epoch(", "date_diff('second', timestamp '1970-01-01', ")
    return text.replace("@date(", "(date '1970-01-01' + ").replace("timestamp_ntz", "timestamp")


@dataclass(frozen=True)
class Derived:
    """base: a stored table, or 'range:N' (column id), optionally exploded with
    `times`: (column, count expression) giving 0..count-1 per base row."""

    base: str
    stages: tuple[dict[str, str], ...]
    where: str | None = None
    times: tuple[str, str] | None = None
    keep: bool = False  # keep the base columns that no stage redefines


def pick(index: str, values: list[str]) -> str:
    """The value at position index % len(values)."""
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case ({index}) % {len(values)} {arms} end"


def idiv(a: str, b: int | str) -> str:
    return f"cast(floor(({a}) / {b}) as bigint)"


def cents(x: str) -> str:
    return f"cast(({x}) * 0.01 as decimal(7,2))"


def code(prefix: str, x: str, width: int = 8) -> str:
    return f"'{prefix}' || lpad(cast({x} as string), {width}, '0')"


def build(spark: SparkSession, base: DataFrame | None, d: Derived) -> DataFrame:
    df = spark.range(int(d.base.split(":")[1])) if d.base.startswith("range:") else base
    if d.where:
        df = df.filter(to_spark(d.where))
    if d.times:
        name, count = d.times
        df = df.withColumn(name, F.expr(f"explode(sequence(0, cast({to_spark(count)} as int) - 1))"))
    for stage in d.stages:
        if d.keep:
            df = df.withColumns({k: F.expr(to_spark(v)) for k, v in stage.items()})
        else:
            df = df.selectExpr(*[f"{to_spark(v)} as {k}" for k, v in stage.items()])
    return df


def duckdb_text(d: Derived, columns: list[str] | None = None) -> str:
    if d.base.startswith("range:"):
        sql = f"select range as id from range({d.base.split(':')[1]})"
    else:
        sql = f"select * from {d.base}"
    if d.where:
        sql += f" where {to_duckdb(d.where)}"
    if d.times:
        name, count = d.times
        sql = f"select *, unnest(range(0, cast({to_duckdb(count)} as bigint))) as {name} from ({sql})"
    for stage in d.stages:
        cols = ", ".join(f"{to_duckdb(v)} as {k}" for k, v in stage.items())
        if d.keep:
            gone = [k for k in stage if k in (columns or [])]
            cut = f" exclude ({', '.join(gone)})" if gone else ""
            sql = f"select *{cut}, {cols} from ({sql})"
        else:
            sql = f"select {cols} from ({sql})"
    return sql
