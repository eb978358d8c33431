"""Facts stored in spans of time of mixed length.

History lies in months, the recent past in weeks, and what is being loaded in one open span;
rows outside all of them go to a last one. A span's folder is named after its first day
and the day it ends before, so a name says what the folder holds, whatever grains were in
force when it was written. The table's property SPANS says which grains are: a scan
reads the folders of these, and all others are waste.

So a change of grains first writes the new folders beside the old ones, then sets the
property, a single change of the catalogue, then empties the old folders. Wherever it
stops, a scan sees each row once, and the same call again completes it.

Within a span, rows lie by the batch that brought them. A batch that is loaded again
replaces what it left, and rows that it brings anew replace those of earlier batches.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources.layout import replace_partitions
from tidemark.sources.shared import make_folder, move_folder, remove_folder, subfolders

SPAN, BATCH = "span", "batch"
SPANS = "spans"
#: The batch of rows that a change of grains has brought together.
MERGED = "merged"
#: Beginning of the names of what is put apart while a fact is made.
LATER = "later"
DAYS_A_WEEK = 7
#: Codec of the stored rows.
CODEC = "zstd"


@dataclass(frozen=True)
class Grains:
    """Days (ISO) at which months begin, weeks begin, the open span begins, and it ends before."""

    first_day: str
    monthly_end: str
    weekly_end: str
    end: str

    def __post_init__(self):
        if not self.first_day <= self.monthly_end <= self.weekly_end <= self.end:
            raise ValueError(f"grains out of order: {self}")

    def spans(self) -> list[tuple[str, dt.date, dt.date]]:
        """(name, first day, end) of each span: as many as the calendar has, whatever the rows."""
        first, monthly, weekly, end = (dt.date.fromisoformat(d) for d in (self.first_day, self.monthly_end, self.weekly_end, self.end))
        out, at = [], first
        while at < monthly:
            until = min((at.replace(day=1) + dt.timedelta(days=31)).replace(day=1), monthly)
            out.append(("month", at, until))
            at = until
        while at < weekly:
            until = min(at + dt.timedelta(days=DAYS_A_WEEK), weekly)
            out.append(("week", at, until))
            at = until
        if at < end:
            out.append(("open", at, end))
        return [(f"{kind}_{a}_{b}", a, b) for kind, a, b in out]

    @property
    def outside(self) -> str:
        """The span of all other times, and of none."""
        return f"other_{self.first_day}_{self.end}"

    def names(self) -> list[str]:
        return [name for name, _, _ in self.spans()] + [self.outside]

    def name_of(self, ts: str) -> Column:
        """The span of a time, by arithmetic on its day."""
        day = F.col(ts).cast("date")
        first, monthly, weekly, end = (F.lit(d).cast("date") for d in (self.first_day, self.monthly_end, self.weekly_end, self.end))
        month = F.trunc(day, "MM")
        week = F.date_add(monthly, (F.floor(F.datediff(day, monthly) / DAYS_A_WEEK) * DAYS_A_WEEK).cast("int"))
        name = lambda kind, a, b: F.concat_ws("_", F.lit(kind), a.cast("string"), b.cast("string"))
        return (F.when((day < first) | (day >= end) | day.isNull(), F.lit(self.outside))
                .when(day < monthly, name("month", F.greatest(month, first), F.least(F.add_months(month, 1), monthly)))
                .when(day < weekly, name("week", week, F.least(F.date_add(week, DAYS_A_WEEK), weekly)))
                .otherwise(name("open", weekly, end)))


@dataclass(frozen=True)
class SpanFact:
    """A stored fact: its table, time column and key column."""

    spark: SparkSession
    table: str
    ts: str
    key: str

    @staticmethod
    def create(rows: DataFrame, table: str, ts: str, key: str, grains: Grains, batch: str = "preload", path: str | None = None, gathered: bool = False) -> SpanFact:
        """Stores `rows`, which have unique keys, as the first batch. Rows that lie `gathered` by
        time, as those of another fact do, are written where they are."""
        fact = SpanFact(rows.sparkSession, table, ts, key)
        tagged = rows.withColumn(SPAN, grains.name_of(ts)).withColumn(BATCH, F.lit(batch))
        writer = (tagged if gathered else tagged.hint("rebalance", SPAN)).write.mode("overwrite").format("parquet").option("compression", CODEC).partitionBy(SPAN, BATCH)
        (writer.option("path", path) if path else writer).saveAsTable(table)
        fact._set(grains)
        return fact

    @staticmethod
    def create_apart(rows: DataFrame, table: str, ts: str, key: str, grains: Grains, bound: str, path: str, apart: str, day: str,
                     batch: str = "preload", gathered: bool = False) -> SpanFact:
        """Stores the rows before the time `bound` as the first batch, and those from it on in
        `apart`, a folder `day`=... each day. All are written in one pass; the folders of days
        are then renamed to their place. Rows without a time are in neither."""
        spark, later = rows.sparkSession, f"{LATER}_"
        held = F.col(ts) >= F.lit(bound).cast("timestamp_ntz")
        name = F.when(held, F.concat(F.lit(later), F.col(ts).cast("date").cast("string"))).otherwise(grains.name_of(ts))
        tagged = rows.filter(F.col(ts).isNotNull()).withColumn(SPAN, name).withColumn(BATCH, F.lit(batch))
        (tagged if gathered else tagged.hint("rebalance", SPAN)).write.mode("overwrite").option("compression", CODEC).partitionBy(SPAN, BATCH).parquet(path)
        make_folder(spark, apart)
        for folder in subfolders(spark, path):
            if folder.startswith(f"{SPAN}={later}"):
                move_folder(spark, f"{path}/{folder}/{BATCH}={batch}", f"{apart}/{day}={folder.removeprefix(f'{SPAN}={later}')}")
                remove_folder(spark, f"{path}/{folder}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tagged.schema.fields)
        spark.sql(f"create table {table} ({columns}) using parquet options (compression '{CODEC}') partitioned by ({SPAN}, {BATCH}) location '{path}'")
        spark.catalog.recoverPartitions(table)
        fact = SpanFact(spark, table, ts, key)
        fact._set(grains)
        return fact

    def _open(self) -> DataFrame:
        """The table with the files it has now: a stream writes in a session of its own."""
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def _set(self, grains: Grains) -> None:
        self.spark.sql(f"alter table {self.table} set tblproperties ('{SPANS}' = '{json.dumps(asdict(grains))}')")

    def grains(self) -> Grains:
        found = {r.key: r.value for r in self.spark.sql(f"show tblproperties {self.table}").collect()}
        return Grains(**json.loads(found[SPANS]))

    def stored(self) -> DataFrame:
        """All rows of the spans in force, with their span and batch."""
        return self._open().filter(F.col(SPAN).isin(self.grains().names()))

    def rows(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Rows from `start` on and before `end` (ISO times), scanning the spans that may have any.
        A row outside all spans is found too."""
        lo = dt.date.fromisoformat(start[:10]) if start else dt.date.min
        hi = dt.date.fromisoformat(end[:10]) if end else dt.date.max
        grains = self.grains()
        names = [name for name, a, b in grains.spans() if a <= hi and lo < b] + [grains.outside]
        out = self._open().filter(F.col(SPAN).isin(names))
        if start:
            out = out.filter(F.col(self.ts) >= F.lit(start).cast("timestamp_ntz"))
        if end:
            out = out.filter(F.col(self.ts) < F.lit(end).cast("timestamp_ntz"))
        return out.drop(SPAN, BATCH)

    def _emptied(self, folders: list[tuple[str, str]]) -> None:
        """Removes the rows of folders (span, batch)."""
        if not folders:
            return
        none = f"no_rows_{uuid.uuid4().hex[:12]}"
        self.spark.createDataFrame([], self._open().drop(SPAN, BATCH).schema).createOrReplaceTempView(none)
        for span, batch in folders:
            self.spark.sql(f"insert overwrite table {self.table} partition ({SPAN} = '{span}', {BATCH} = '{batch}') select * from {none}")
        self.spark.catalog.dropTempView(none)

    def upsert(self, rows: DataFrame, batch: str) -> None:
        """Adds a batch. Rows of earlier batches whose span and key it brings again are replaced;
        of rows that repeat a key within the batch one stays.

        Only key columns of the spans the batch touches are read to find such rows; the batches
        that hold some are written anew without them, in the same job as the batch itself.
        The same batch again, after a failure at any point, leaves the same rows.
        """
        own = replace(self, spark=rows.sparkSession)  # a stream's batch has a session of its own
        new = rows.dropDuplicates([self.key]).withColumn(SPAN, own.grains().name_of(self.ts)).withColumn(BATCH, F.lit(batch))
        touched = [r[0] for r in new.select(SPAN).distinct().collect()]  # spans, not rows
        if not touched:
            return
        earlier = own._open().filter(F.col(SPAN).isin(touched) & (F.col(BATCH) != batch))
        keys = new.select(SPAN, self.key)
        # one row per folder
        hit = {(r[SPAN], r[BATCH]): r.n for r in earlier.select(SPAN, BATCH, self.key).join(keys, [SPAN, self.key], "left_semi").groupBy(SPAN, BATCH).agg(F.count("*").alias("n")).collect()}
        if not hit:
            replace_partitions(new, self.table, SPAN, BATCH)
            return
        held = F.concat_ws("/", SPAN, BATCH).isin([f"{span}/{b}" for span, b in hit])
        sizes = {(r[SPAN], r[BATCH]): r.n for r in earlier.filter(held).groupBy(SPAN, BATCH).agg(F.count("*").alias("n")).collect()}
        kept = earlier.filter(held).join(keys, [SPAN, self.key], "left_anti")
        replace_partitions(kept.unionByName(new), self.table, SPAN, BATCH)
        # a folder that keeps no row is not among those written
        own._emptied([f for f, n in hit.items() if sizes[f] == n])

    def roll_over(self, grains: Grains) -> None:
        """Puts other grains in force: weeks become months, the open span weeks, or back.

        Spans that both grains have stay where they are. The rows of all others are in spans
        that only the new grains have: they are written there, the batches of a span together.
        """
        now, then = set(self.grains().names()), set(grains.names())
        if now != then:
            moving = self._open().filter(F.col(SPAN).isin(sorted(now - then)))
            replace_partitions(moving.withColumn(SPAN, grains.name_of(self.ts)).withColumn(BATCH, F.lit(MERGED)), self.table, SPAN)
            self._set(grains)
        self.drop_waste()

    def drop_waste(self) -> None:
        """Empties the folders of spans that are not in force."""
        names = self.grains().names()
        folders = self._open().filter(~F.col(SPAN).isin(names)).select(SPAN, BATCH).distinct().collect()
        self._emptied([(r[SPAN], r[BATCH]) for r in folders])
