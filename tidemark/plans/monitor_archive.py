"""The monitor report with its archive, in steps that a restart goes on from.

Samples and spans lie in tables partitioned by run. A report is known by its name: its
frames are written to a partition of that name each, then, if asked for, the reported runs
are moved to history, and last the report is published. Each step is noted in a property
of the spans' table when it is done. A restart under the same name repeats the step that
was not finished, which replaces what it left, and readers see published reports only.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.plans.telemetry import Tables, monitor_report
from tidemark.sources.layout import Layout, move_to_history, replace_partitions, write_table
from tidemark.sources.shared import new_folder

RAW, RUN, REPORT = ("run_spans", "master_samples", "worker_samples"), "run_id", "report"
FRAMES = ("windows", "nodes", "hosts", "segments", "master")
PUBLISHED = "published"


@dataclass(frozen=True)
class MonitorStore:
    """Tables whose names begin with `prefix`."""

    spark: SparkSession
    prefix: str

    @staticmethod
    def create(t: Tables, prefix: str) -> MonitorStore:
        for name in RAW:
            write_table(t[name], f"{prefix}_{name}", Layout(partition_by=(RUN,)))
        return MonitorStore(t[RAW[0]].sparkSession, prefix)

    def raw(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.prefix}_{name}")

    def history(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.prefix}_{name}_history")

    def _key(self, report: str) -> str:
        return f"report.{report}"

    def done(self, report: str) -> list[str]:
        found = {r.key: r.value for r in self.spark.sql(f"show tblproperties {self.prefix}_{RAW[0]}").collect()}
        return json.loads(found.get(self._key(report), "[]"))

    def _note(self, report: str, steps: list[str]) -> None:
        self.spark.sql(f"alter table {self.prefix}_{RAW[0]} set tblproperties ('{self._key(report)}' = '{json.dumps(steps)}')")

    def _write(self, name: str, rows: DataFrame, report: str) -> None:
        table = f"{self.prefix}_{name}"
        named = rows.withColumn(REPORT, F.lit(report))
        if self.spark.catalog.tableExists(table):
            replace_partitions(named, table, REPORT)
        else:
            write_table(named, table, Layout(partition_by=(REPORT,)))

    def report(self, first: int, last: int, name: str, clear: bool = False) -> None:
        """The frames of the runs `first` to `last`; with `clear` their rows go to history.
        All frames are there before any row is moved. A report that is published stays as it is.
        `name` has letters, digits and underscores."""
        if not name.replace("_", "").isalnum():
            raise ValueError(f"no name for a report: {name}")
        steps: dict[str, Callable[[], None]] = {}
        frames = monitor_report({n: self.raw(n) for n in RAW}, first, last)
        for frame in FRAMES:
            steps[frame] = lambda frame=frame: self._write(frame, frames[frame], name)
        for table in RAW if clear else ():
            steps[f"move {table}"] = lambda table=table: move_to_history(self.spark, f"{self.prefix}_{table}", f"{self.prefix}_{table}_history", RUN, first, last, name)
        steps[PUBLISHED] = lambda: None
        done = self.done(name)
        if PUBLISHED in done:
            return
        for step, run in steps.items():
            if step not in done:
                run()
                done.append(step)
                self._note(name, done)

    def frame(self, frame: str) -> DataFrame:
        """A frame's rows of all published reports."""
        rows = self.spark.table(f"{self.prefix}_{frame}")
        names = [r[0] for r in rows.select(REPORT).distinct().collect()]  # partitions, not rows
        return rows.filter(F.col(REPORT).isin([n for n in names if PUBLISHED in self.done(n)]))


def archived(t: Tables) -> DataFrame:
    """Rows left, in history and in each frame after run 1 was reported and moved to history,
    and the same report asked for again."""
    spark = t[RAW[0]].sparkSession
    store = MonitorStore.create(t, new_folder(spark, "monitor").rsplit("/", 1)[1].replace("-", "_"))
    for _ in range(2):
        store.report(1, 1, "first", clear=True)
    counted = lambda kind, name, rows: rows.groupBy(F.lit(kind).alias("kind"), F.lit(name).alias("name")).agg(F.count("*").alias("n"))
    parts = [*[counted("left", n, store.raw(n)) for n in RAW], *[counted("moved", n, store.history(n)) for n in RAW], *[counted("frame", n, store.frame(n)) for n in FRAMES]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def archived_segments(t: Tables) -> DataFrame:
    """The published statistics of run 1, whose samples are in history."""
    spark = t[RAW[0]].sparkSession
    store = MonitorStore.create(t, new_folder(spark, "monitor").rsplit("/", 1)[1].replace("-", "_"))
    store.report(1, 1, "first", clear=True)
    rows = store.frame("segments").drop(REPORT)
    return rows.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in rows.schema.fields])


QUERIES = {"telemetry_archive": archived, "telemetry_archive_segments": archived_segments}
