"""The stored baseline, to which runs are promoted.

A promotion is known by its versions and runs, and its rows lie in a partition of their
own. The table's property CURRENT lists the promotions that count for each pair of
versions; setting it is one change of the catalogue, made after the rows are there. So
a promotion that is tried again, after a failure or by mistake, changes nothing, and a reader
sees all rows of a promotion or none.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.plans import runs
from tidemark.plans.runs import Tables
from tidemark.sources.layout import Layout, replace_partitions, write_table
from tidemark.sources.shared import new_folder

PROMOTION, CURRENT = "promotion", "promotions.current"
#: The promotion of rows that were in the baseline from the start.
FIRST = "first"


@dataclass(frozen=True)
class StoredBaseline:
    spark: SparkSession
    table: str

    @staticmethod
    def create(rows: DataFrame, table: str, path: str | None = None) -> StoredBaseline:
        """A baseline of rows that have storage_version and engine_version."""
        write_table(rows.withColumn(PROMOTION, F.lit(FIRST)), table, Layout(partition_by=(PROMOTION,)), path=path)
        out = StoredBaseline(rows.sparkSession, table)
        pairs = rows.select("storage_version", "engine_version").distinct().collect()  # one row per pair of versions
        out._set({out._pair(*p): [[FIRST]] for p in pairs})
        return out

    @staticmethod
    def _pair(storage: str, engine: str) -> str:
        return json.dumps([storage, engine])

    def _set(self, states: dict[str, list[list[str]]]) -> None:
        text = json.dumps(states).replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"alter table {self.table} set tblproperties ('{CURRENT}' = '{text}')")

    def _states(self) -> dict[str, list[list[str]]]:
        """Per pair of versions its states, oldest first: the promotions that count."""
        found = {r.key: r.value for r in self.spark.sql(f"show tblproperties {self.table}").collect()}
        return json.loads(found[CURRENT])

    def versions(self, storage: str, engine: str) -> int:
        """How often the baseline of these versions has changed, its beginning included."""
        return len(self._states().get(self._pair(storage, engine), []))

    def rows(self, version: int | None = None) -> DataFrame:
        """The baseline's rows. With `version`, of each pair as it was then, from 1 on, or now
        if it has not changed as often."""
        self.spark.catalog.refreshTable(self.table)
        table, wanted = self.spark.table(self.table), F.lit(False)
        for pair, states in self._states().items():
            storage, engine = json.loads(pair)
            state = states[-1] if version is None or version > len(states) else states[version - 1]
            own = F.col("storage_version").eqNullSafe(F.lit(storage)) & F.col("engine_version").eqNullSafe(F.lit(engine))
            wanted = wanted | (F.col(PROMOTION).isin(state) & own)
        return table.filter(wanted).drop(PROMOTION)

    def promote(self, t: Tables, of_runs: Sequence[int], storage: str, engine: str, replace: bool = False) -> bool:
        """Adds all results of some runs, or with `replace` puts them in place of what the versions
        have. False if the same runs count for the versions already."""
        key = hashlib.md5(json.dumps([storage, engine, sorted(set(of_runs))]).encode()).hexdigest()[:16]
        states, pair = self._states(), self._pair(storage, engine)
        now = states.get(pair, [[]])[-1]
        then = [key] if replace else [*now, key]
        if now == then or (key in now and not replace):
            return False
        promoted = runs.promote(t, sorted(set(of_runs)), storage, engine)
        replace_partitions(promoted.withColumn(PROMOTION, F.lit(key)), self.table, PROMOTION)
        self._set({**states, pair: [*states.get(pair, []), then]})
        return True

    def restore(self, storage: str, engine: str, version: int) -> None:
        """Makes an earlier state count again, as a further one."""
        states, pair = self._states(), self._pair(storage, engine)
        self._set({**states, pair: [*states[pair], states[pair][version - 1]]})


# --- Registered reports ----------------------------------------------------------------


def promoted_baseline(t: Tables) -> DataFrame:
    """The stored baseline after two promotions, one of them made twice."""
    spark = t["test_baseline"].sparkSession
    path = new_folder(spark, "baseline")
    stored = StoredBaseline.create(t["test_baseline"], path.rsplit("/", 1)[1].replace("-", "_"), path)
    for of_runs in ((104, 105), (105, 104), (106,)):
        stored.promote(t, of_runs, "S3", "E3")
    return stored.rows()


QUERIES = {
    "runs_stored_baseline": lambda t: runs.plain(promoted_baseline(t)),
    "runs_detail_vs_promoted": lambda t: runs.plain(runs.run_vs_version({**t, "test_baseline": promoted_baseline(t)}, runs.RUN, "S3", "E3")),
}
