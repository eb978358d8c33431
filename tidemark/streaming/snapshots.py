"""Spans of queries from snapshots of activity, as a stream.

A monitor lists what runs, again and again. A query has ended by the first snapshot of its
monitor that lacks it. Each monitor has a state of its own: the queries that ran in its last
snapshot, with when they were seen first and how often, and the snapshots that wait for the
watermark, as rows may come late and in any order. When the watermark has passed a
snapshot it is compared with the state. A monitor's state is as large as what runs at
one moment, and the rows of the lateness allowed, or of one batch if that is more: two
numbers a row, and each query's text once. Snapshots are compared some at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.streaming.windows import LATENESS

KEYS = ("sess_id", "query_no", "user_name")
#: Queries by place in `keys`, a JSON object a line; of those that run, their places, first and
#: last snapshots and numbers of snapshots; of rows that wait, times and places. Numbers are packed.
_STATE = "keys binary, running binary, times binary, places binary"
#: Rows that are put in order at once at least, and rows compared, or spans returned, at once.
MERGE_ROWS, STEP_ROWS = 1 << 18, 50_000

#: Times and places of rows.
Rows = tuple[np.ndarray, np.ndarray]


def _micros(times: pd.Series) -> np.ndarray:
    return times.astype("datetime64[us]").astype("int64").to_numpy()


def _packed(numbers: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(numbers, np.int64).data, 1)


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), np.int64)


def _distinct(parts: list[Rows]) -> Rows:
    """The rows of all parts, each once, by time and place. The list is emptied: it and what
    is made here are held one column at a time."""
    places = np.concatenate([p for _, p in parts])
    times = np.concatenate([t for t, _ in parts])
    parts.clear()
    order = np.lexsort((places, times))
    times = times[order]
    places = places[order]
    del order
    new = np.ones(len(times), bool)
    new[1:] = times[1:] != times[:-1]
    new[1:] |= places[1:] != places[:-1]
    return (times, places) if new.all() else (times[new], places[new])


def _steps(times: np.ndarray, places: np.ndarray, most: int = STEP_ROWS) -> Iterator[Rows]:
    """Rows by time in parts that hold whole snapshots: about `most` rows, or one snapshot."""
    at = 0
    while at < len(times):
        to = np.searchsorted(times, times[min(at + most, len(times)) - 1], "right")
        yield times[at:to], places[at:to]
        at = to


def _ended(running: np.ndarray, due: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Spans (place, first, end, snapshots) that end in the snapshots of `due`, rows by time
    and place, and what then runs: (place, first, last, snapshots)."""
    times = np.unique(due[0])
    # A query that runs was in the snapshot before these: snapshot 0; they are 1, 2, ...
    held = running.shape[1]
    place = np.concatenate([running[0], due[1]])
    number = np.concatenate([np.zeros(held, np.int64), np.searchsorted(times, due[0]) + 1])
    order = np.lexsort((number, place))
    place, number = place[order], number[order]
    begins = np.ones(len(place), bool)
    begins[1:] = (place[1:] != place[:-1]) | (number[1:] != number[:-1] + 1)
    start = np.flatnonzero(begins)
    stop = np.append(start[1:], len(place)) - 1
    seen = stop - start + 1
    first = times[np.maximum(number[start] - 1, 0)]
    old = np.flatnonzero(number[start] == 0)  # runs that go on from the snapshot before
    was = order[start[old]]
    first[old] = running[1][was]
    seen[old] += running[3][was] - 1
    still = number[stop] == len(times)
    end = times[np.minimum(number[stop], len(times) - 1)]
    spans = np.stack([place[start], first, end, seen])[:, ~still]
    return spans[:, np.lexsort((spans[0], spans[2]))], np.stack([place[start], first, np.full(len(start), times[-1]), seen])[:, still]


def spans_of_snapshots(rows: DataFrame, at: str, monitor: str, keys: tuple[str, ...] = KEYS, lateness: str = LATENESS) -> DataFrame:
    """(monitor, keys..., query_start_time, query_end_time, snapshots) of each query that has
    ended, from a stream of (monitor, at, keys...): one row for each query of each snapshot.

    The start is the snapshot a query is first in, the end the first that lacks it; one that
    comes again later has another span. Those in the newest snapshot still run. Repeated
    rows count once. A snapshot without any query is known by a row whose keys are all
    null. Rows later than the lateness are dropped.
    """
    out = f"{monitor} {rows.schema[monitor].dataType.simpleString()}, key string, query_start_time timestamp, query_end_time timestamp, snapshots long"

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        keys, running, waiting = [], np.empty((4, 0), np.int64), [(np.empty(0, np.int64), np.empty(0, np.int64))]
        if state.exists:
            names, held, when, where = state.get
            keys, running, waiting = bytes(names).decode().split("\n") if names else [], _numbers(held).reshape(4, -1), [(_numbers(when), _numbers(where))]
            del when, where
        places = {key: i for i, key in enumerate(keys)}
        fresh = 0
        for batch in batches:
            found = [places.setdefault(key, len(places)) for key in batch["key"]]
            waiting.append((_micros(batch[at]), np.array(found, np.int64)))
            if (fresh := fresh + len(found)) >= max(MERGE_ROWS, len(waiting[0][0]) // 2):
                waiting, fresh = [_distinct(waiting)], 0
        now = state.getCurrentWatermarkMs()
        rows = _distinct(waiting)
        cut = np.searchsorted(rows[0], now * 1000, "right")
        later = [column[cut:] for column in rows]
        keys = np.array([*places], object)
        for some in _steps(*[column[:cut] for column in rows]):
            done, running = _ended(running, some)
            for i in range(0, done.shape[1], STEP_ROWS):
                place, first, end, seen = done[:, i:i + STEP_ROWS]
                yield pd.DataFrame({monitor: [group[0]] * len(place), "key": keys[place], "query_start_time": pd.to_datetime(first, unit="us"), "query_end_time": pd.to_datetime(end, unit="us"), "snapshots": seen})
        needed = np.unique(np.concatenate([running[0], later[1]]))
        running = np.concatenate([np.searchsorted(needed, running[:1]), running[1:]])
        state.update(("\n".join(keys[needed]).encode(), _packed(running), _packed(later[0]), _packed(np.searchsorted(needed, later[1]))))
        if len(later[0]):
            # the watermark passes the next snapshot that waits
            state.setTimeoutTimestamp(max(int(later[0][0]) // 1000, now) + 1)

    # A query is known by the JSON of its keys, without those that are null.
    keyed = rows.select(monitor, at, F.to_json(F.struct(*keys)).alias("key"))
    ended = keyed.withWatermark(at, lateness).groupBy(monitor).applyInPandasWithState(step, out, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    kind = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    return ended.filter(F.col("key") != "{}").select(monitor, F.from_json("key", kind).alias("k"), "query_start_time", "query_end_time", "snapshots").select(
        monitor, *[F.col(f"k.{k}").alias(k) for k in keys], "query_start_time", "query_end_time", "snapshots")
