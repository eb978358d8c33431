"""Telemetry of benchmark runs: process samples, query spans, gauges and logs."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions.columns import exact_mean, ordered
from tidemark.operators.interval_join import interval_join

Tables = Mapping[str, DataFrame]

STAT = "decimal(8,2)"
GAUGES = ("rss", "pmem", "pcpu")
SPAN_BIN = 3600  # seconds; about the length of a long query
#: A connection is known within its run.
SESSION = ["run_id", "con_id"]
RAN = "status <> 'SKIP'"
WORKERS = tuple(f"w{i}" for i in range(1, 9))


def parse_process_lines(lines: DataFrame) -> DataFrame:
    """Fields of process list lines in three layouts: idle, with and without a slice.

    Lines of other processes, or with a memory size that is no number, are dropped.
    """
    # As a generated column, which conditions are not pushed below: a line is split once.
    words = F.explode(F.array(F.split(F.trim("line"), r"\s+"))).alias("w")
    at = lambda i: F.try_element_at("w", F.lit(i + 1))
    rows = lines.select("*", words).filter((F.size("w") >= 15) & at(12).startswith("con") & at(13).startswith("seg"))
    idle, sliced = at(14) == "idle", F.coalesce(at(15).contains("slice"), F.lit(False))
    rows = rows.select(
        *[c for c in lines.columns if c != "line"], at(0).cast("string").alias("pid"), F.expr("substring(try_element_at(w, 13), 4)").alias("con_id"), at(13).alias("seg_id"),
        F.when(~idle, at(14)).alias("cmd"), F.when(~idle & sliced, at(15)).alias("slice"),
        F.when(idle, at(14)).when(sliced, at(17)).otherwise(at(16)).alias("status"),
        F.floor(at(3).try_cast("bigint") / 1024).alias("rss"), at(4).alias("pmem"), at(1).alias("pcpu"))
    return rows.filter("rss is not null and status is not null")


def _sums() -> list[Column]:
    return [F.sum(g).alias(g) for g in GAUGES]


def per_segment(samples: DataFrame) -> DataFrame:
    """All processes of a connection's segment in one slot of a run. Slots and
    connections are numbered anew in every run."""
    return samples.groupBy("run_id", "hostname", "timeslot", "con_id", "seg_id").agg(F.min("real_time").alias("begintime"), *_sums())


def per_connection(segments: DataFrame) -> DataFrame:
    return segments.groupBy("run_id", "hostname", "timeslot", "begintime", "con_id").agg(*_sums())


def per_host(segments: DataFrame) -> DataFrame:
    return segments.groupBy("run_id", "hostname", "timeslot", "begintime").agg(*_sums())


def peaks(hosts: DataFrame, slots: int = 300) -> DataFrame:
    """Highest memory and CPU of a host in each run of slots."""
    out = hosts.groupBy("hostname", F.floor(F.col("timeslot") / slots).alias("tm")).agg(F.max("rss").alias("max_rss"), F.max("pcpu").alias("max_pcpu"))
    return ordered(out, "hostname", "tm")


def master_per_connection(samples: DataFrame) -> DataFrame:
    return samples.groupBy("run_id", "hostname", "timeslot", "con_id").agg(F.min("real_time").alias("begintime"), *_sums())


def query_usage(spans: DataFrame, segments: DataFrame, masters: DataFrame) -> DataFrame:
    """Worker usage of each query beside the coordinator's own.

    Both sides are summed per query before they meet, so that a query's samples
    are not paired with each other.
    """
    keys = ["run_id", "con_id", "action_target", "start_time", "end_time"]
    spans = spans.filter(RAN)

    def side(samples: DataFrame, p: str) -> DataFrame:
        hits = interval_join(samples, spans.select(*keys), SESSION, "begintime", "start_time", "end_time", SPAN_BIN, closed=True)
        return hits.groupBy(*keys).agg(F.count("*").alias(f"{p}_samples"), *[F.max(g).alias(f"{p}_{g}") for g in GAUGES])

    return side(segments, "worker").join(side(masters, "master"), keys)


def result_windows(spans: DataFrame) -> DataFrame:
    """Time span per run, workload and query; loading is one query, and so are all
    queries of a concurrent workload. Skipped actions have no span."""
    name = F.expr("case when wl_name like '%_CONCURRENT%' then 'CONCURRENT' when action_type = 'Loading' then action_type else action_target end")
    return spans.filter(RAN).groupBy("run_id", "wl_name", name.alias("query_name")).agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"))


def per_node(segments: DataFrame, masters: DataFrame) -> DataFrame:
    """Host totals with the role and the number of samples summed."""
    def side(rows: DataFrame, role: str) -> DataFrame:
        return rows.groupBy("run_id", "hostname", "timeslot", "begintime").agg(*_sums(), F.count("*").alias("segnum")).withColumn("role", F.lit(role))

    return side(segments, "QE").unionByName(side(masters, "QD"))


def _spread(g: str) -> list[Column]:
    low, high = F.min(g), F.max(g)
    return [high.cast(STAT).alias(f"{g}_max"), F.avg(g).cast(STAT).alias(f"{g}_avg"), low.cast(STAT).alias(f"{g}_min"),
            F.when(low == 0, F.lit(0).cast(STAT)).otherwise((high / low).cast(STAT)).alias(f"{g}_ratio")]


QUERY = ["run_id", "wl_name", "query_name", "stream", "con_id", "start_time", "end_time"]


def _queries(spans: DataFrame) -> DataFrame:
    name = F.expr("case when action_type = 'Loading' then action_type || '_' || action_target else action_target end")
    return spans.filter(RAN).withColumn("query_name", name).select(*QUERY).distinct()


def segment_statistics(spans: DataFrame, segments: DataFrame) -> DataFrame:
    """Peak per segment, then spread and skew over the segments, for each query.

    A query's span excludes its end. Queries without samples have zero segments.
    """
    queries = _queries(spans)
    hits = interval_join(segments, queries, SESSION, "begintime", "start_time", "end_time", SPAN_BIN)
    tops = hits.groupBy(*QUERY, F.concat_ws("-", "hostname", "seg_id").alias("seg")).agg(*[F.max(g).alias(g) for g in GAUGES])
    stats = tops.groupBy(*QUERY).agg(F.count("*").alias("segnum"), *[c for g in ("pmem", "pcpu", "rss") for c in _spread(g)])
    out = queries.join(stats, QUERY, "left")
    return out.withColumn("segnum", F.coalesce("segnum", F.lit(0).cast("bigint"))).drop("con_id")


def master_statistics(spans: DataFrame, masters: DataFrame) -> DataFrame:
    """The coordinator's peak for each query."""
    queries = _queries(spans)
    hits = interval_join(masters, queries, SESSION, "begintime", "start_time", "end_time", SPAN_BIN)
    tops = hits.groupBy(*QUERY).agg(*[F.max(g).cast(STAT).alias(f"{g}_max") for g in ("pmem", "pcpu", "rss")])
    return queries.join(tops, QUERY, "left").drop("con_id")


def host_pivot(windows: DataFrame, nodes: DataFrame, master: str, workers: Sequence[str], marker: int = 32000) -> DataFrame:
    """Memory, CPU and segments per slot with one column per host.

    Samples meet the windows of their own run in bins of SPAN_BIN seconds. The three
    measures stand side by side in one grouping and are stacked after it; max, avg and min
    are over the workers, and the first slot of a query carries a marker.
    """
    hits = interval_join(nodes, windows, ["run_id"], "begintime", "start_time", "end_time", SPAN_BIN, closed=True)
    keys = ["run_id", "wl_name", "query_name", "timeslot"]
    kinds = {"memory": "rss", "cpu": "pcpu", "segnum": "segnum"}
    value = lambda c: F.col(c).cast("decimal(18,2)")
    worker = F.col("hostname") != master

    def measures(kind: str, c: str) -> Column:
        hosts = [F.max(F.when(F.col("hostname") == h, value(c)).otherwise(F.lit(0))).alias(h) for h in (master, *workers)]
        mean = (F.sum(F.when(worker, value(c)).otherwise(F.lit(0))) / len(workers)).cast("decimal(18,2)")
        return F.struct(F.lit(kind).alias("kind"), *hosts, F.max(F.when(worker, value(c)).otherwise(F.lit(0))).alias("max_workers"), mean.alias("avg_workers"),
                        F.min(F.when(worker, value(c)).otherwise(F.lit(9999999))).alias("min_workers"))

    rows = hits.groupBy(*keys).agg(F.min("begintime").alias("begintime"), F.array(*[measures(k, c) for k, c in kinds.items()]).alias("m"))
    first = rows.groupBy(*keys[:-1]).agg(F.min("timeslot").alias("_first"))
    marked = rows.join(first, keys[:-1]).withColumn("timebound", F.when(F.col("timeslot") == F.col("_first"), marker).otherwise(0)).drop("_first")
    return marked.select(*keys, "begintime", "timebound", F.explode("m").alias("m")).select(*keys, "begintime", "timebound", "m.*")


def monitor_report(t: Tables, first: int, last: int) -> dict[str, DataFrame]:
    """All reports of a range of runs."""
    part = {n: t[n].filter(F.col("run_id").between(first, last)) for n in ("worker_samples", "master_samples", "run_spans")}
    segments, coordinator = per_segment(part["worker_samples"]), master_per_connection(part["master_samples"])
    windows, nodes = result_windows(part["run_spans"]), per_node(segments, coordinator)
    return {
        "windows": windows, "nodes": nodes, "hosts": host_pivot(windows, nodes, "mst1", WORKERS),
        "segments": segment_statistics(part["run_spans"], segments), "master": master_statistics(part["run_spans"], coordinator),
    }


def spans_from_activity(activity: DataFrame, keys: Sequence[str] = ("sess_id", "query_no", "user_name")) -> DataFrame:
    """Spans of queries seen in activity snapshots. A query has ended by the first
    snapshot that lacks it after it was seen last; those in the newest still run."""
    # One row per snapshot.
    moments = activity.select("snapshot").distinct()
    following = moments.select(F.col("snapshot").alias("last_seen"), F.lead("snapshot").over(W.orderBy("snapshot")).alias("query_end_time"))
    seen = activity.groupBy(*keys).agg(F.min("snapshot").alias("query_start_time"), F.max("snapshot").alias("last_seen"), F.count("*").alias("snapshots"))
    return seen.join(following, "last_seen").filter("query_end_time is not null").select(*keys, "query_start_time", "query_end_time", "snapshots")


# --- Gauges ------------------------------------------------------------------------


def cpu_usage(gauges: DataFrame) -> DataFrame:
    return gauges.groupBy("host").agg(exact_mean("100 - cpu_idle", 2).alias("cpu_used"))


def memory_usage(gauges: DataFrame) -> DataFrame:
    return gauges.groupBy("host").agg(exact_mean("100 * (mem_total - mem_cached - mem_free) / mem_total", 8).alias("memory_used"))


MIB = 1024 * 1024
# Ceilings in MiB per second.
CEILINGS = {"bytes_written": 250, "bytes_read": 200, "bytes_out": 100, "bytes_in": 100}


def io_usage(gauges: DataFrame, least: float = 0.0) -> DataFrame:
    """Percent of the disk and network ceilings used, and whether all reach a floor."""
    out = gauges.groupBy("host").agg(*[exact_mean(f"100 * {c} / {MIB} / {top}", 8).alias(f"{c}_pct") for c, top in CEILINGS.items()])
    enough = F.lit(True)
    for c in CEILINGS:
        enough = enough & (F.col(f"{c}_pct") >= least)
    return out.withColumn("passed", enough)


def leak_angle(gauges: DataFrame, alarm: int = 15) -> DataFrame:
    """Slope of the hosts' mean memory over samples, as whole degrees.

    Used memory is averaged over hosts per sample, fitted by least squares
    against the sample's number, and alarmed above 15 degrees. Fewer than two
    samples give -90, a vertical line 90.
    """
    used = "cast((mem_total - mem_cached - mem_free) / 1024 / 1024 as decimal(18,6))"
    per = gauges.groupBy("slot").agg(F.try_divide(F.sum(F.expr(used)).cast("double"), F.count("*")).alias("y"))
    low = per.agg(F.min("slot")).scalar()
    fit = per.select((F.col("slot") - low).cast("double").alias("x"), "y").agg(F.count("*").alias("samples"), F.var_pop("x").alias("spread"), F.regr_slope("y", "x").alias("slope"))
    angle = F.when(F.col("samples") < 2, -90).when(F.col("spread") < 1e-3, 90).otherwise(F.degrees(F.atan("slope")).cast("int"))
    return fit.select("samples", angle.alias("angle")).withColumn("alarm", (F.col("angle") < 0) | (F.col("angle") > alarm))


def disk_alarms(gauges: DataFrame, limit: int = 80) -> DataFrame:
    return gauges.groupBy("host", "disk_path").agg(F.max("disk_used").alias("disk_used")).filter(F.col("disk_used") > limit)


# --- Logs ---------------------------------------------------------------------------


def keyword_counts(logs: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Lines per host and keyword, in any letter case. One pass serves all keywords."""
    found = F.filter(F.array(*[F.when(F.lower("message").contains(k.lower()), F.lit(k)) for k in keywords]), lambda x: x.isNotNull())
    return logs.select("host", F.explode(found).alias("keyword")).groupBy("host", "keyword").agg(F.count("*").alias("lines"))


LEVELS = ("FATAL", "ERROR", "EXCEPTION", "FAIL", "WARN", "PANIC")


def recent_matches(logs: DataFrame, keywords: Sequence[str], until: Column, hours: int = 2) -> DataFrame:
    """Matching lines of the hours before a moment; case matters."""
    pattern = "|".join(re.escape(k) for k in keywords)
    recent = logs.filter((F.col("logged") > until - F.expr(f"interval {hours} hours")) & (F.col("logged") <= until))
    return recent.filter(F.col("message").rlike(pattern)).select("host", "logged", "message")


# --- Registered reports -------------------------------------------------------------------


def plain(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema.fields])


def _segments(t: Tables) -> DataFrame:
    return per_segment(t["worker_samples"])


def _masters(t: Tables) -> DataFrame:
    return master_per_connection(t["master_samples"])


def _last_log(t: Tables) -> Column:
    return t["log_lines"].agg(F.max("logged")).scalar()


QUERIES = {
    "telemetry_process_lines": lambda t: parse_process_lines(t["process_lines"]),
    "telemetry_per_segment": lambda t: plain(_segments(t)),
    "telemetry_per_connection": lambda t: plain(per_connection(_segments(t))),
    "telemetry_per_host": lambda t: plain(per_host(_segments(t))),
    "telemetry_peaks": lambda t: plain(peaks(per_host(_segments(t)))),
    "telemetry_query_usage": lambda t: plain(query_usage(t["run_spans"], _segments(t), _masters(t))),
    "telemetry_result_windows": lambda t: result_windows(t["run_spans"]),
    "telemetry_per_node": lambda t: plain(per_node(_segments(t), _masters(t))),
    "telemetry_segment_statistics": lambda t: plain(segment_statistics(t["run_spans"], _segments(t))),
    "telemetry_master_statistics": lambda t: plain(master_statistics(t["run_spans"], _masters(t))),
    "telemetry_host_pivot": lambda t: plain(host_pivot(result_windows(t["run_spans"]), per_node(_segments(t), _masters(t)), "mst1", WORKERS)),
    "telemetry_monitor_report": lambda t: plain(monitor_report(t, 1, 2)["segments"]),
    "telemetry_monitor_windows": lambda t: monitor_report(t, 1, 2)["windows"],
    "telemetry_monitor_nodes": lambda t: plain(monitor_report(t, 1, 2)["nodes"]),
    "telemetry_monitor_hosts": lambda t: plain(monitor_report(t, 1, 2)["hosts"]),
    "telemetry_monitor_master": lambda t: plain(monitor_report(t, 1, 2)["master"]),
    "telemetry_spans_from_activity": lambda t: spans_from_activity(t["activity"]),
    "telemetry_cpu": lambda t: cpu_usage(t["gauges"]),
    "telemetry_memory": lambda t: memory_usage(t["gauges"]),
    "telemetry_io": lambda t: io_usage(t["gauges"], 50.0),
    "telemetry_leak_angle": lambda t: leak_angle(t["gauges"]),
    "telemetry_disk_alarms": lambda t: disk_alarms(t["gauges"]),
    "telemetry_keywords": lambda t: keyword_counts(t["log_lines"], ("error", "fatal", "warning", "panic", "exception")),
    "telemetry_recent_matches": lambda t: recent_matches(t["log_lines"], LEVELS, _last_log(t), 48),
}
