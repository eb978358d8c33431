"""Comparison of benchmark runs with a baseline: regression classes and reports.

Every function takes frames and returns a frame. Durations are milliseconds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

Tables = Mapping[str, DataFrame]

MONEY = "decimal(18,2)"
KEYS = ["s_id", "adj_s_id"]

# The report's classes.
NEW, PASS, BETTER = "PASS AS NEW TEST CASE", "PASS", "PASS WITH PERFORMANCE IMPROVEMENT"
WORSE, BROKEN = "FAILURE WITH PERFORMANCE DOWNGRADE", "ERROR WITH TEST REPORT GENERATION"
# Tolerated ratio of actual to baseline, from 100 ms on and below.
LONG, LONG_BAND, SHORT_BAND = 100, (0.9, 1.1), (0.3, 3.0)


def _state(errors: bool) -> Column:
    out = F.when(F.max(F.expr("status = 'SKIP'")), "SKIP").otherwise("PASS")
    return F.when(F.max(F.expr("status = 'ERROR'")), "ERROR").otherwise(out) if errors else out


def _mean_duration(errors: bool) -> Column:
    """Average, or zero where an action failed or was left out."""
    mean = F.avg(F.col("duration").cast(MONEY)).cast(MONEY)
    return F.when(F.max(F.expr("status in ('ERROR', 'SKIP')")), F.lit(0).cast(MONEY)).otherwise(mean) if errors else mean


def _scenarios(t: Tables, concurrent: bool) -> DataFrame:
    work = t["workload"].filter("wl_concurrency > 1" if concurrent else "wl_concurrency = 1")
    return t["scenario"].join(work, "wl_id", "left_semi").select("s_id")


def single_stream(rows: DataFrame, t: Tables, group: Sequence[str], errors: bool) -> DataFrame:
    """State and mean duration per action of the single-stream scenarios."""
    mine = rows.join(_scenarios(t, False), "s_id", "left_semi")
    return mine.groupBy(*group, *KEYS, "action_type", "action_target").agg(_state(errors).alias("status"), _mean_duration(errors).alias("duration"))


def concurrent(rows: DataFrame, t: Tables, group: Sequence[str], errors: bool) -> DataFrame:
    """Concurrent scenarios as one action each: the mean per stream and query,
    summed per stream, averaged over the streams."""
    mine = rows.filter("action_type = 'Execution'").join(_scenarios(t, True), "s_id", "left_semi")
    keys = [*group, *KEYS]
    queries = mine.groupBy(*keys, "stream", "action_target").agg(_state(errors).alias("status"), _mean_duration(errors).alias("duration"))
    streams = queries.groupBy(*keys, "stream").agg(_state(errors).alias("status"), F.sum("duration").alias("duration"))
    out = streams.groupBy(*keys).agg(_state(errors).alias("status"), F.avg("duration").cast(MONEY).alias("duration"))
    return out.select(*keys, F.lit("Execution").alias("action_type"), F.lit("CONCURRENT_QUERY").alias("action_target"), "status", "duration")


def results(t: Tables, first: int, last: int | None = None) -> DataFrame:
    """Precomputed results of a run or a range of runs."""
    rows = t["test_result"].filter(F.col("tr_id").between(first, first if last is None else last))
    return single_stream(rows, t, ["tr_id"], True).unionByName(concurrent(rows, t, ["tr_id"], True)).distinct()


def baseline(t: Tables, storage: str, engine: str) -> DataFrame:
    """Precomputed baseline of a pair of versions."""
    rows = t["test_baseline"].filter((F.col("storage_version") == storage) & (F.col("engine_version") == engine))
    return single_stream(rows, t, [], False).unionByName(concurrent(rows, t, [], False)).distinct()


def with_settings(rows: DataFrame, t: Tables) -> DataFrame:
    """The workload's settings; a concurrent workload's name says so."""
    work = t["workload"].withColumn("wl_name", F.expr("case when wl_concurrency > 1 then wl_name || '_CONCURRENT' else wl_name end"))
    return rows.join(t["scenario"].join(work, "wl_id"), "s_id")


def classify(actual: str, base: str, actual_status: str, base_status: str) -> Column:
    """Class of an action from its ratio to the baseline; arms are tried in order."""
    a, b = F.col(actual).cast("double"), F.col(base).cast("double")
    r = F.try_divide(a, b)

    def arm(long: Column, short: Column, edge: bool) -> Column:
        return ((b >= LONG) & long) | (((b <= LONG) if edge else (b < LONG)) & short)

    stopped = F.col(actual_status).isin("SKIP", "ERROR") | (b <= 0) | F.col(base_status).isin("SKIP", "ERROR")
    return (
        F.when(F.col(base_status).isNull(), NEW).when(stopped, F.col(actual_status))
        .when(arm(r.between(*LONG_BAND), r.between(*SHORT_BAND), False), PASS)
        .when(arm(r < LONG_BAND[0], r < SHORT_BAND[0], True), BETTER)
        .when(arm(r > LONG_BAND[1], r > SHORT_BAND[1], True), WORSE)
        .otherwise(BROKEN)
    )


FLAGS = {
    "success_status": f"test_result in ('{PASS}', '{NEW}')", "improve_status": f"test_result = '{BETTER}'",
    "failure_status": "test_result like 'FAILURE%'", "skip_status": "test_result = 'SKIP'", "error_status": "test_result like 'ERROR%'",
}


def detail(actual: DataFrame, base: DataFrame) -> DataFrame:
    """Each action against the baseline, and randomly distributed scenarios once
    more against their key-distributed twin (name ending in _RWITHD)."""
    b = base.select(F.col("s_id").alias("b_s_id"), F.col("action_type").alias("b_type"), F.col("action_target").alias("b_target"),
                    F.col("duration").alias("b_duration"), F.col("status").alias("b_status"))

    def against(rows: DataFrame, key: str, name: Column) -> DataFrame:
        on = (F.col(key) == F.col("b_s_id")) & (F.col("action_type") == F.col("b_type")) & (F.col("action_target") == F.col("b_target"))
        pairs = rows.join(b, on, "left")
        unknown = F.expr("b_status is null or b_duration = 0 or status in ('SKIP', 'ERROR') or duration is null")
        return pairs.select(
            "tr_id", "s_id", name.alias("wl_name"), "action_type", "action_target", F.col("duration").alias("actual_execution_time"),
            F.col("b_duration").alias("baseline_execution_time"), classify("duration", "b_duration", "status", "b_status").alias("test_result"),
            F.when(~F.coalesce(unknown, F.lit(False)), F.try_divide(F.col("duration"), F.col("b_duration")).cast(MONEY)).alias("deviation"))

    own = against(actual, "s_id", F.col("wl_name"))
    twin = against(actual.filter("wl_disrandomly"), "adj_s_id", F.concat("wl_name", F.lit("_RWITHD")))
    rows = own.unionByName(twin).distinct()
    revised = F.expr("case when test_result like 'SKIP%' or test_result like 'ERROR%' or baseline_execution_time is null then 0 else baseline_execution_time end").cast(MONEY)
    return rows.withColumn("revised_baseline_execution_time", revised).withColumns({n: F.expr(f"cast({c} as int)") for n, c in FLAGS.items()})


def summary(report: DataFrame, without: str | None = None) -> DataFrame:
    """One row per run, workload and action type: counts, totals, overall result.

    Stream actions are left out, and one outlier action may be (`without`).
    """
    rows = report.filter("action_target not like '%_STREAM'")
    if without:
        rows = rows.filter(F.col("action_target") != without)
    out = rows.groupBy("tr_id", "s_id", "wl_name", "action_type").agg(
        *[F.sum(f"{n}_status").cast("int").alias(m) for n, m in
          (("improve", "improvenum"), ("success", "passnum"), ("failure", "failurenum"), ("skip", "skipnum"), ("error", "errornum"))],
        F.sum("actual_execution_time").cast(MONEY).alias("actual_total_execution_time"),
        F.sum("revised_baseline_execution_time").cast(MONEY).alias("baseline_total_execution_time"))
    a, b = F.col("actual_total_execution_time"), F.col("baseline_total_execution_time")
    r = F.try_divide(a.cast("double"), b.cast("double"))
    overall = (
        F.when(F.col("errornum") > 0, "ERROR").when((a < 0.001) | (b < 0.001), "SKIP").when(r.between(*LONG_BAND), PASS)
        .when(r < LONG_BAND[0], BETTER).when(r > LONG_BAND[1], WORSE).otherwise("ERROR"))
    parts = (F.when(F.col("errornum") > 0, "ERROR").when(F.col("failurenum") > 0, "FAILURE")
             .when(F.expr("passnum + improvenum + failurenum + errornum = 0"), "SKIP").otherwise("PASS"))
    text = F.format_string("Overall:%s;     Detail(IMPROVEMENT: %d; PASS: %d; FAILURE: %d; SKIP: %d; ERROR: %d)",
                           "overall_test_result", "improvenum", "passnum", "failurenum", "skipnum", "errornum")
    both = F.expr("case when overall_test_result in ('SKIP', 'ERROR') then overall_test_result "
                  "when overall_test_result like 'PASS%' and detail_result like 'PASS%' then 'PASS' else 'FAILURE' end")
    return out.withColumn("deviation", F.when(b >= 0.001, F.try_divide(a, b).cast(MONEY))).withColumns(
        {"overall_test_result": overall, "detail_result": parts}).withColumns({"test_statistic": text, "test_result_all": both})


# --- Comparison modes ----------------------------------------------------------------


def run_vs_version(t: Tables, run: int, storage: str, engine: str) -> DataFrame:
    return detail(with_settings(results(t, run), t), baseline(t, storage, engine))


def runs_vs_version(t: Tables, first: int, last: int, storage: str, engine: str) -> DataFrame:
    return detail(with_settings(results(t, first, last), t), baseline(t, storage, engine))


def run_vs_run(t: Tables, run: int, other: int) -> DataFrame:
    return detail(with_settings(results(t, run), t), results(t, other))


def runs_vs_runs(t: Tables, first: int, last: int, other_first: int, other_last: int) -> DataFrame:
    return detail(with_settings(results(t, first, last), t), results(t, other_first, other_last))


def version_vs_version(t: Tables, one: tuple[str, str], two: tuple[str, str]) -> DataFrame:
    actual = with_settings(baseline(t, *one), t).withColumn("tr_id", F.lit(None).cast("int"))
    return detail(actual, baseline(t, *two))


def promote(t: Tables, runs: Sequence[int], storage: str, engine: str) -> DataFrame:
    """All results of some runs, whatever their status, as rows to append to the baseline."""
    kept = t["test_result"].filter(F.col("tr_id").isin(*runs))
    return kept.select(F.lit(storage).alias("storage_version"), F.lit(engine).alias("engine_version"), *[c for c in t["test_baseline"].columns if not c.endswith("_version")])


# --- Pivots ------------------------------------------------------------------------


def by_scenario(t: Tables, run: int, scenarios: Sequence[int] | None = None) -> DataFrame:
    """Durations of a run with one column per scenario, zero where it has none: of all
    scenarios of the dimension, unless some are named."""
    if scenarios is None:
        scenarios = [r.s_id for r in t["scenario"].select("s_id").distinct().orderBy("s_id").collect()]
    rows = results(t, run).groupBy("action_type", "action_target").pivot("s_id", list(scenarios)).agg(F.max("duration"))
    return rows.select("action_type", "action_target", *[F.coalesce(F.col(f"`{s}`"), F.lit(0).cast(MONEY)).alias(f"p{i}") for i, s in enumerate(scenarios, 1)])


def tuning(t: Tables, names: Sequence[str], column: str, within: Column | None = None) -> DataFrame:
    """Longest duration per action under each parameter name or value.

    A parameter covers the runs from its first to its last. `names` come most
    frequent first: only actions seen under the first of them are shown.
    """
    params = t["parameters"] if within is None else t["parameters"].filter(within)
    spans = params.groupBy(F.col(column).alias("param")).agg(F.min("run_id").alias("lo"), F.max("run_id").alias("hi"))
    # A span becomes one row per run, so that results meet it on the run's number.
    runs = spans.select("param", F.explode(F.sequence("lo", "hi")).alias("tr_id"))
    low, high = (params.agg(f("run_id")).first()[0] for f in (F.min, F.max))
    rows = results(t, low, high).join(runs, "tr_id")
    out = rows.groupBy("s_id", "action_type", "action_target").pivot("param", list(names)).agg(F.max("duration"))
    return out.filter(F.col(f"`{names[0]}`").isNotNull())


def report_lines(report: DataFrame) -> DataFrame:
    """Printed line per action, N.A. for what is unknown. Twins are left out."""
    def whole(c: str, other: str) -> Column:
        return F.coalesce(F.round(c, 0).cast("bigint").cast("string"), F.lit(other))

    line = F.concat(
        F.lit("Test Suite Name|"), "wl_name", F.lit("|Test Case Name|"), "action_type", F.lit("."), "action_target", F.lit("|Test Detail|Actual run time is: "),
        whole("actual_execution_time", "N.A."), F.lit(" ms, Baseline time is: "), whole("baseline_execution_time", "N.A."), F.lit(" ms, Comparison is: "),
        F.coalesce(F.col("deviation").cast("string"), F.lit("N.A.")), F.lit(" ("), whole("actual_execution_time", "0"), F.lit(" ms)|Test Status|"), "test_result")
    return report.filter("lower(wl_name) not like '%rwithd%'").select(line.alias("line"))


# --- Registered reports -----------------------------------------------------------------


def plain(df: DataFrame) -> DataFrame:
    """Decimals shown as double."""
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f"`{f.name}`") for f in df.schema.fields])


RUN, FIRST, LAST = 103, 101, 103
OLD, NEXT = ("S1", "E1"), ("S2", "E2")

QUERIES = {
    "runs_single_stream": lambda t: plain(single_stream(t["test_result"], t, ["tr_id"], True)),
    "runs_concurrent": lambda t: plain(concurrent(t["test_result"], t, ["tr_id"], True)),
    "runs_results": lambda t: plain(with_settings(results(t, FIRST, LAST), t)),
    "runs_baseline": lambda t: plain(with_settings(baseline(t, *OLD), t)),
    "runs_detail_run_vs_version": lambda t: plain(run_vs_version(t, RUN, *OLD)),
    "runs_detail_runs_vs_version": lambda t: plain(runs_vs_version(t, FIRST, LAST, *OLD)),
    "runs_detail_run_vs_run": lambda t: plain(run_vs_run(t, RUN, FIRST)),
    "runs_detail_runs_vs_runs": lambda t: plain(runs_vs_runs(t, 104, 106, FIRST, FIRST)),
    "runs_detail_version_vs_version": lambda t: plain(version_vs_version(t, NEXT, OLD)),
    "runs_summary": lambda t: plain(summary(runs_vs_version(t, FIRST, 106, *OLD))),
    "runs_summary_without_outlier": lambda t: plain(summary(runs_vs_version(t, FIRST, 106, *OLD), without="query_05")),
    "runs_promote": lambda t: plain(promote(t, (104, 105), "S3", "E3")),
    "runs_by_scenario": lambda t: plain(by_scenario(t, RUN)),
    "runs_tuning_by_name": lambda t: plain(tuning(t, ("SEG_NUM", "MEMORY"), "param_name")),
    "runs_tuning_by_value": lambda t: plain(tuning(t, ("SEG4", "SEG8"), "param_value", F.col("param_name") == "SEG_NUM")),
    "runs_report_lines": lambda t: report_lines(run_vs_version(t, RUN, *OLD)),
}
