"""Durations are kept as whole hundredths, rounded half up by integer division."""

from oracle.prelude import with_tables

ACTION = "s_id, adj_s_id, action_type, action_target"


def status(errors: bool) -> str:
    return "case " + ("when bool_or(status = 'ERROR') then 'ERROR' " if errors else "") + "when bool_or(status = 'SKIP') then 'SKIP' else 'PASS' end as status"


def mean(x: str, errors: bool, scale: int) -> str:
    """Mean in hundredths of x given in units of 1/scale hundredths."""
    avg = f"cast((sum({x}) * {200 if scale == 100 else 2} + count({x})) // (2 * count({x})) as bigint)"
    return f"case when bool_or(status in ('ERROR', 'SKIP')) then 0 else {avg} end" if errors else avg


def pre(src: str, group: str, errors: bool) -> str:
    g = f"{group}, " if group else ""
    work = "s_id in (from scenario semi join workload on workload.wl_id = scenario.wl_id and wl_concurrency {} select s_id)"
    return f"""((from {src} select {g}{ACTION}, {status(errors)}, {mean('duration', errors, 100)} as h where {work.format('= 1')} group by {g}{ACTION})
      union (from (from (from {src} select {g}s_id, adj_s_id, stream, action_target, {status(errors)}, {mean('duration', errors, 100)} as h
            where action_type = 'Execution' and {work.format('> 1')} group by {g}s_id, adj_s_id, stream, action_target)
          select {g}s_id, adj_s_id, stream, {status(errors)}, sum(h) as h group by {g}s_id, adj_s_id, stream)
        select {g}s_id, adj_s_id, 'Execution' as action_type, 'CONCURRENT_QUERY' as action_target, {status(errors)},
          cast((sum(h) * 2 + count(h)) // (2 * count(h)) as bigint) as h group by {g}s_id, adj_s_id))"""


def res(a: int, b: int) -> str:
    return pre(f"(from test_result where tr_id between {a} and {b})", "tr_id", True)


def base(s: str, e: str) -> str:
    return pre(f"(from test_baseline where storage_version = '{s}' and engine_version = '{e}')", "", False)


SET = "wl_category, wl_disrandomly, wl_orientation, wl_compression_type, wl_partitions, wl_concurrency"
NAME = "if(wl_concurrency > 1, wl_name || '_CONCURRENT', wl_name)"


def settings(rows: str, group: str) -> str:
    return f"""from {rows} r join scenario using (s_id) join workload using (wl_id)
      select {group}s_id, adj_s_id, action_type, action_target, status, cast(h * 0.01 as double) as duration, wl_id, {NAME} as wl_name, {SET}"""


CLASS = """case when bs is null then 'PASS AS NEW TEST CASE'
    when status in ('SKIP', 'ERROR') or bh <= 0 or bs in ('SKIP', 'ERROR') then status
    when bh >= 10000 then case when r between cast(0.9 as double) and cast(1.1 as double) then 'PASS' when r < cast(0.9 as double) then 'PASS WITH PERFORMANCE IMPROVEMENT' else 'FAILURE WITH PERFORMANCE DOWNGRADE' end
    else case when r between cast(0.3 as double) and 3 then 'PASS' when r < cast(0.3 as double) then 'PASS WITH PERFORMANCE IMPROVEMENT' else 'FAILURE WITH PERFORMANCE DOWNGRADE' end end"""


def detail(actual: str, b: str, run: str = "a.tr_id") -> str:
    def side(key: str, name: str, where: str) -> str:
        return f"""(from a left join b on b.s_id = a.{key} and b.action_type = a.action_type and b.action_target = a.action_target
          select {run} as tr_id, a.s_id as s_id, {name} as wl_name, a.action_type as action_type, a.action_target as action_target, a.status as status, a.h as h, b.h as bh, b.status as bs,
            cast(a.h as double) / nullif(cast(b.h as double), 0) as r where {where})"""
    return f"""a as (from {actual} p join scenario using (s_id) join workload using (wl_id) select p.*, {NAME} as wl_name, wl_disrandomly),
      b as (from {b}), u as ({side('s_id', 'wl_name', 'true')} union {side('adj_s_id', "wl_name || '_RWITHD'", 'wl_disrandomly')}),
      c as (from u select *, {CLASS} as test_result),
      d as (from c select tr_id, s_id, wl_name, action_type, action_target, h, bh, test_result,
        case when bs is not null and bh <> 0 and status not in ('SKIP', 'ERROR') then (h * 200 + bh) // (2 * bh) end as dev,
        case when test_result like 'SKIP%' or test_result like 'ERROR%' or bh is null then 0 else bh end as rev,
        cast(test_result in ('PASS', 'PASS AS NEW TEST CASE') as int) as success_status, cast(test_result = 'PASS WITH PERFORMANCE IMPROVEMENT' as int) as improve_status,
        cast(test_result like 'FAILURE%' as int) as failure_status, cast(test_result = 'SKIP' as int) as skip_status, cast(test_result like 'ERROR%' as int) as error_status)"""


OUT = """from d select tr_id, s_id, wl_name, action_type, action_target, cast(h * 0.01 as double) as actual_execution_time, cast(bh * 0.01 as double) as baseline_execution_time,
    test_result, cast(dev * 0.01 as double) as deviation, cast(rev * 0.01 as double) as revised_baseline_execution_time,
    success_status, improve_status, failure_status, skip_status, error_status"""


def summary(where: str) -> str:
    return f"""with {detail(res(101, 106), base('S1', 'E1'))},
      s as (from d select tr_id, s_id, wl_name, action_type, cast(sum(improve_status) as int) as improvenum, cast(sum(success_status) as int) as passnum,
          cast(sum(failure_status) as int) as failurenum, cast(sum(skip_status) as int) as skipnum, cast(sum(error_status) as int) as errornum,
          cast(sum(h) as bigint) as a, cast(sum(rev) as bigint) as b where action_target not like '%_STREAM' and {where} group by 1, 2, 3, 4),
      q as (from s select *, cast(a as double) / nullif(cast(b as double), 0) as r),
      o as (from q select *, case when errornum > 0 then 'ERROR' when a = 0 or b = 0 then 'SKIP' when r between cast(0.9 as double) and cast(1.1 as double) then 'PASS'
          when r < cast(0.9 as double) then 'PASS WITH PERFORMANCE IMPROVEMENT' else 'FAILURE WITH PERFORMANCE DOWNGRADE' end as overall_test_result,
        case when errornum > 0 then 'ERROR' when failurenum > 0 then 'FAILURE' when passnum + improvenum = 0 then 'SKIP' else 'PASS' end as detail_result)
      from o select tr_id, s_id, wl_name, action_type, improvenum, passnum, failurenum, skipnum, errornum, cast(a * 0.01 as double) as actual_total_execution_time,
        cast(b * 0.01 as double) as baseline_total_execution_time, cast(case when b > 0 then (a * 200 + b) // (2 * b) end * 0.01 as double) as deviation, overall_test_result, detail_result,
        format('Overall:{{}};     Detail(IMPROVEMENT: {{}}; PASS: {{}}; FAILURE: {{}}; SKIP: {{}}; ERROR: {{}})', overall_test_result, improvenum, passnum, failurenum, skipnum, errornum) as test_statistic,
        case when overall_test_result in ('SKIP', 'ERROR') then overall_test_result when prefix(overall_test_result, 'PASS') and detail_result = 'PASS' then 'PASS' else 'FAILURE' end as test_result_all"""


def hundred(h: str) -> str:
    return f"cast({h} * 0.01 as double)"


def tune(names: list[str], col: str, where: str, runs: tuple[int, int]) -> str:
    cols = ", ".join(f"""{hundred(f"max(h) filter (param = '{n}')")} as "{n}" """ for n in names)
    return f"""with spans as (from parameters select {col} as param, min(run_id) as lo, max(run_id) as hi where {where} group by 1)
      from {res(*runs)} r join spans on tr_id between lo and hi select s_id, action_type, action_target, {cols}
      group by 1, 2, 3 having max(h) filter (param = '{names[0]}') is not null"""


D103 = detail(res(103, 103), base("S1", "E1"))
SQL = {
    "single_stream": f"""from {pre('test_result', 'tr_id', True)} select tr_id, {ACTION}, status, {hundred('h')} as duration where action_target <> 'CONCURRENT_QUERY'""",
    "concurrent": f"""from {pre('test_result', 'tr_id', True)} select tr_id, {ACTION}, status, {hundred('h')} as duration where action_target = 'CONCURRENT_QUERY'""",
    "results": settings(res(101, 103), "tr_id, "),
    "baseline": settings(base("S1", "E1"), ""),
    "detail_run_vs_version": f"with {D103} {OUT}",
    "detail_runs_vs_version": f"with {detail(res(101, 103), base('S1', 'E1'))} {OUT}",
    "detail_run_vs_run": f"with {detail(res(103, 103), res(101, 101))} {OUT}",
    "detail_runs_vs_runs": f"with {detail(res(104, 106), res(101, 101))} {OUT}",
    "detail_version_vs_version": f"with {detail(base('S2', 'E2'), base('S1', 'E1'), 'cast(null as int)')} {OUT}",
    "summary": summary("true"),
    "summary_without_outlier": summary("action_target <> 'query_05'"),
    "promote": """from test_result select 'S3' as storage_version, 'E3' as engine_version, s_id, adj_s_id, action_type, action_target, stream, status, duration
        where tr_id in (104, 105)""",
    "by_scenario": f"""from {res(103, 103)} r select action_type, action_target,
        {', '.join(f"{hundred(f'coalesce(max(h) filter (s_id = {s}), 0)')} as p{i}" for i, s in enumerate(range(24), 1))} group by 1, 2""",
    "tuning_by_name": tune(["SEG_NUM", "MEMORY"], "param_name", "true", (101, 106)),
    "tuning_by_value": tune(["SEG4", "SEG8"], "param_value", "param_name = 'SEG_NUM'", (101, 104)),
    "report_lines": f"""with {D103} from d select format('Test Suite Name|{{}}|Test Case Name|{{}}.{{}}|Test Detail|Actual run time is: {{}} ms, Baseline time is: {{}} ms, Comparison is: {{}} ({{}} ms)|Test Status|{{}}',
          wl_name, action_type, action_target, coalesce(cast((h + 50) // 100 as varchar), 'N.A.'), coalesce(cast((bh + 50) // 100 as varchar), 'N.A.'),
          coalesce(cast(cast(dev as decimal(18,0)) * 0.01 as varchar), 'N.A.'), coalesce(cast((h + 50) // 100 as varchar), '0'), test_result) as line where wl_name not like '%RWITHD%'""",
}
PROMOTED = """(from test_result select 'S3' as storage_version, 'E3' as engine_version, s_id, adj_s_id, action_type, action_target, stream, status, duration
        where tr_id in (104, 105, 106))"""
SQL["stored_baseline"] = f"""(from test_baseline select storage_version, engine_version, s_id, adj_s_id, action_type, action_target, stream, status, duration) union all {PROMOTED}"""
SQL["detail_vs_promoted"] = f"with {detail(res(103, 103), pre(PROMOTED, '', False))} {OUT}"
SQL = {f"runs_{k}": with_tables(v) for k, v in SQL.items()}
