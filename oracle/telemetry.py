from oracle.prelude import XA, with_tables

SUMS = "sum(rss) as rss, sum(pmem) as pmem, sum(pcpu) as pcpu"
DBL = "cast(rss as double) as rss, cast(pmem as double) as pmem, cast(pcpu as double) as pcpu"


def extra(where: str = "true") -> dict[str, str]:
    return {
        "seg": f"from worker_samples select run_id, hostname, timeslot, min(real_time) as begintime, con_id, seg_id, {SUMS} where {where} group by run_id, hostname, timeslot, con_id, seg_id",
        "mst": f"from master_samples select run_id, hostname, timeslot, min(real_time) as begintime, con_id, {SUMS} where {where} group by run_id, hostname, timeslot, con_id",
        "node": f"""(from seg select run_id, hostname, 'QE' as role, timeslot, begintime, {SUMS}, count(*) as segnum group by run_id, hostname, timeslot, begintime)
          union all (from mst select run_id, hostname, 'QD', timeslot, begintime, {SUMS}, count(*) group by run_id, hostname, timeslot, begintime)""",
        "que": f"""from run_spans select distinct run_id, wl_name, if(action_type = 'Loading', concat(action_type, '_', action_target), action_target) as query_name, stream, con_id, start_time, end_time where status <> 'SKIP' and {where}""",
        "win": f"""from run_spans select run_id, wl_name, case when contains(wl_name, '_CONCURRENT') then 'CONCURRENT' when action_type = 'Loading' then 'Loading' else action_target end as query_name,
          min(start_time) as start_time, max(end_time) as end_time where status <> 'SKIP' and {where} group by 1, 2, 3""",
    }


def run(sql: str, where: str = "true") -> str:
    return with_tables(sql, extra(where))


def half_up(total: str, n: str) -> str:
    """total / n at two decimals, half up; total in hundredths."""
    return f"cast((({total}) * 2 + ({n})) // (2 * ({n})) * 0.01 as double)"


def spread(g: str) -> str:
    h = f"cast({g} * 100 as bigint)"
    return f"""cast(max({g}) as double) as {g}_max, {half_up(f'cast(sum({h}) as bigint)', f'count({g})')} as {g}_avg, cast(min({g}) as double) as {g}_min,
      case when min({g}) = 0 then 0.0::double else {half_up(f'max({h}) * 100', f'nullif(min({h}), 0)')} end as {g}_ratio"""


SEGSTAT = f"""with tops as (from que q join seg s on s.run_id = q.run_id and s.con_id = q.con_id and s.begintime >= q.start_time and s.begintime < q.end_time
      select q.*, s.hostname || '-' || s.seg_id as g, max(s.rss) as rss, max(s.pmem) as pmem, max(s.pcpu) as pcpu group by all)
    from (from que select distinct *) q left join tops p using (run_id, wl_name, query_name, stream, con_id, start_time, end_time)
    select run_id, wl_name, query_name, stream, start_time, end_time, count(g) as segnum, {', '.join(spread(g) for g in ('pmem', 'pcpu', 'rss'))}
    group by run_id, wl_name, query_name, stream, con_id, start_time, end_time"""
MIB = 1024 * 1024
HOSTS = ["mst1"] + [f"w{i}" for i in range(1, 9)]


def pivot(kind: str, c: str) -> str:
    v = f"cast(n.{c} as decimal(18,2))"
    hosts = ", ".join(f"cast(coalesce(max({v}) filter (n.hostname = '{h}'), 0) as double) as {h}" for h in HOSTS)
    work = "n.hostname <> 'mst1'"
    hund = f"cast(sum(if({work}, cast({v} * 100 as bigint), 0)) as bigint)"
    return f"""(from win w join node n on n.run_id = w.run_id and n.begintime between w.start_time and w.end_time
      select w.run_id as run_id, w.wl_name as wl_name, w.query_name as query_name, n.timeslot as timeslot, '{kind}' as kind, {hosts}, min(n.begintime) as begintime,
        cast(greatest(coalesce(max({v}) filter ({work}), 0), 0) as double) as max_workers, {half_up(hund, '8')} as avg_workers,
        cast(min(if({work}, {v}, 9999999)) as double) as min_workers,
        cast(if(n.timeslot = min(n.timeslot) over (partition by w.run_id, w.wl_name, w.query_name), 32000, 0) as int) as timebound group by 1, 2, 3, 4)"""


def usage(src: str, p: str) -> str:
    return f"""(from run_spans r join {src} s on s.run_id = r.run_id and s.con_id = r.con_id and r.status <> 'SKIP' and s.begintime between r.start_time and r.end_time
      select r.run_id as run_id, r.con_id as con_id, r.action_target as action_target, r.start_time as start_time, r.end_time as end_time, count(*) as {p}_samples,
        {', '.join(f'cast(max(s.{g}) as double) as {p}_{g}' for g in ('rss', 'pmem', 'pcpu'))} group by 1, 2, 3, 4, 5)"""


MASTER = """from (from que select distinct *) q left join mst m on m.run_id = q.run_id and m.con_id = q.con_id and m.begintime >= q.start_time and m.begintime < q.end_time
        select q.run_id as run_id, q.wl_name as wl_name, q.query_name as query_name, q.stream as stream, q.start_time as start_time, q.end_time as end_time,
          cast(max(m.pmem) as double) as pmem_max, cast(max(m.pcpu) as double) as pcpu_max, cast(max(m.rss) as double) as rss_max
        group by q.run_id, q.wl_name, q.query_name, q.stream, q.con_id, q.start_time, q.end_time"""
WORDS = "string_split(regexp_replace(trim(line), '\\s+', ' ', 'g'), ' ')"
SQL = {
    "process_lines": f"""with p as (from process_lines select *, {WORDS} as w),
        q as (from p select hostname, timeslot, w[1] as pid, substr(w[13], 4) as con_id, w[14] as seg_id, if(w[15] <> 'idle', w[15], null) as cmd,
          if(w[15] <> 'idle' and contains(coalesce(w[16], ''), 'slice'), w[16], null) as slice,
          case when w[15] = 'idle' then w[15] when contains(coalesce(w[16], ''), 'slice') then w[18] else w[17] end as status,
          cast(try_cast(w[4] as bigint) // 1024 as bigint) as rss, w[5] as pmem, w[2] as pcpu where len(w) >= 15 and prefix(w[13], 'con') and prefix(w[14], 'seg'))
        from q where rss is not null and status is not null""",
    "per_segment": f"from seg select * exclude (rss, pmem, pcpu), {DBL}",
    "per_connection": f"from (from seg select run_id, hostname, timeslot, begintime, con_id, {SUMS} group by 1, 2, 3, 4, 5) select * exclude (rss, pmem, pcpu), {DBL}",
    "per_host": f"from (from seg select run_id, hostname, timeslot, begintime, {SUMS} group by 1, 2, 3, 4) select * exclude (rss, pmem, pcpu), {DBL}",
    "peaks": f"""from (from seg select run_id, hostname, timeslot, begintime, {SUMS} group by 1, 2, 3, 4)
        select hostname, timeslot // 300 as tm, cast(max(rss) as double) as max_rss, cast(max(pcpu) as double) as max_pcpu group by 1, 2""",
    "query_usage": f"from {usage('seg', 'worker')} join {usage('mst', 'master')} using (run_id, con_id, action_target, start_time, end_time)",
    "result_windows": "from win",
    "per_node": f"from node select run_id, hostname, role, timeslot, begintime, segnum, {DBL}",
    "segment_statistics": SEGSTAT,
    "master_statistics": MASTER,
    "spans_from_activity": """with m as (from (from activity select distinct snapshot) select snapshot, lead(snapshot) over (order by snapshot) as following),
        s as (from activity select sess_id, query_no, user_name, min(snapshot) as query_start_time, max(snapshot) as last_seen, count(*) as snapshots group by 1, 2, 3)
        from s join m on last_seen = snapshot select sess_id, query_no, user_name, query_start_time, following as query_end_time, snapshots where following is not null""",
    "cpu": f"from gauges select host, {XA('100 - cpu_idle')} as cpu_used group by 1",
    "memory": f"from gauges select host, {XA('100 * (mem_total - mem_cached - mem_free) / mem_total', 8)} as memory_used group by 1",
    "io": f"""from (from gauges select host, {', '.join(f"{XA(f'100 * {c} / {MIB} / {top}', 8)} as {c}_pct" for c, top in (('bytes_written', 250), ('bytes_read', 200), ('bytes_out', 100), ('bytes_in', 100)))} group by 1)
        select *, least(bytes_written_pct, bytes_read_pct, bytes_out_pct, bytes_in_pct) >= 50 as passed""",
    "leak_angle": """with p as (from gauges select slot, cast(sum(cast((mem_total - mem_cached - mem_free) / 1024 / 1024 as decimal(18,6))) as double) / count(*) as y group by 1),
        f as (from p select count(*) as samples, cast(trunc(degrees(atan(regr_slope(y, slot)))) as int) as angle) from f select samples, angle, angle < 0 or angle > 15 as alarm""",
    "disk_alarms": "from gauges select host, disk_path, max(disk_used) as disk_used group by 1, 2 having max(disk_used) > 80",
    "keywords": """from log_lines, (select unnest(['error', 'fatal', 'warning', 'panic', 'exception']) as keyword) select host, keyword, count(*) as lines
        where contains(lower(message), keyword) group by 1, 2""",
    "recent_matches": """from log_lines select host, logged, message where logged > (from log_lines select max(logged)) - interval 48 hours
        and regexp_matches(message, 'FATAL|ERROR|EXCEPTION|FAIL|WARN|PANIC')""",
}
SQL = {f"telemetry_{k}": run(v) for k, v in SQL.items()}
PIVOT = " union all ".join(pivot(k, c) for k, c in (("memory", "rss"), ("cpu", "pcpu"), ("segnum", "segnum")))
SQL["telemetry_host_pivot"] = run(PIVOT)
RANGE = "run_id between 1 and 2"
SQL["telemetry_monitor_report"] = run(SEGSTAT, RANGE)
SQL["telemetry_monitor_windows"] = run("from win", RANGE)
SQL["telemetry_monitor_nodes"] = run(f"from node select run_id, hostname, role, timeslot, begintime, segnum, {DBL}", RANGE)
SQL["telemetry_monitor_hosts"] = run(PIVOT, RANGE)
SQL["telemetry_monitor_master"] = run(MASTER, RANGE)
ONE = "run_id = 1"
NODES = f"from node select run_id, hostname, role, timeslot, begintime, segnum, {DBL}"
FRAMES = {"windows": "from win", "nodes": NODES, "hosts": PIVOT, "segments": SEGSTAT, "master": MASTER}
PARTS = [f"(from {n} select '{kind}' as kind, '{n}' as name, count(*) as n where run_id {sign} 1)" for n in ("run_spans", "master_samples", "worker_samples") for kind, sign in (("left", "<>"), ("moved", "="))]
PARTS += [f"(from ({v}) select 'frame' as kind, '{k}' as name, count(*) as n)" for k, v in FRAMES.items()]
SQL["telemetry_archive"] = run(" union all ".join(PARTS), ONE)
SQL["telemetry_archive_segments"] = run(SEGSTAT, ONE)
