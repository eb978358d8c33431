from oracle.prelude import XS, with_tables
from tidemark.plans.retail_star import CIPHER_COUPON

GOOD = "where l_orderkey % 500 <> 0"
TOTALS = f"""from lineitem select l_returnflag, count(*) as n, {XS('l_extendedprice', 2)} as price, max(l_shipdate) as last_ship {GOOD} group by 1"""
LOADED = f"({TOTALS}) union all (from lineitem select 'rejected', count(*), null, null where l_orderkey % 500 = 0)"


def windows(minutes: int, slide: int) -> str:
    n = minutes // slide
    return f"""from (from events, (select unnest(range({n})) as k) select *, time_bucket(interval {slide} minutes, ts, timestamp '1970-01-01') - to_minutes(k * {slide}) as s)
      select s as window_start, s + interval {minutes} minutes as window_end, concat('w', user_id % 8) as host, max(value) as peak, {XS('value', 2)} as total, count(*) as samples
      group by 1, 2, 3"""


SQL = {
    "load_delimited": LOADED,
    "load_csv": TOTALS,
    "load_rejects": "from lineitem select count(*) filter (l_orderkey % 500 <> 0) as good, count(*) filter (l_orderkey % 500 = 0) as bad",
    "load_nulls": f"""from orders select if(o_orderkey % 3 = 0, null, o_orderpriority) as o_orderpriority, count(*) as n, {XS('o_totalprice', 2)} as price group by 1""",
    "layout_slices": """from lineitem select cast(date_diff('day', date '1995-01-01', l_shipdate) * 14 // (date '2001-12-31' - date '1995-01-01' + 1) as int) as slice,
        count(*) as n, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship group by 1""",
    "layout_twenty_days": f"""from orders select cast(date_diff('day', date '1995-01-01', o_orderdate) // 20 as int) as slice, count(*) as n, {XS('o_totalprice', 2)} as price
        where o_orderdate >= date '1995-01-01' + 800 and o_orderdate < date '1995-01-01' + 840 group by 1""",
    "layout_months": f"""from orders select cast(strftime(o_orderdate, '%Y%m') as int) as order_month, count(*) as n, {XS('o_totalprice', 2)} as price
        where o_orderdate between '1998-03-15' and '1998-05-10' group by 1""",
    "layout_colocated": f"from lineitem join orders on o_orderkey = l_orderkey select o_orderpriority, count(*) as n, {XS('l_quantity', 2)} as quantity group by 1",
    "layout_random": "from part select p_size, count(*) as n group by 1",
    "layout_history": """from (from events select cast(event_id % 4 as int) as run_id, unnest(case when event_id % 4 = 1 then ['first', 'second'] when event_id % 4 = 2 then ['first'] else ['left'] end) as batch_id)
        select run_id, batch_id, count(*) as n group by all""",
    "layout_literal": f"""from orders join (values ('O', 'open'), ('F', 'filled'), ('P', 'partly filled')) s(o_orderstatus, status_name) using (o_orderstatus)
        select status_name, count(*) as n, {XS('o_totalprice', 2)} as price group by 1""",
    "check_priority": """from orders, (values ('same', false), ('changed', true)) c(copy, changed)
        select copy, 2 * count(*) filter (changed and o_orderkey % 1000 = 7) as differing,
          if(count(*) filter (changed and o_orderkey % 1000 = 7) > 0, 'FAIL', 'PASS') as status, 'answer' as how group by copy""",
    "star_ciphers": f"""from customer select c_custkey, if(length(c_custkey::varchar) > 5, '#####', lpad(c_custkey::varchar, 5, '0')) as printed,
        translate(c_custkey::varchar, '0123456789', '{CIPHER_COUPON}') as cipher, substring(c_name from 10 for 4) as cut""",
    "layout_view": f"""with r as (from lineitem select l_suppkey as s_suppkey, {XS('l_extendedprice * (1 - l_discount)')} as v
          where l_shipdate >= '1997-04-01' and l_shipdate < date '1997-04-01' + 90 group by 1)
        from r join supplier using (s_suppkey) select s_nationkey, count(*) as suppliers, max(v) as best group by 1""",
    "check_difference": """(from orders select o_custkey, o_orderkey, o_totalprice, '+' as side, 1::bigint as copies where o_orderkey % 1000 = 7)
        union all (from orders select o_custkey, o_orderkey, o_totalprice + 1, '-', 1 where o_orderkey % 1000 = 7)
        union all (from orders select o_custkey, o_orderkey, o_totalprice, '-', 1 where o_orderkey % 2000 = 11)""",
    "check_digest": """from orders select count(*) as row_count,
        cast(sum(cast('0x' || substr(md5(concat_ws('|', o_custkey, o_orderkey, o_orderpriority, o_orderstatus)), 1, 15) as bigint)) as varchar) as hash_sum""",
    "check_row_counts": """(from lineitem select 'lineitem' as table_name, count(*) as rows, count(*) >= 1000 as passed) union all (from orders select 'orders', count(*), count(*) >= 1000)
        union all (from part select 'part', count(*), count(*) >= 100)""",
    "stream_append": "from events select count(*) as rows, count(*) as running",
    "stream_load": LOADED,
    "stream_tumbling": windows(5, 5),
    "stream_sliding": windows(60, 30),
    "stream_spans": """with g as (from events select user_id, ts, if(ts - lag(ts) over w < interval 1 hour, 0, 1) as fresh window w as (partition by user_id order by ts)),
        n as (from g select user_id, ts, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as no)
        from n select user_id, min(ts) as started, max(ts) as last_seen, max(ts) + interval 1 hour as ended, count(*) as snapshots group by user_id, no""",
    "stream_snapshots": """with s as (from events select distinct user_id % 8 as monitor, time_bucket(interval 15 minutes, ts, timestamp '1970-01-01') as tm, user_id as sess_id, event_type as user_name),
        m as (from (from s select distinct monitor, tm) select monitor, tm, row_number() over (partition by monitor order by tm) as n, lead(tm) over (partition by monitor order by tm) as following),
        g as (from s join m using (monitor, tm) select *, n - row_number() over (partition by monitor, sess_id, user_name order by tm) as island),
        r as (from g select monitor, sess_id, 1::bigint as query_no, user_name, min(tm) as query_start_time, max(tm) as last_seen, count(*) as snapshots group by monitor, sess_id, user_name, island)
        from r join m on m.monitor = r.monitor and m.tm = last_seen select r.monitor as monitor, sess_id, query_no, user_name, query_start_time, following as query_end_time, snapshots where following is not null""",
    "star_products": """with f as (from part select p_type || ' ' || string_split(p_name, ' ')[-1] as cat, concat(p_name, ' ', p_partkey) as product_name, cast(p_retailprice as decimal(15,2)) as price),
        c as (from (from f select distinct cat) select cat, row_number() over (order by cat) as category_id)
        from f join c using (cat) select row_number() over (order by product_name, category_id, price) as product_id, category_id, cast(price as double) as price, product_name""",
}
SQL = {k: with_tables(v) for k, v in SQL.items()}
