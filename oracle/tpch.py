from oracle.prelude import S, X, XA, XS, top, with_tables

R = "l_extendedprice * (1 - l_discount)"

SQL = {
    "q01": f"""from h_lineitem select l_returnflag, l_linestatus, {XS('l_quantity', 2)} as sum_qty,
        {XS('l_extendedprice', 2)} as sum_base_price, {XS(R)} as sum_disc_price, {XS(R + ' * (1 + l_tax)', 6)} as sum_charge,
        {XA('l_quantity')} as avg_qty, {XA('l_extendedprice')} as avg_price, {XA('l_discount')} as avg_disc, count(*) as count_order
        where l_shipdate <= date '2001-09-27' group by all""",
    "q02": f"""from (select *, min(ps_supplycost) over (partition by p_partkey) as low
          from h_part join partsupp on p_partkey = ps_partkey join h_supplier on s_suppkey = ps_suppkey
          join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey
          where p_size between 25 and 34 and suffix(p_type, 'COPPER') and r_name = 'MIDDLE EAST')
        select s_acctbal, s_name, n_name, p_partkey, p_mfgr, s_address, s_phone, s_comment
        where ps_supplycost = low {top('-s_acctbal', 'n_name', 's_name', 'p_partkey', limit=100)}""",
    "q03": f"""from h_lineitem join h_orders on o_orderkey = l_orderkey join h_customer on c_custkey = o_custkey
        select l_orderkey, o_orderdate, o_shippriority, {XS(R)} as revenue
        where c_mktsegment = 'FURNITURE' and o_orderdate < '1998-03-26' and l_shipdate > '1998-03-26'
        group by all {top('-revenue', 'o_orderdate', 'l_orderkey', limit=10)}""",
    "q04": """from h_orders select o_orderpriority, count(*) as order_count
        where o_orderdate between '1997-02-01' and '1997-04-30'
          and o_orderkey in (from h_lineitem select l_orderkey where l_commitdate < l_receiptdate) group by all""",
    "q05": f"""from h_lineitem join h_orders on o_orderkey = l_orderkey join h_customer on c_custkey = o_custkey
        join h_supplier on s_suppkey = l_suppkey and s_nationkey = c_nationkey
        join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey
        select n_name, {XS(R)} as revenue where r_name = 'ASIA' and year(o_orderdate) = 1997 group by all""",
    "q06": f"""from h_lineitem select {XS('l_extendedprice * l_discount')} as revenue
        where year(l_shipdate) = 1997 and l_discount between cast(0.05 as double) and cast(0.07 as double) and l_quantity < 24""",
    "q07": f"""from h_lineitem join h_orders on o_orderkey = l_orderkey join h_customer on c_custkey = o_custkey
        join h_supplier on s_suppkey = l_suppkey join nation a on a.n_nationkey = s_nationkey join nation b on b.n_nationkey = c_nationkey
        select a.n_name as supp_nation, b.n_name as cust_nation, year(l_shipdate) as l_year, {XS(R)} as revenue
        where (a.n_name, b.n_name) in (('NATION_3', 'NATION_8'), ('NATION_8', 'NATION_3')) and year(l_shipdate) in (1997, 1998)
        group by all""",
    "q08": f"""from h_lineitem join h_part on p_partkey = l_partkey join h_orders on o_orderkey = l_orderkey
        join h_customer on c_custkey = o_custkey join nation cn on cn.n_nationkey = c_nationkey
        join region on r_regionkey = cn.n_regionkey join h_supplier on s_suppkey = l_suppkey join nation sn on sn.n_nationkey = s_nationkey
        select year(o_orderdate) as o_year,
          cast(coalesce(sum({X(R)}) filter (sn.n_name = 'NATION_5'), 0) as double) / {XS(R)} as mkt_share
        where r_name = 'AFRICA' and p_type = 'STANDARD ANODIZED TIN' and year(o_orderdate) in (1997, 1998) group by all""",
    "q09": f"""from h_lineitem join h_part on p_partkey = l_partkey join partsupp on (ps_partkey, ps_suppkey) = (l_partkey, l_suppkey)
        join h_orders on o_orderkey = l_orderkey join h_supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey
        select n_name as nation, year(o_orderdate) as o_year,
          {S(X(R) + ' - ' + X('ps_supplycost * cast(l_quantity as decimal(5,0))'))} as sum_profit
        where contains(p_name, 'blue') group by all""",
    "q10": f"""from h_lineitem join h_orders on o_orderkey = l_orderkey join h_customer on c_custkey = o_custkey
        join nation on n_nationkey = c_nationkey
        select c_custkey, c_name, {XS(R)} as revenue, c_acctbal, n_name, c_address, c_phone, c_comment
        where l_returnflag = 'R' and o_orderdate between '1997-07-01' and '1997-09-30'
        group by all {top('-revenue', 'c_custkey', limit=20)}""",
    "q11": f"""with stock as (from partsupp join h_supplier on s_suppkey = ps_suppkey join nation on n_nationkey = s_nationkey
          select ps_partkey, {X('ps_supplycost * ps_availqty', 2)} as worth where n_name = 'NATION_7')
        from stock select ps_partkey, {S('worth')} as value group by all
        having {S('worth')} > (from stock select {S('worth')} * cast(0.0005 as double))""",
    "q12": """from h_lineitem join h_orders on o_orderkey = l_orderkey
        select l_shipmode, count(*) filter (o_orderpriority in ('1-URGENT', '2-HIGH')) as high_line_count,
          count(*) filter (o_orderpriority not in ('1-URGENT', '2-HIGH')) as low_line_count
        where l_shipmode in ('REG AIR', 'FOB') and l_shipdate < l_commitdate and l_commitdate < l_receiptdate
          and year(l_receiptdate) = 1997 group by all""",
    "q13": """with c as (from h_customer left join h_orders on o_custkey = c_custkey and o_comment not like '%express%deposits%'
          select c_custkey, count(o_orderkey) as c_count group by all)
        from c select c_count, count(*) as custdist group by all""",
    "q14": f"""from h_lineitem join h_part on p_partkey = l_partkey
        select 100.0::double * cast(coalesce(sum({X(R)}) filter (prefix(p_type, 'PROMO')), 0) as double) / {XS(R)} as promo_revenue
        where year(l_shipdate) = 1997 and month(l_shipdate) = 4""",
    "q15": f"""with r as (from h_lineitem select l_suppkey, {XS(R)} as total_revenue
          where l_shipdate >= '1997-04-01' and l_shipdate < date '1997-04-01' + 90 group by all)
        from r join h_supplier on s_suppkey = l_suppkey select s_suppkey, s_name, s_address, s_phone, total_revenue
        where total_revenue = (from r select max(total_revenue))""",
    "q16": """from partsupp join h_part on p_partkey = ps_partkey
        select p_brand, p_type, p_size, count(distinct ps_suppkey) as supplier_cnt
        where p_brand <> 'Brand#15' and not prefix(p_type, 'ECONOMY BURNISHED') and p_size in (6, 9, 14, 21, 42, 44, 45, 47)
          and ps_suppkey not in (from h_supplier select s_suppkey where s_comment like '%Customer%Complaints%') group by all""",
    "q17": f"""from (from h_lineitem join h_part on p_partkey = l_partkey
          select *, cast(0.2 as double) * (cast(sum({X('l_quantity', 2)}) over w as double) / count(*) over w) as bound
          where p_brand = 'Brand#5' and p_container = 'JUMBO CASE' window w as (partition by l_partkey))
        select {XS('l_extendedprice', 2)} / cast(7.0 as double) as avg_yearly where l_quantity < bound""",
    "q18": f"""from h_lineitem join h_orders on o_orderkey = l_orderkey join h_customer on c_custkey = o_custkey
        select c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice, {XS('l_quantity', 2)} as total_quantity
        group by all having sum(l_quantity) > 250
        {top('-o_totalprice', '-total_quantity', 'o_orderdate', 'c_name', 'c_custkey', 'o_orderkey', limit=100)}""",
    "q19": f"""from h_lineitem join h_part on p_partkey = l_partkey select {XS(R)} as revenue
        where l_shipmode in ('AIR', 'REG AIR') and l_shipinstruct = 'DELIVER IN PERSON' and p_size >= 1
          and case p_brand when 'Brand#1' then p_container in ('SM CASE', 'SM BOX') and l_quantity between 2 and 12 and p_size <= 30
            when 'Brand#2' then p_container in ('MED BAG', 'MED BOX') and l_quantity between 10 and 20 and p_size <= 40
            when 'Brand#3' then p_container in ('LG CASE', 'LG BOX') and l_quantity between 20 and 30 and p_size <= 50 end""",
    "q20": """from h_supplier join nation on n_nationkey = s_nationkey select s_name, s_address
        where n_name = 'NATION_4' and exists (from partsupp join h_part on p_partkey = ps_partkey
          where ps_suppkey = s_suppkey and prefix(p_name, 'blue') and ps_availqty > (from h_lineitem
            select cast(0.5 as double) * sum(l_quantity) where (l_partkey, l_suppkey) = (ps_partkey, ps_suppkey) and year(l_shipdate) = 1997))""",
    "q21": """from h_lineitem a join h_supplier on s_suppkey = a.l_suppkey join nation on n_nationkey = s_nationkey
          join h_orders on o_orderkey = a.l_orderkey
        select s_name, count(*) as numwait
        where o_orderstatus = 'F' and n_name = 'NATION_4' and a.l_receiptdate > a.l_commitdate
          and exists (from h_lineitem b where b.l_orderkey = a.l_orderkey and b.l_suppkey <> a.l_suppkey)
          and not exists (from h_lineitem c where c.l_orderkey = a.l_orderkey and c.l_suppkey <> a.l_suppkey and c.l_receiptdate > c.l_commitdate)
        group by all order by numwait desc, s_name limit 100""",
    "q22": f"""with p as (from h_customer select *, left(c_phone, 2) as cntrycode where cntrycode in ('15', '17', '19', '22', '27', '29', '31'))
        from p anti join h_orders on o_custkey = c_custkey
        select cntrycode, count(*) as numcust, {XS('c_acctbal', 2)} as totacctbal
        where c_acctbal > (from p select {XA('c_acctbal')} where c_acctbal > 0) group by all""",
}
SQL = {f"tpch_{k}": with_tables(v) for k, v in SQL.items()}
