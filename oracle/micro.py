from oracle.prelude import XA, XS, with_tables

R = "l_extendedprice * (1 - l_discount)"
PART = "from h_part select p_partkey, p_name, p_brand, p_size, p_retailprice, p_mfgr, p_container, p_comment, p_type"

SQL = {
    "x01": "from h_lineitem where l_linenumber < 0",
    "x01_full": """from h_lineitem select l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_commitdate
        where l_linenumber = 7""",
    "x02": PART,
    "x03": PART,
    "x04": "from lineitem select count(*) as row_count",
    "x05": "from lineitem select count(distinct l_quantity) as quantities",
    "x06": f"from orders select o_orderstatus, o_orderpriority, {XA('o_totalprice')} as avg_o_totalprice group by all",
    "x07": "from h_lineitem select l_receiptdate, count(*) as num group by all",
    "x08": "from h_orders select left(o_comment, 22) as substring_comment, count(*) as num group by all",
    "x09": f"from lineitem join orders on o_orderkey = l_orderkey select {XA('l_quantity')} as avg_quantity",
    "x10": f"from part join lineitem on l_partkey = p_partkey select {XA('p_retailprice * l_quantity')} as avg_total_price",
    "x11": f"from part join lineitem on l_suppkey = p_partkey select {XS('l_quantity', 2)} as total_quantity",
    "x12": f"from customer join nation on n_nationkey = c_nationkey select n_name, {XA('c_acctbal')} as avg_acctbal group by all",
    "x13": f"from customer select {XS('c_acctbal', 2)} as total_acctbal where c_custkey not in (from h_orders select o_custkey)",
    "x14": f"""from h_lineitem select l_returnflag, l_linestatus, l_shipmode, left(l_shipinstruct, 1) as instruct_initial,
        left(l_linestatus, 1) as status_initial, l_quantity - l_linenumber + (l_linenumber - l_quantity) as zero_quantity,
        l_extendedprice - l_extendedprice as zero_price, {XS('(1 + l_tax) * l_extendedprice')} as taxed, {XS(R)} as revenue,
        {XS('l_discount / 3', 8)} as third_discount, {XS(R + ' * (1 + l_tax)', 6)} as charge,
        {XS('l_extendedprice - ' + R)} as rebate, cast(sum(date '2002-01-01' - l_shipdate + 5) as bigint) as age_days,
        cast(sum(l_shipdate - l_commitdate) as bigint) as ship_lag, cast(sum(l_receiptdate - l_shipdate) as bigint) as transit,
        cast(sum(l_linenumber + 1) as bigint) as line_sum, {XS('l_extendedprice / (10 - l_tax)', 8)} as price_tenth,
        {XS('l_quantity * 2 / (l_linenumber * 3)', 8)} as quantity_share, count(*) as n
        where l_linenumber > 2 group by all""",
    "x15": """from h_lineitem select count(*) as n where l_quantity = 50 and l_shipdate < '2002-01-01'
        and l_shipdate < l_commitdate and l_commitdate < l_receiptdate""",
    "x16": "from part select p_name, p_retailprice where p_partkey < 5000 and p_retailprice < 909",
    "x17": "from lineitem select l_orderkey, l_linenumber where l_shipdate < '1995-12-01'",
    "x18": "from h_orders select distinct o_clerk where prefix(o_clerk, 'Clerk#0000006')",
    "x19": "from h_lineitem select distinct l_quantity where year(l_shipdate) = 1996 and month(l_shipdate) = 3",
    "x20": "from h_orders select count(*) as n where o_clerk = 'Clerk#000000670' or o_orderkey = 505",
    "x21": "from lineitem select l_discount, count(*) as n group by all",
    "x22": f"from h_part select {XA('p_retailprice')} as avg_price where p_type = 'SMALL PLATED BRASS'",
    "x23": f"from part select {XA('p_retailprice')} as avg_price where p_size = 21",
}
SQL = {f"micro_{k}": with_tables(v) for k, v in SQL.items()}
