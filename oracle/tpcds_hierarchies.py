from oracle.prelude import A, S, top, with_tables

F18 = """from catalog_sales join date_dim on d_date_sk = cs_sold_date_sk join customer_demographics on cd_demo_sk = cs_bill_cdemo_sk
    join ds_customer on c_customer_sk = cs_bill_customer_sk join customer_address on ca_address_sk = c_current_addr_sk join item on i_item_sk = cs_item_sk"""
W18 = """where cd_gender = 'F' and cd_education_status = 'Unknown' and c_birth_month in (1, 2, 6, 8, 9, 12) and d_year = 1998
    and ca_state in ('GA', 'NM', 'OH', 'TN', 'TX', 'VA') and c_current_cdemo_sk in (from customer_demographics select cd_demo_sk)"""
K18 = "i_item_id, ca_country, ca_state, ca_county"
M18 = ["cs_quantity", "cs_list_price", "cs_coupon_amt", "cs_sales_price", "cs_net_profit", "c_birth_year", "cd_dep_count"]
O18 = top("ca_country", "ca_state", "ca_county", "i_item_id", limit=100)
F27 = """from store_sales join date_dim on d_date_sk = ss_sold_date_sk join customer_demographics on cd_demo_sk = ss_cdemo_sk
    join store on s_store_sk = ss_store_sk join item on i_item_sk = ss_item_sk"""
W27 = "where cd_gender = 'M' and cd_marital_status = 'S' and d_year = 1998 and s_state in ('GA', 'TN', 'TX')"
M27 = ["ss_quantity", "ss_list_price", "ss_coupon_amt", "ss_sales_price"]
O27 = top("i_item_id", "s_state", limit=100)


def means(cols: list[str]) -> str:
    return ", ".join(f"{A(c)} as agg{i}" for i, c in enumerate(cols, 1))


def of_means(n: int) -> str:
    return ", ".join(f"{A(f'cast(agg{i} as decimal(24,9))')} as agg{i}" for i in range(1, n + 1))


K22 = "i_product_name, i_brand, i_class, i_category"
F22 = "from inventory join date_dim on d_date_sk = inv_date_sk join item on i_item_sk = inv_item_sk join warehouse on w_warehouse_sk = inv_warehouse_sk"


def parent(body: str, value: str, direction: str, up: str, low: str, limit: str) -> str:
    """Rollup of (up, low) with the rank inside each level and parent."""
    return f"""with r as ({body} group by rollup ({up}, {low})),
      k as (from r select *, rank() over (partition by lochierarchy, if(lochierarchy = 0, {up}, null) order by {value} {direction}) as rank_within_parent)
      from k select {value}, {up}, {low}, lochierarchy, rank_within_parent
      order by lochierarchy desc, if(lochierarchy = 0, {up}, null) nulls last, rank_within_parent, {up} nulls last, {low} nulls last {limit}"""


def level(up: str, low: str) -> str:
    return f"cast(grouping({up}) + grouping({low}) as int) as lochierarchy"


SS = "from store_sales join date_dim on d_date_sk = ss_sold_date_sk join store on s_store_sk = ss_store_sk"
F36 = f"{SS} join item on i_item_sk = ss_item_sk"
W36 = "where d_year = 1998 and s_state in ('GA', 'TN', 'TX')"
MARGIN = "cast(sum(ss_net_profit) as double) / cast(sum(ss_ext_sales_price) as double) as gross_margin"
F86 = "from web_sales join date_dim on d_date_sk = ws_sold_date_sk join item on i_item_sk = ws_item_sk"
K67 = "i_category, i_class, i_brand, i_product_name, d_year, d_qoy, d_moy, s_store_id"
Q67 = f"""with r as ({F36} select {K67}, {S('coalesce(ss_sales_price * ss_quantity, 0)')} as sumsales where d_year = 1998 group by rollup ({K67}))
  from r select *, rank() over (partition by i_category order by sumsales desc) as rk qualify rk <= 100
  {top(*K67.split(', '), 'sumsales', 'rk', limit=100)}"""
SQL = {
    "q18": f"{F18} select {K18}, {means(M18)} {W18} group by rollup ({K18}) {O18}",
    "q18a": f"with r as ({F18} select {K18}, {means(M18)} {W18} group by all) from r select {K18}, {of_means(7)} group by rollup ({K18}) {O18}",
    "q22": f"{F22} select {K22}, {A('inv_quantity_on_hand')} as qoh where d_year = 1999 group by rollup ({K22}) {top('qoh', *K22.split(', '), limit=100)}",
    "q22a": f"""with r as ({F22} select {K22}, cast({A('inv_quantity_on_hand')} as decimal(24,9)) as a where d_year = 1999 group by all)
        from r select {K22}, {S('a')} as qoh group by rollup ({K22}) {top('qoh', *K22.split(', '), limit=100)}""",
    "q27": f"{F27} select i_item_id, s_state, cast(grouping(s_state) as int) as g_state, {means(M27)} {W27} group by rollup (i_item_id, s_state) {O27}",
    "q27a": f"""with r as ({F27} select i_item_id, s_state, {means(M27)} {W27} group by all)
        from r select i_item_id, s_state, cast(grouping(s_state) as int) as g_state, {of_means(4)} group by rollup (i_item_id, s_state) {O27}""",
    "q36": f"{F36} select {MARGIN}, i_category, i_class, cast(1 as int) as rank_within_parent {W36} group by i_category, i_class {top('i_category', 'i_class', limit=100)}",
    "q36a": parent(f"{F36} select i_category, i_class, {MARGIN}, {level('i_category', 'i_class')} {W36}", "gross_margin", "asc nulls last", "i_category", "i_class", "limit 100"),
    "q70": f"{SS} select {S('ss_net_profit')} as total_sum, s_state, s_county, cast(1 as int) as rank_within_parent where d_year = 1998 group by s_state, s_county {top('s_state', 's_county', limit=100)}",
    "q70a": parent(f"{SS} select s_state, s_county, {S('ss_net_profit')} as total_sum, {level('s_state', 's_county')} where d_year = 1998", "total_sum", "desc nulls first", "s_state", "s_county", ""),
    "q86": f"{F86} select {S('ws_net_paid')} as total_sum, i_category, i_class, cast(1 as int) as rank_within_parent where d_year = 1998 group by i_category, i_class {top('i_category', 'i_class', limit=100)}",
    "q86a": parent(f"{F86} select i_category, i_class, {S('ws_net_paid')} as total_sum, {level('i_category', 'i_class')} where d_year = 1998", "total_sum", "desc nulls first", "i_category", "i_class", "limit 100"),
    "q67": Q67, "q67a": Q67,
}
SQL = {f"tpcds_{k}": with_tables(v) for k, v in SQL.items()}
