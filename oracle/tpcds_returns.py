from oracle.prelude import A, S, top, with_tables
from oracle.tpcds_star import days_between


def above(totals: str, by: str) -> str:
    """Rows above 1.2 times the group's average, as a named query `hi`."""
    return f"""tot as ({totals}), hi as (from tot select *, cast(ctr as double) as ctr_total_return
      qualify cast(ctr as double) > cast(1.2 as double) * (cast(sum(ctr) over (partition by {by}) as double) / count(*) over (partition by {by})))"""


def state_totals(fact: str, p: str, amount: str) -> str:
    return f"""from {fact} join date_dim on d_date_sk = {p}_returned_date_sk join customer_address on ca_address_sk = {p}_returning_addr_sk
      select {p}_returning_customer_sk as ck, ca_state as st, sum({amount}) as ctr where d_year = 1998 group by all"""


C30 = "c_customer_id, c_salutation, c_first_name, c_last_name, c_preferred_cust_flag, c_birth_day, c_birth_month, c_birth_year, c_birth_country, c_login, c_email_address, c_last_review_date, ctr_total_return"
C81 = "c_customer_id, c_salutation, c_first_name, c_last_name, ca_street_number, ca_street_name, ca_street_type, ca_suite_number, ca_city, ca_county, ca_state, ca_zip, ca_country, ca_gmt_offset, ca_location_type, ctr_total_return"
LOCAL = "from hi join ds_customer on c_customer_sk = ck join customer_address on ca_address_sk = c_current_addr_sk"


def shipped(fact: str, p: str, start: str, state: str, outlet: str, tests: str) -> str:
    return f"""from {fact} a join date_dim on d_date_sk = a.{p}_ship_date_sk join customer_address on ca_address_sk = a.{p}_ship_addr_sk {outlet}
      select count(distinct a.{p}_order_number) as order_count, {S(f'a.{p}_ext_ship_cost')} as total_shipping_cost, {S(f'a.{p}_net_profit')} as total_net_profit
      where d_date between date '{start}' and date '{start}' + 60 and ca_state = '{state}' and {tests}"""


def split(fact: str, p: str) -> str:
    return f"exists (from {fact} b where b.{p}_order_number = a.{p}_order_number and b.{p}_warehouse_sk <> a.{p}_warehouse_sk)"


def excess(fact: str, p: str) -> str:
    x = f"{p}_ext_discount_amt"
    return f"""with f as (from {fact} join date_dim on d_date_sk = {p}_sold_date_sk join item on i_item_sk = {p}_item_sk select {x}, {p}_item_sk as k
        where i_manufact_id = 7 and d_date between date '1998-01-27' and date '1998-01-27' + 90),
      g as (from f select *, cast(1.3 as double) * (cast(sum({x}) over (partition by k) as double) / count(*) over (partition by k)) as bound)
      from g select {S(x)} as excess_discount_amount where cast({x} as double) > bound"""


def rebuys(select: str, sale: str, back: str, again: str, keys: str) -> str:
    return f"""from store_sales join store_returns on (sr_ticket_number, sr_item_sk, sr_customer_sk) = (ss_ticket_number, ss_item_sk, ss_customer_sk)
      join catalog_sales on (cs_bill_customer_sk, cs_item_sk) = (sr_customer_sk, sr_item_sk)
      join date_dim x on x.d_date_sk = ss_sold_date_sk join date_dim y on y.d_date_sk = sr_returned_date_sk join date_dim z on z.d_date_sk = cs_sold_date_sk
      join store on s_store_sk = ss_store_sk join item on i_item_sk = ss_item_sk
      select {keys}, {select} where {sale} and {back} and {again} group by {keys} {top(*keys.split(', '), limit=100)}"""


def spread(name: str, c: str) -> str:
    return f"""count({c}) as {name}_count, {A(c)} as {name}_ave, round(stddev_samp({c}), 6) as {name}_stdev,
      round(stddev_samp({c}) / {A(c)}, 6) as {name}_cov"""


K25 = "i_item_id, i_item_desc, s_store_id, s_store_name"


def worst(name: str, fact: str, p: str, order: str, back: str, q: str, r_order: str, amount: str) -> str:
    return f"""(from (from {fact} join {back} on {r_order} = {order} and {q}_item_sk = {p}_item_sk join date_dim on d_date_sk = {p}_sold_date_sk
        select {p}_item_sk as item, cast(sum({q}_return_quantity) as double) / cast(sum({p}_quantity) as double) as return_ratio,
          cast(sum({amount}) as double) / cast(sum({p}_net_paid) as double) as currency_ratio
        where {amount} > 500 and {p}_net_profit > 1 and {p}_net_paid > 0 and d_year = 1998 and d_moy = 12 group by 1)
      select '{name}' as channel, item, return_ratio, rank() over (order by return_ratio) as return_rank, rank() over (order by currency_ratio) as currency_rank
      qualify return_rank <= 10 or currency_rank <= 10)"""


K50 = "s_store_name, s_company_id, s_street_number, s_street_name, s_street_type, s_suite_number, s_city, s_county, s_state, s_zip"


def net75(fact: str, p: str, order: str, back: str, q: str, r_order: str, amount: str) -> str:
    return f"""(from {fact} join item on i_item_sk = {p}_item_sk join date_dim on d_date_sk = {p}_sold_date_sk
        left join {back} on {r_order} = {order} and {q}_item_sk = {p}_item_sk
      select d_year, i_brand_id, i_class_id, i_category_id, i_manufact_id, {p}_quantity - coalesce({q}_return_quantity, 0) as cnt,
        {p}_ext_sales_price - coalesce({amount}, 0) as amt where i_category = 'Books')"""


CH = [("store_sales", "ss", "ss_ticket_number", "store_returns", "sr", "sr_ticket_number", "sr_return_amt"),
      ("catalog_sales", "cs", "cs_order_number", "catalog_returns", "cr", "cr_order_number", "cr_return_amount"),
      ("web_sales", "ws", "ws_order_number", "web_returns", "wr", "wr_order_number", "wr_return_amt")]


def kept78(fact: str, p: str, cust: str, order: str, back: str, q: str, r_order: str) -> str:
    return f"""{p} as (from {fact} join date_dim on d_date_sk = {p}_sold_date_sk
      select {p}_item_sk as item, {cust} as cust, cast(sum({p}_quantity) as bigint) as qty, sum({p}_wholesale_cost) as wc, sum({p}_sales_price) as sp
      where d_year = 1998 and not exists (from {back} where {r_order} = {order} and {q}_item_sk = {p}_item_sk) group by 1, 2)"""


def back83(fact: str, p: str) -> str:
    return f"""{p} as (from {fact} join item on i_item_sk = {p}_item_sk join date_dim on d_date_sk = {p}_returned_date_sk
      select i_item_id as item_id, cast(sum({p}_return_quantity) as bigint) as {p}_item_qty
      where d_week_seq in (from date_dim select d_week_seq where d_year = 1998 and d_dom = 15) group by 1)"""


W83 = "(sr_item_qty + cr_item_qty + wr_item_qty)"
SQL = {
    "q01": f"""with {above('''from store_returns join date_dim on d_date_sk = sr_returned_date_sk select sr_customer_sk as ck, sr_store_sk as st, sum(sr_return_amt) as ctr
          where d_year = 1998 group by all having sum(sr_return_amt) > 60''', 'st')}
        from hi join store on s_store_sk = st join ds_customer on c_customer_sk = ck select c_customer_id where s_state = 'TN' {top('c_customer_id', limit=100)}""",
    "q30": f"with {above(state_totals('web_returns', 'wr', 'wr_return_amt'), 'st')} {LOCAL} select {C30} where ca_state = 'GA' {top(*C30.split(', '), limit=100)}",
    "q81": f"with {above(state_totals('catalog_returns', 'cr', 'cr_return_amount_inc_tax'), 'st')} {LOCAL} select {C81} where ca_state = 'GA' {top(*C81.split(', '), limit=100)}",
    "q16": shipped("catalog_sales", "cs", "1998-02-01", "GA", "join call_center on cc_call_center_sk = a.cs_call_center_sk",
                   f"cc_county = 'Williamson County' and {split('catalog_sales', 'cs')} and a.cs_order_number not in (from catalog_returns select cr_order_number)"),
    "q94": shipped("web_sales", "ws", "1999-02-01", "TX", "join web_site on web_site_sk = a.ws_web_site_sk",
                   f"web_company_name = 'pri' and {split('web_sales', 'ws')} and a.ws_order_number not in (from web_returns select wr_order_number)"),
    "q95": shipped("web_sales", "ws", "1999-02-01", "TX", "join web_site on web_site_sk = a.ws_web_site_sk",
                   f"web_company_name = 'pri' and {split('web_sales', 'ws')} and a.ws_order_number in (from web_returns select wr_order_number)"),
    "q32": excess("catalog_sales", "cs"),
    "q92": excess("web_sales", "ws"),
    "q17": rebuys(", ".join(spread(n, c) for n, c in (("store_sales", "ss_quantity"), ("store_returns", "sr_return_quantity"), ("catalog_sales", "cs_quantity"))),
                  "x.d_quarter_name = '1998Q1'", "y.d_year = 1998 and y.d_qoy <= 3", "z.d_year = 1998 and z.d_qoy <= 3", "i_item_id, i_item_desc, s_state"),
    "q25": rebuys(f"{S('ss_net_profit')} as store_sales_profit, {S('sr_net_loss')} as store_returns_loss, {S('cs_net_profit')} as catalog_sales_profit",
                  "x.d_year = 1998 and x.d_moy = 4", "y.d_year = 1998 and y.d_moy between 4 and 10", "z.d_year = 1998 and z.d_moy between 4 and 10", K25),
    "q29": rebuys("cast(sum(ss_quantity) as bigint) as store_sales_quantity, cast(sum(sr_return_quantity) as bigint) as store_returns_quantity, cast(sum(cs_quantity) as bigint) as catalog_sales_quantity",
                  "x.d_year = 1998 and x.d_moy = 4", "y.d_year = 1998 and y.d_moy between 4 and 7", "z.d_year in (1998, 1999, 2000)", K25),
    "q24": f"""with s as (from store_sales join store_returns on (sr_ticket_number, sr_item_sk) = (ss_ticket_number, ss_item_sk)
          join store on s_store_sk = ss_store_sk join ds_customer on c_customer_sk = ss_customer_sk join item on i_item_sk = ss_item_sk
          join customer_address on upper(ca_country) = c_birth_country and ca_zip = s_zip
          select c_last_name, c_first_name, s_store_name, i_color, sum(ss_net_paid) as netpaid where s_market_id = 3
          group by c_last_name, c_first_name, s_store_name, ca_state, s_state, i_color, i_current_price, i_manager_id, i_units, i_size)
        from s select c_last_name, c_first_name, s_store_name, {S('netpaid')} as paid where i_color = 'sienna' group by 1, 2, 3
        having {S('netpaid')} > (from s select cast(0.05 as double) * {A('netpaid')})""",
    "q40": f"""with f as (from catalog_sales left join catalog_returns on (cr_order_number, cr_item_sk) = (cs_order_number, cs_item_sk)
          select *, cs_sales_price - coalesce(cr_refunded_cash, 0) as net)
        from f join date_dim on d_date_sk = cs_sold_date_sk join item on i_item_sk = cs_item_sk join warehouse on w_warehouse_sk = cs_warehouse_sk
        select w_state, i_item_id, cast(coalesce(sum(net) filter (d_date < '1999-03-11'), 0) as double) as sales_before,
          cast(coalesce(sum(net) filter (d_date >= '1999-03-11'), 0) as double) as sales_after
        where d_date between date '1999-03-11' - 30 and date '1999-03-11' + 30 and i_current_price between 20 and 40 group by 1, 2
        {top('w_state', 'i_item_id', limit=100)}""",
    "q49": " union all ".join([
        worst("web", "web_sales", "ws", "ws_order_number", "web_returns", "wr", "wr_order_number", "wr_return_amt"),
        worst("catalog", "catalog_sales", "cs", "cs_order_number", "catalog_returns", "cr", "cr_order_number", "cr_return_amount"),
        worst("store", "store_sales", "ss", "ss_ticket_number", "store_returns", "sr", "sr_ticket_number", "sr_return_amt")])
        + " " + top("channel", "return_rank", "currency_rank", "item", "return_ratio", limit=100),
    "q50": f"""from store_sales join store_returns on (sr_ticket_number, sr_item_sk, sr_customer_sk) = (ss_ticket_number, ss_item_sk, ss_customer_sk)
        join store on s_store_sk = ss_store_sk join date_dim on d_date_sk = sr_returned_date_sk
        select {K50}, {days_between('sr_returned_date_sk', 'ss_sold_date_sk')} where d_year = 1998 and d_moy = 8
        group by {K50} {top(*K50.split(', '), limit=100)}""",
    "q93": f"""from store_sales join store_returns on (sr_ticket_number, sr_item_sk) = (ss_ticket_number, ss_item_sk)
        select ss_customer_sk, {S('(ss_quantity - sr_return_quantity) * ss_sales_price')} as sumsales where sr_reason_sk = 28 group by 1
        {top('sumsales', 'ss_customer_sk', limit=100)}""",
    "q75": f"""with d as ({' union '.join(net75(*c) for c in CH)}),
        y as (from d select d_year, i_brand_id, i_class_id, i_category_id, i_manufact_id, cast(sum(cnt) as bigint) as cnt, sum(amt) as amt group by 1, 2, 3, 4, 5)
        from y a join y b using (i_brand_id, i_class_id, i_category_id, i_manufact_id)
        select a.d_year as prev_year, b.d_year as year, i_brand_id, i_class_id, i_category_id, i_manufact_id, a.cnt as prev_yr_cnt, b.cnt as curr_yr_cnt,
          b.cnt - a.cnt as sales_cnt_diff, cast(b.amt - a.amt as double) as sales_amt_diff
        where a.d_year = 1998 and b.d_year = 1999 and cast(b.cnt as double) / nullif(cast(a.cnt as double), 0) < cast(0.9 as double)
        {top('sales_cnt_diff', 'sales_amt_diff', 'i_brand_id', 'i_class_id', 'i_category_id', 'i_manufact_id', limit=100)}""",
    "q78": f"""with {kept78('store_sales', 'ss', 'ss_customer_sk', 'ss_ticket_number', 'store_returns', 'sr', 'sr_ticket_number')},
        {kept78('web_sales', 'ws', 'ws_bill_customer_sk', 'ws_order_number', 'web_returns', 'wr', 'wr_order_number')},
        {kept78('catalog_sales', 'cs', 'cs_bill_customer_sk', 'cs_order_number', 'catalog_returns', 'cr', 'cr_order_number')}
        from ss left join ws using (item, cust) left join cs using (item, cust)
        select 1998 as ss_sold_year, item as ss_item_sk, cust as ss_customer_sk, ss.qty // coalesce(ws.qty + cs.qty, 1) as ratio,
          ss.qty as store_qty, cast(ss.wc as double) as store_wholesale_cost, cast(ss.sp as double) as store_sales_price,
          coalesce(ws.qty, 0) + coalesce(cs.qty, 0) as other_chan_qty, cast(coalesce(ws.wc, 0) + coalesce(cs.wc, 0) as double) as other_chan_wholesale_cost,
          cast(coalesce(ws.sp, 0) + coalesce(cs.sp, 0) as double) as other_chan_sales_price
        {top('ss_sold_year', 'ss_item_sk', 'ss_customer_sk', '-store_qty', limit=100)}""",
    "q83": f"""with {back83('store_returns', 'sr')}, {back83('catalog_returns', 'cr')}, {back83('web_returns', 'wr')}
        from sr join cr using (item_id) join wr using (item_id)
        select item_id, {', '.join(f"{p}_item_qty, cast({p}_item_qty as double) / cast({W83} as double) / cast(3.0 as double) * 100 as {p}_dev" for p in ('sr', 'cr', 'wr'))},
          {W83} / cast(3.0 as double) as average {top('item_id', 'sr_item_qty', limit=100)}""",
    "q85": f"""from web_sales join web_returns on (wr_item_sk, wr_order_number) = (ws_item_sk, ws_order_number)
        join date_dim on d_date_sk = ws_sold_date_sk join web_page on wp_web_page_sk = ws_web_page_sk join reason on r_reason_sk = wr_reason_sk
        join customer_demographics a on a.cd_demo_sk = wr_refunded_cdemo_sk join customer_demographics b on b.cd_demo_sk = wr_returning_cdemo_sk
        join customer_address on ca_address_sk = wr_refunded_addr_sk
        select left(r_reason_desc, 20) as reason, {A('ws_quantity')} as avg_quantity, {A('wr_refunded_cash')} as avg_cash, {A('wr_fee')} as avg_fee
        where d_year = 1998 and a.cd_marital_status = b.cd_marital_status and a.cd_education_status = b.cd_education_status
          and case a.cd_marital_status when 'M' then ws_sales_price between 100 and 150 when 'S' then ws_sales_price between 50 and 100
            when 'W' then ws_sales_price between 20 and 200 end
          and case when ca_state in ('OH', 'TX') then ws_net_profit between 0 and 2000 when ca_state in ('GA', 'KY', 'NM') then ws_net_profit between 150 and 3000
            when ca_state in ('CA', 'VA') then ws_net_profit between 50 and 2500 end
        group by r_reason_desc {top('reason', 'avg_quantity', 'avg_cash', 'avg_fee', limit=100)}""",
    "q64": f"""with ui as (from catalog_sales join catalog_returns on (cr_item_sk, cr_order_number) = (cs_item_sk, cs_order_number) select cs_item_sk as uk group by 1
          having sum(cs_ext_list_price) > 2 * sum(cr_refunded_cash + cr_reversed_charge + cr_store_credit)),
        x as (from store_sales join store_returns on (sr_item_sk, sr_ticket_number) = (ss_item_sk, ss_ticket_number) join ui on uk = ss_item_sk
          join item on i_item_sk = ss_item_sk join store on s_store_sk = ss_store_sk join promotion on p_promo_sk = ss_promo_sk
          join ds_customer on c_customer_sk = ss_customer_sk
          join customer_demographics m1 on m1.cd_demo_sk = ss_cdemo_sk join customer_demographics m2 on m2.cd_demo_sk = c_current_cdemo_sk
          join household_demographics h1 on h1.hd_demo_sk = ss_hdemo_sk join household_demographics h2 on h2.hd_demo_sk = c_current_hdemo_sk
          join income_band b1 on b1.ib_income_band_sk = h1.hd_income_band_sk join income_band b2 on b2.ib_income_band_sk = h2.hd_income_band_sk
          join customer_address b on b.ca_address_sk = ss_addr_sk join customer_address c on c.ca_address_sk = c_current_addr_sk
          join date_dim d1 on d1.d_date_sk = ss_sold_date_sk join date_dim d2 on d2.d_date_sk = c_first_sales_date_sk join date_dim d3 on d3.d_date_sk = c_first_shipto_date_sk
          select i_product_name, i_item_sk, s_store_name, s_zip,
            {', '.join(f'{p}.ca_{k} as {p}_{k}' for p in 'bc' for k in ('street_number', 'street_name', 'city', 'zip'))},
            d1.d_year as syear, d2.d_year as fy, d3.d_year as sy, count(*) as cnt, {S('ss_wholesale_cost')} as s1, {S('ss_list_price')} as s2, {S('ss_coupon_amt')} as s3
          where m1.cd_marital_status <> m2.cd_marital_status and i_color in ('purple', 'slate', 'medium', 'powder', 'brown', 'orange') and i_current_price between 1 and 90
          group by all)
        from x p join x q on (q.i_item_sk, q.s_store_name, q.s_zip) = (p.i_item_sk, p.s_store_name, p.s_zip) and q.cnt <= p.cnt
        select p.i_product_name, p.s_store_name, p.s_zip, {', '.join(f'p.{a}_{k}' for a in 'bc' for k in ('street_number', 'street_name', 'city', 'zip'))},
          p.syear, p.cnt, p.s1, p.s2, p.s3, q.s1 as s1_2, q.s2 as s2_2, q.s3 as s3_2, q.syear as syear_2, q.cnt as cnt_2
        where p.syear = 1999 and q.syear = 2000""",
}
SQL = {f"tpcds_{k}": with_tables(v) for k, v in SQL.items()}
