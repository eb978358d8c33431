from oracle.prelude import A, S, top, with_tables

DAYS = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]


def weekday_sums(c: str) -> str:
    return ", ".join(f"sum({c}) filter (d_dow = {i}) as {d}" for i, d in enumerate(DAYS))


def rate(a: str, b: str) -> str:
    return f"cast({a} as double) / nullif(cast({b} as double), 0)"


ALL = """f as (from store_sales select 'store' as ch, ss_sold_date_sk as dk, ss_item_sk as ik, ss_customer_sk as ck, ss_addr_sk as ak, ss_quantity as q, ss_list_price as lp, ss_ext_sales_price as x
    union all from catalog_sales select 'catalog', cs_sold_date_sk, cs_item_sk, cs_bill_customer_sk, cs_bill_addr_sk, cs_quantity, cs_list_price, cs_ext_sales_price
    union all from web_sales select 'web', ws_sold_date_sk, ws_item_sk, ws_bill_customer_sk, ws_bill_addr_sk, ws_quantity, ws_list_price, ws_ext_sales_price)"""
FD = "f join date_dim on d_date_sk = dk"


def growth(value: str, people: str, cols: str) -> str:
    def tot(fact: str, p: str, cust: str, y: int) -> str:
        v = value.replace("@", p)
        return f"(from {fact} join date_dim on d_date_sk = {p}_sold_date_sk select {cust} as c, sum({v}) as v where d_year = {y} group by 1)"
    s = [tot("store_sales", "ss", "ss_customer_sk", y) for y in (1998, 1999)]
    w = [tot("web_sales", "ws", "ws_bill_customer_sk", y) for y in (1998, 1999)]
    return f"""from {s[0]} s1 join {s[1]} s2 using (c) join {w[0]} w1 using (c) join {w[1]} w2 using (c) join ds_customer on c_customer_sk = c
      select {cols} where {people} and s1.v > 0 and w1.v > 0 and {rate('w2.v', 'w1.v')} > {rate('s2.v', 's1.v')} {top(*cols.split(', '), limit=100)}"""


P6 = "c_customer_id, c_first_name, c_last_name, c_preferred_cust_flag, c_birth_country, c_login"


def quarter(n: str, q: int) -> str:
    return f"(from {FD} join customer_address on ca_address_sk = ak select ca_county, sum(x) as v where ch = '{n}' and d_year = 1999 and d_qoy = {q} group by 1)"


def everywhere(key: str, chosen: str, month: int, order: str) -> str:
    return f"""with {ALL} from {FD} join item on i_item_sk = ik join customer_address on ca_address_sk = ak select {key}, {S('x')} as total_sales
      where {key} in (from item select {key} where {chosen}) and d_year = 1998 and d_moy = {month} and ca_gmt_offset = -5 group by 1 {order}"""


KIND = "i_brand_id, i_class_id, i_category_id"


def sold14(ch: str) -> str:
    return f"(from {FD} join item on i_item_sk = ik select {KIND} where ch = '{ch}' and d_year in (1997, 1998, 1999))"


CROSS = f"""{ALL}, kinds as ({sold14('store')} intersect {sold14('catalog')} intersect {sold14('web')}),
  usual as (from {FD} select {A('q * lp')} as u where d_year in (1997, 1998, 1999)),
  g as (from {FD} join item on i_item_sk = ik select * where ({KIND}) in (from kinds select ({KIND})))"""


def dec14(year: int) -> str:
    return f"""(from g select {KIND}, {S('q * lp')} as sales, count(*) as number_sales
      where ch = 'store' and d_week_seq - (from date_dim select d_week_seq where d_date = '{year}-12-08') between -7 and 0
      group by all having {S('q * lp')} > (from usual select u))"""


def flows(store: str, page: str, site: str) -> str:
    return f"""select 'store channel' as channel, 'store' || s_store_id as id, {store}
      union all select 'catalog channel', 'catalog_page' || cp_catalog_page_id, {page}
      union all select 'web channel', 'web_site' || web_site_id, {site}"""


SPAN = "d_date between date '1998-08-23' and date '1998-08-23' + {n}"


def flow(name: str, key: str, date: str, src: str, cols: str, n: int, outlet: str) -> str:
    return f"(from {src} join date_dim on d_date_sk = {date} join {outlet} select '{name} channel' as channel, {key} as id, {cols} where {SPAN.format(n=n)})"


def money(s: str, r: str, p: str) -> str:
    return f"cast({s} as decimal(15,2)) as sales, cast({r} as decimal(15,2)) as returns, cast({p} as decimal(15,2)) as profit"


F05 = " union all ".join([
    flow("store", "'store' || s_store_id", "ss_sold_date_sk", "store_sales", money("ss_ext_sales_price", "0", "ss_net_profit"), 14, "store on s_store_sk = ss_store_sk"),
    flow("store", "'store' || s_store_id", "sr_returned_date_sk", "store_returns", money("0", "sr_return_amt", "-sr_net_loss"), 14, "store on s_store_sk = sr_store_sk"),
    flow("catalog", "'catalog_page' || cp_catalog_page_id", "cs_sold_date_sk", "catalog_sales", money("cs_ext_sales_price", "0", "cs_net_profit"), 14, "catalog_page on cp_catalog_page_sk = cs_catalog_page_sk"),
    flow("catalog", "'catalog_page' || cp_catalog_page_id", "cr_returned_date_sk", "catalog_returns", money("0", "cr_return_amount", "-cr_net_loss"), 14, "catalog_page on cp_catalog_page_sk = cr_catalog_page_sk"),
    flow("web", "'web_site' || web_site_id", "ws_sold_date_sk", "web_sales", money("ws_ext_sales_price", "0", "ws_net_profit"), 14, "web_site on web_site_sk = ws_web_site_sk"),
    flow("web", "'web_site' || web_site_id", "wr_returned_date_sk", "web_returns left join web_sales on (ws_item_sk, ws_order_number) = (wr_item_sk, wr_order_number)",
         money("0", "wr_return_amt", "-wr_net_loss"), 14, "web_site on web_site_sk = ws_web_site_sk"),
])


def f80(name: str, key: str, fact: str, p: str, order: str, back: str, q: str, r_order: str, amount: str, outlet: str) -> str:
    src = f"{fact} left join {back} on ({q}_item_sk, {r_order}) = ({p}_item_sk, {order}) join item on i_item_sk = {p}_item_sk and i_current_price > 50 join promotion on p_promo_sk = {p}_promo_sk and p_channel_tv = 'N'"
    return flow(name, key, f"{p}_sold_date_sk", src, money(f"{p}_ext_sales_price", f"coalesce({amount}, 0)", f"{p}_net_profit - coalesce({q}_net_loss, 0)"), 30, outlet)


F80 = " union all ".join([
    f80("store", "'store' || s_store_id", "store_sales", "ss", "ss_ticket_number", "store_returns", "sr", "sr_ticket_number", "sr_return_amt", "store on s_store_sk = ss_store_sk"),
    f80("catalog", "'catalog_page' || cp_catalog_page_id", "catalog_sales", "cs", "cs_order_number", "catalog_returns", "cr", "cr_order_number", "cr_return_amount", "catalog_page on cp_catalog_page_sk = cs_catalog_page_sk"),
    f80("web", "'web_site' || web_site_id", "web_sales", "ws", "ws_order_number", "web_returns", "wr", "wr_order_number", "wr_return_amt", "web_site on web_site_sk = ws_web_site_sk"),
])


def sums77(key: str, date: str, src: str, a: str, b: str, outlet: str = "") -> str:
    return f"(from {src} join date_dim on d_date_sk = {date} {outlet} select {key} as id, sum({a}) as a, sum({b}) as b where {SPAN.format(n=30)} group by 1)"


F77 = f"""(from {sums77('ss_store_sk', 'ss_sold_date_sk', 'store_sales', 'ss_ext_sales_price', 'ss_net_profit', 'join store on s_store_sk = ss_store_sk')} s
    left join {sums77('sr_store_sk', 'sr_returned_date_sk', 'store_returns', 'sr_return_amt', 'sr_net_loss')} r using (id)
    select 'store channel' as channel, id, {money('s.a', 'coalesce(r.a, 0)', 's.b - coalesce(r.b, 0)')})
  union all (from {sums77('cs_call_center_sk', 'cs_sold_date_sk', 'catalog_sales', 'cs_ext_sales_price', 'cs_net_profit')} s,
    {sums77('1', 'cr_returned_date_sk', 'catalog_returns', 'cr_return_amount', 'cr_net_loss')} r
    select 'catalog channel', s.id, {money('s.a', 'r.a', 's.b - r.b')})
  union all (from {sums77('ws_web_page_sk', 'ws_sold_date_sk', 'web_sales', 'ws_ext_sales_price', 'ws_net_profit', 'join web_page on wp_web_page_sk = ws_web_page_sk')} s
    left join {sums77('wr_web_page_sk', 'wr_returned_date_sk', 'web_returns', 'wr_return_amt', 'wr_net_loss')} r using (id)
    select 'web channel', id, {money('s.a', 'coalesce(r.a, 0)', 's.b - coalesce(r.b, 0)')})"""


def outlets(body: str, group: str) -> str:
    return f"""with flows as ({body}) from flows select channel, id, {S('sales')} as sales, {S('returns')} as returns, {S('profit')} as profit
      group by {group} {top('channel', 'id', limit=100)}"""


B58 = " and ".join(f"{a} between cast(0.3 as double) * {b} and cast(1.7 as double) * {b}" for a in ("ss", "cs", "ws") for b in ("ss", "cs", "ws") if a != b)
SQL = {
    "q02": f"""with {ALL}, w as (from {FD} select d_week_seq as wk, {weekday_sums('x')} where ch <> 'store' group by 1)
        from w a join w b on b.wk = a.wk + 53 join date_dim p on p.d_week_seq = a.wk and p.d_year = 1998 join date_dim q on q.d_week_seq = b.wk and q.d_year = 1999
        select a.wk as d_week_seq1, {', '.join(f"round({rate('a.' + d, 'b.' + d)}, 2) as {d}_ratio" for d in DAYS)}""",
    "q59": f"""with w as (from store_sales join date_dim on d_date_sk = ss_sold_date_sk join store on s_store_sk = ss_store_sk
          select d_week_seq as wk, s_store_sk, s_store_id, s_store_name, {weekday_sums('ss_sales_price')} group by 1, 2, 3, 4)
        from w a join w b on b.wk = a.wk + 52 and b.s_store_id = a.s_store_id
          join date_dim p on p.d_week_seq = a.wk and p.d_year = 1998 join date_dim q on q.d_week_seq = b.wk and q.d_year = 1999
        select a.s_store_name as s_store_name1, a.s_store_id as s_store_id1, a.wk as d_week_seq1,
          {', '.join(f"{rate('a.' + d, ('a.' if d == 'tue' else 'b.') + d)} as {d}_ratio" for d in DAYS)}
        {top('s_store_name1', 's_store_id1', 'd_week_seq1', *[f'{d}_ratio' for d in DAYS], limit=100)}""",
    "q11": growth("@_ext_list_price - @_ext_discount_amt", "true", P6),
    "q74": growth("@_net_paid", "c_salutation = 'Mr.'", "c_customer_id, c_first_name, c_last_name"),
    "q04": f"""with {ALL}, y as (from {FD} select distinct ch, ck, d_year where d_year in (1998, 1999) and q between 10 and 29 and ch <> 'web')
        from y a join y b on b.ck = a.ck and b.ch = a.ch join y c on c.ck = a.ck join y d on d.ck = a.ck and d.ch = c.ch join ds_customer on c_customer_sk = a.ck
        select {P6} where a.ch = 'store' and c.ch = 'catalog' {top(*P6.split(', '), limit=200)}""",
    "q31": f"""with {ALL} from {quarter('store', 1)} s1 join {quarter('store', 2)} s2 using (ca_county) join {quarter('store', 3)} s3 using (ca_county)
          join {quarter('web', 1)} w1 using (ca_county) join {quarter('web', 2)} w2 using (ca_county) join {quarter('web', 3)} w3 using (ca_county)
        select ca_county, 1999 as d_year, {rate('w2.v', 'w1.v')} as web_q1_q2_increase, {rate('s2.v', 's1.v')} as store_q1_q2_increase,
          {rate('w3.v', 'w2.v')} as web_q2_q3_increase, {rate('s3.v', 's2.v')} as store_q2_q3_increase
        where web_q1_q2_increase > store_q1_q2_increase and web_q2_q3_increase > store_q2_q3_increase""",
    "q33": everywhere("i_manufact_id", "i_category = 'Electronics'", 5, top("total_sales", "i_manufact_id", limit=100)),
    "q56": everywhere("i_item_id", "i_color in ('slate', 'sienna', 'purple')", 2, top("total_sales", "i_item_id", limit=100)),
    "q60": everywhere("i_item_id", "i_category = 'Music'", 9, top("i_item_id", "total_sales", limit=100)),
    "q58": f"""with {ALL}, p as (pivot (from {FD} join item on i_item_sk = ik select i_item_id as item_id, ch, x
            where d_week_seq - (from date_dim select d_week_seq where d_date = '1998-01-05') between 0 and 25)
          on ch in ('store', 'catalog', 'web') using sum(x) group by item_id),
        r as (from p select item_id, cast(store as double) as ss, cast(catalog as double) as cs, cast(web as double) as ws)
        from r select item_id, {', '.join(f'{p} as {p}_item_rev, {p} / (ss + cs + ws) / cast(3 as double) * cast(100 as double) as {p}_dev' for p in ('ss', 'cs', 'ws'))},
          (ss + cs + ws) / cast(3 as double) as average where {B58} {top('item_id', 'ss_item_rev', limit=100)}""",
    "q14a": f"""with {CROSS}, r as (from g select ch as channel, {KIND}, sum(q * lp) as s, count(*) as n where d_year = 1999 and d_moy = 11 group by all
          having {S('q * lp')} > (from usual select u))
        from r select channel, {KIND}, {S('s')} as sum_sales, cast(sum(n) as bigint) as number_sales group by rollup (channel, {KIND})
        {top('channel', *KIND.split(', '), limit=100)}""",
    "q14b": f"""with {CROSS} from {dec14(1998)} a join {dec14(1997)} b using ({KIND})
        select {KIND}, a.sales, a.number_sales, b.sales as last_sales, b.number_sales as last_number_sales {top(*KIND.split(', '), limit=100)}""",
    "q05": outlets(F05, "channel, id"), "q05a": outlets(F05, "rollup (channel, id)"),
    "q80": outlets(F80, "channel, id"), "q80a": outlets(F80, "rollup (channel, id)"),
    "q77": outlets(F77, "channel, id"), "q77a": outlets(F77, "rollup (channel, id)"),
}
SQL = {f"tpcds_{k}": with_tables(v) for k, v in SQL.items()}
