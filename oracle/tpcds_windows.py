from oracle.prelude import A, top, with_tables


def share(fact: str, p: str, limit: int | None) -> str:
    return f"""with r as (from {fact} join item on i_item_sk = {p}_item_sk join date_dim on d_date_sk = {p}_sold_date_sk
        select i_item_id, i_item_desc, i_category, i_class, i_current_price, sum({p}_ext_sales_price) as rev
        where i_category in ('Books', 'Home', 'Sports') and d_date between date '1999-02-22' and date '1999-02-22' + 30 group by all),
      s as (from r select *, cast(rev as double) * 100 / cast(sum(rev) over (partition by i_class) as double) as revenueratio),
      o as (from s {top('i_category', 'i_class', 'i_item_id', 'i_item_desc', 'revenueratio', 'i_current_price', limit=limit)})
      from o select i_item_desc, i_category, i_class, cast(i_current_price as double) as i_current_price, cast(rev as double) as itemrevenue, revenueratio"""


def usual(keys: str) -> str:
    return f"cast(sum(x) over (partition by {keys}) as double) / count(*) over (partition by {keys})"


STORE = "store_sales join date_dim on d_date_sk = ss_sold_date_sk join item on i_item_sk = ss_item_sk join store on s_store_sk = ss_store_sk"
MIX = """((i_category in ('Books', 'Children', 'Electronics') and i_class in ('personal', 'portable', 'reference'))
    or (i_category in ('Men', 'Music', 'Women') and i_class in ('accessories', 'classical', 'pants')))"""


def period(key: str, per: str, name: str, order: str) -> str:
    return f"""with g as (from {STORE} select {key}, {per}, sum(ss_sales_price) as x where d_year = 1998 and {MIX} group by all),
      a as (from g select {key}, cast(x as double) as sum_sales, {usual(key)} as {name})
      from a where abs(sum_sales - {name}) / nullif({name}, 0) > cast(0.1 as double) {order}"""


K89 = "i_category, i_class, i_brand, s_store_name, s_company_name, d_moy"


def near(body: str, keys: str, order: str) -> str:
    return f"""with g as ({body}),
      a as (from g select *, cast(x as double) as sum_sales, {usual(keys + ', d_year')} as avg_monthly_sales, row_number() over (partition by {keys} order by d_year, d_moy) as rn),
      o as (from a join a b on ({', '.join('b.' + k for k in keys.split(', '))}) = ({', '.join('a.' + k for k in keys.split(', '))}) and b.rn = a.rn - 1
        join a c on ({', '.join('c.' + k for k in keys.split(', '))}) = ({', '.join('a.' + k for k in keys.split(', '))}) and c.rn = a.rn + 1
        select {', '.join('a.' + k for k in keys.split(', '))}, a.d_year, a.d_moy, a.avg_monthly_sales, a.sum_sales, b.sum_sales as psum, c.sum_sales as nsum,
          a.sum_sales - a.avg_monthly_sales as gap
        where a.d_year = 1998 and a.avg_monthly_sales > 0 and abs(a.sum_sales - a.avg_monthly_sales) / a.avg_monthly_sales > cast(0.1 as double))
      from o select * exclude (gap) {order}"""


P44 = "(from store_sales select ss_item_sk as k, {A} as p where ss_store_sk = 7 group by 1 having {A} > (from store_sales select cast(0.9 as double) * {A} where ss_store_sk = 7 and ss_addr_sk is null))".replace(
    "{A}", A("ss_net_profit"))
R = "over (partition by item_sk order by d_date)"


def cume(fact: str, p: str) -> str:
    return f"""(from (from {fact} join date_dim on d_date_sk = {p}_sold_date_sk select {p}_item_sk as item_sk, d_date, sum({p}_sales_price) as s where d_year = 1998 group by all)
      select item_sk, d_date, sum(s) {R} as c)"""


Q51 = f"""with b as (from {cume('web_sales', 'ws')} w full join {cume('store_sales', 'ss')} s using (item_sk, d_date) select item_sk, d_date, w.c as w, s.c as s),
  m as (from b select item_sk, d_date, cast(w as double) as web_sales, cast(s as double) as store_sales,
    cast(max(w) {R} as double) as web_cumulative, cast(max(s) {R} as double) as store_cumulative)
  from m where web_cumulative > store_cumulative {top('item_sk', 'd_date', limit=100)}"""
SQL = {
    "q12": share("web_sales", "ws", 100), "q20": share("catalog_sales", "cs", 100), "q98": share("store_sales", "ss", None),
    "q53": period("i_manufact_id", "d_qoy", "avg_quarterly_sales", top("avg_quarterly_sales", "sum_sales", "i_manufact_id", limit=100)),
    "q63": period("i_manager_id", "d_moy", "avg_monthly_sales", top("i_manager_id", "avg_monthly_sales", "sum_sales", limit=100)),
    "q89": f"""with g as (from {STORE} select {K89}, sum(ss_sales_price) as x where d_year = 1998
          and ((i_category in ('Books', 'Electronics', 'Sports') and i_class in ('football', 'personal', 'stereo'))
            or (i_category in ('Jewelry', 'Men', 'Women') and i_class in ('dresses', 'pants', 'shirts'))) group by all),
        a as (from g select {K89}, cast(x as double) as sum_sales, {usual('i_category, i_brand, s_store_name, s_company_name')} as avg_monthly_sales)
        from a where abs(sum_sales - avg_monthly_sales) / nullif(avg_monthly_sales, 0) > cast(0.1 as double)
        order by sum_sales - avg_monthly_sales, s_store_name, i_category, i_class, i_brand, d_moy limit 100""",
    "q47": near(f"from {STORE} select i_category, i_brand, s_store_name, s_company_name, d_year, d_moy, sum(ss_sales_price) as x where d_year = 1998 and i_brand_id <= 1010 group by all",
                "i_category, i_brand, s_store_name, s_company_name", top("gap", "s_store_name", "i_category", "i_brand", "s_company_name", "d_moy", limit=100)),
    "q57": near("""from catalog_sales join date_dim on d_date_sk = cs_sold_date_sk join item on i_item_sk = cs_item_sk join call_center on cc_call_center_sk = cs_call_center_sk
          select i_category, i_brand, cc_name, d_year, d_moy, sum(cs_sales_price) as x where d_date between '1997-12-01' and '1999-01-31' group by all""",
                "i_category, i_brand, cc_name", top("gap", "cc_name", "i_category", "i_brand", "d_moy", limit=100)),
    "q44": f"""with p as (from {P44}), a as (from p select k, rank() over (order by p) as rnk), b as (from p select k, rank() over (order by p desc) as rnk)
        from a join b using (rnk) join item x on x.i_item_sk = a.k join item y on y.i_item_sk = b.k
        select rnk, x.i_product_name as best_performing, y.i_product_name as worst_performing where rnk <= 10 {top('rnk', 'best_performing', 'worst_performing', limit=100)}""",
    "q51": Q51, "q51a": Q51,
}
SQL = {f"tpcds_{k}": with_tables(v) for k, v in SQL.items()}
