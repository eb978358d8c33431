from oracle.prelude import A, S, top, with_tables


def tickets(days: str, least: float, low: int, high: int) -> str:
    return f"""from (from store_sales join date_dim on d_date_sk = ss_sold_date_sk join store on s_store_sk = ss_store_sk
          join household_demographics on hd_demo_sk = ss_hdemo_sk select ss_ticket_number, ss_customer_sk, count(*) as cnt
          where {days} and d_year in (1997, 1998, 1999) and hd_buy_potential in ('>10000', 'Unknown') and s_county = 'Williamson County'
            and hd_vehicle_count > 0 and hd_dep_count // hd_vehicle_count > {least} group by all)
        join ds_customer on c_customer_sk = ss_customer_sk
        select c_last_name, c_first_name, c_salutation, c_preferred_cust_flag, ss_ticket_number, cnt where cnt between {low} and {high}"""


def away(days: str, homes: str, cities: str, sums: dict, order: str) -> str:
    cols = ", ".join(f"{S(c)} as {n}" for n, c in sums.items())
    return f"""from (from store_sales join date_dim on d_date_sk = ss_sold_date_sk join store on s_store_sk = ss_store_sk
          join household_demographics on hd_demo_sk = ss_hdemo_sk join customer_address on ca_address_sk = ss_addr_sk
          select ss_ticket_number, ss_customer_sk, ss_addr_sk, ca_city as bought_city, {cols}
          where {days} and d_year in (1997, 1998, 1999) and ({homes}) and s_city in ({cities}) group by 1, 2, 3, 4)
        join ds_customer on c_customer_sk = ss_customer_sk join customer_address on ca_address_sk = c_current_addr_sk
        select c_last_name, c_first_name, ca_city, bought_city, ss_ticket_number, {', '.join(sums)} where ca_city <> bought_city {order}"""


def bought(fact: str, key: str, date: str, days: str) -> str:
    return f"exists (from {fact} join date_dim on d_date_sk = {date} where {key} = c_customer_sk and {days})"


def persons(keys: str, stats: str, where: str, days: str, other: str, order: str) -> str:
    web = bought("web_sales", "ws_bill_customer_sk", "ws_sold_date_sk", days)
    cat = bought("catalog_sales", "cs_ship_customer_sk", "cs_sold_date_sk", days)
    test = f"({web} or {cat})" if other == "some" else f"(not {web} and not {cat})"
    return f"""from ds_customer join customer_address on ca_address_sk = c_current_addr_sk join customer_demographics on cd_demo_sk = c_current_cdemo_sk
        select {keys}, {stats} where {where} and {bought('store_sales', 'ss_customer_sk', 'ss_sold_date_sk', days)} and {test}
        group by {keys} {order}"""


def who(fact: str, key: str, date: str) -> str:
    return f"""(from {fact} join date_dim on d_date_sk = {date} join ds_customer on c_customer_sk = {key}
        select distinct c_last_name, c_first_name, d_date where d_year = 1998)"""


THREE = [who("store_sales", "ss_customer_sk", "ss_sold_date_sk"), who("catalog_sales", "cs_bill_customer_sk", "cs_sold_date_sk"),
         who("web_sales", "ws_bill_customer_sk", "ws_sold_date_sk")]
K10 = "cd_gender, cd_marital_status, cd_education_status, cd_purchase_estimate, cd_credit_rating, cd_dep_count, cd_dep_employed_count, cd_dep_college_count"
K35 = "ca_state, cd_gender, cd_marital_status, cd_dep_count, cd_dep_employed_count, cd_dep_college_count"
K69 = "cd_gender, cd_marital_status, cd_education_status, cd_purchase_estimate, cd_credit_rating"
ST35 = ", ".join(f"min(cd_{c}) as min_{c}, max(cd_{c}) as max_{c}, {A('cd_' + c)} as avg_{c}" for c in ("dep_count", "dep_employed_count", "dep_college_count"))
HOMES = "hd_dep_count = 4 or hd_vehicle_count = 3"


def spend23(fact: str, p: str) -> str:
    return f"""(from {fact} join date_dim on d_date_sk = {p}_sold_date_sk join ds_customer on c_customer_sk = {p}_bill_customer_sk
        select c_last_name, c_first_name, {S(f'{p}_quantity * {p}_list_price')} as sales
        where d_year = 1998 and d_moy = 3 and {p}_item_sk in (from frequent select item_sk) and {p}_bill_customer_sk in (from rich select sk) group by all)"""


SQL = {
    "q34": tickets("(d_dom <= 3 or d_dom between 25 and 28)", 1.2, 1, 20),
    "q73": tickets("d_dom <= 2", 1, 1, 5),
    "q46": away("d_dow in (0, 6)", HOMES, "'Fairview', 'Midway', 'Salem'", {"amt": "ss_coupon_amt", "profit": "ss_net_profit"},
                top("c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number", "profit", limit=100)),
    "q68": away("d_dom <= 2", HOMES, "'Fairview', 'Midway'",
                {"extended_price": "ss_ext_sales_price", "list_price": "ss_ext_list_price", "extended_tax": "ss_ext_tax"},
                top("c_last_name", "ss_ticket_number", "extended_price", limit=100)),
    "q79": f"""from (from store_sales join date_dim on d_date_sk = ss_sold_date_sk join store on s_store_sk = ss_store_sk
          join household_demographics on hd_demo_sk = ss_hdemo_sk
          select ss_ticket_number, ss_customer_sk, ss_addr_sk, s_city, {S('ss_coupon_amt')} as amt, {S('ss_net_profit')} as profit
          where (hd_dep_count = 6 or hd_vehicle_count > 2) and d_dow = 1 and d_year in (1997, 1998, 1999)
            and s_number_employees between 200 and 295 group by 1, 2, 3, 4)
        join ds_customer on c_customer_sk = ss_customer_sk
        select c_last_name, c_first_name, left(s_city, 30) as city, ss_ticket_number, amt, profit
        {top('c_last_name', 'c_first_name', 'city', 'profit', 'ss_ticket_number', 'amt', limit=100)}""",
    "q10": persons(K10, ", ".join(f"count(*) as cnt{i}" for i in range(1, 7)), "ca_county in ('Williamson County', 'Toole County', 'Walker County')",
                   "d_year = 1998 and d_moy <= 4", "some", top(*K10.split(", "), limit=100)),
    "q35": persons(K35, f"count(*) as cnt1, count(*) as cnt2, count(*) as cnt3, {ST35}", "true", "d_year = 1998 and d_qoy < 4", "some",
                   top(*K35.split(", "), limit=100)),
    "q69": persons(K69, "count(*) as cnt1, count(*) as cnt2, count(*) as cnt3", "ca_state in ('GA', 'KY', 'NM')",
                   "d_year = 1998 and d_qoy = 2", "none", top(*K69.split(", "), limit=100)),
    "q38": f"select count(*) as n from ({' intersect '.join(THREE)})",
    "q87": f"select count(*) as n from ({' except '.join(THREE)})",
    "q97": """with s as (from store_sales join date_dim on d_date_sk = ss_sold_date_sk select distinct ss_customer_sk as c, ss_item_sk as i where d_year = 1998),
        k as (from catalog_sales join date_dim on d_date_sk = cs_sold_date_sk select distinct cs_bill_customer_sk as c, cs_item_sk as i where d_year = 1998)
        from s full join k on (s.c, s.i) = (k.c, k.i)
        select count(*) filter (k.c is null) as store_only, count(*) filter (s.c is null) as catalog_only, count(*) filter (s.c is not null and k.c is not null) as store_and_catalog""",
    "q08": f"""with z as ((from customer_address select left(ca_zip, 5) as zip where (cast(zip as int) - 10000) % 74 = 0 and cast(zip as int) < 17400)
          intersect (from ds_customer join customer_address on ca_address_sk = c_current_addr_sk select left(ca_zip, 5)
            where c_preferred_cust_flag = 'Y' group by 1 having count(*) > 2))
        from store_sales join date_dim on d_date_sk = ss_sold_date_sk join store on s_store_sk = ss_store_sk join z on left(zip, 2) = left(s_zip, 2)
        select s_store_name, {S('ss_net_profit')} as net_profit where d_quarter_name = '1998Q2' group by all {top('s_store_name', limit=100)}""",
    "q65": f"""with r as (from store_sales join date_dim on d_date_sk = ss_sold_date_sk select ss_store_sk, ss_item_sk, sum(ss_sales_price) as r
          where d_year = 1998 and ss_store_sk is not null group by all),
        b as (from r select *, cast(0.1 as double) * (cast(sum(r) over w as double) / count(*) over w) as bound window w as (partition by ss_store_sk))
        from b join store on s_store_sk = ss_store_sk join item on i_item_sk = ss_item_sk
        select s_store_name, i_item_desc, cast(r as double) as revenue where cast(r as double) <= bound
        {top('s_store_name', 'i_item_desc', 'revenue', limit=100)}""",
    "q23": f"""with frequent as (from store_sales join date_dim on d_date_sk = ss_sold_date_sk select ss_item_sk as item_sk, d_date
          where d_year between 1998 and 2001 group by all having count(*) > 0),
        spent as (from store_sales join date_dim on d_date_sk = ss_sold_date_sk select ss_customer_sk as sk, {S('ss_quantity * ss_sales_price')} as s
          where d_year between 1998 and 2001 group by 1),
        rich as (from store_sales select ss_customer_sk as sk group by 1
          having {S('ss_quantity * ss_sales_price')} > cast(0.5 as double) * (from spent select max(s)))
        {spend23('catalog_sales', 'cs')} union all {spend23('web_sales', 'ws')} {top('c_last_name', 'c_first_name', 'sales', limit=100)}""",
    "q54": f"""with f as (from catalog_sales select cs_sold_date_sk as dk, cs_bill_customer_sk as ck union all from web_sales select ws_sold_date_sk, ws_bill_customer_sk),
        mine as (from f join date_dim on d_date_sk = dk join ds_customer on c_customer_sk = ck select distinct c_customer_sk, c_current_addr_sk where d_year = 1998 and d_moy = 5),
        rev as (from mine join customer_address on ca_address_sk = c_current_addr_sk join store on (s_county, s_state) = (ca_county, ca_state)
          join store_sales on ss_customer_sk = c_customer_sk join date_dim on d_date_sk = ss_sold_date_sk
          select c_customer_sk, {S('ss_ext_sales_price')} as r group by 1)
        from rev select cast(round(r / 50) as int) as segment, count(*) as num_customers, cast(round(r / 50) as int) * 50 as segment_base group by 1, 3
        {top('segment', 'num_customers', limit=100)}""",
}
SQL = {f"tpcds_{k}": with_tables(v) for k, v in SQL.items()}
