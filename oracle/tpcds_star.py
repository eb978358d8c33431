from oracle.prelude import A, S, top, with_tables

SSD = "store_sales join date_dim on d_date_sk = ss_sold_date_sk"
SSDI = SSD + " join item on i_item_sk = ss_item_sk"
DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def brand(where: str, limit: str, year: str = "d_year, ") -> str:
    return f"from {SSDI} select {year}i_brand_id, i_brand, {S('ss_ext_sales_price')} as ext_price where {where} group by all {limit}"


def promoted(fact: str, p: str, demo: str) -> str:
    return f"""from {fact} join date_dim on d_date_sk = {p}_sold_date_sk join customer_demographics on cd_demo_sk = {demo}
        join promotion on p_promo_sk = {p}_promo_sk join item on i_item_sk = {p}_item_sk
        select i_item_id, {A(p + '_quantity')} as agg1, {A(p + '_list_price')} as agg2, {A(p + '_coupon_amt')} as agg3, {A(p + '_sales_price')} as agg4
        where (cd_gender, cd_marital_status, cd_education_status) = ('M', 'S', 'College') and 'N' in (p_channel_email, p_channel_event)
          and d_year = 1998 group by all {top('i_item_id', limit=100)}"""


PLACES = """((ca_state in ('OH', 'TX') and ss_net_profit between 100 and 2000) or (ca_state in ('GA', 'KY', 'NM') and ss_net_profit between 150 and 3000)
    or (ca_state in ('TN', 'TX', 'VA') and ss_net_profit between 50 and 2500))"""
ZIPS = "('10000', '10370', '11110', '12220', '13330', '14440', '15550', '16660', '10555')"


def days_between(a: str, b: str) -> str:
    gap = f"{a} - {b}"
    return f"""count(*) filter ({gap} <= 30) as days_30, count(*) filter ({gap} between 31 and 60) as days_31_60, count(*) filter ({gap} between 61 and 90) as days_61_90,
        count(*) filter ({gap} between 91 and 120) as days_91_120, count(*) filter ({gap} > 120) as days_over_120"""


def shipping(fact: str, p: str, outlet: str, on: str, name: str) -> str:
    keys = f"left(w_warehouse_name, 20) as warehouse, sm_type, {name}"
    return f"""from {fact} join date_dim on d_date_sk = {p}_ship_date_sk join ship_mode on sm_ship_mode_sk = {p}_ship_mode_sk
        join warehouse on w_warehouse_sk = {p}_warehouse_sk join {outlet} on {on}
        select {keys}, {days_between(p + '_ship_date_sk', p + '_sold_date_sk')} where d_year = 1998 group by 1, 2, 3
        {top('warehouse', 'sm_type', name, limit=100)}"""


HOMES = "((hd_dep_count = 0 and hd_vehicle_count <= 2) or (hd_dep_count = 2 and hd_vehicle_count <= 4) or (hd_dep_count = 4 and hd_vehicle_count <= 6))"
TIMED = """store_sales join time_dim on t_time_sk = ss_sold_time_sk join household_demographics on hd_demo_sk = ss_hdemo_sk
    join store on s_store_sk = ss_store_sk"""


def slot(k: int) -> str:
    start = 510 + 30 * k
    h, m = divmod(start, 60)
    return f"count(*) filter (t_hour * 60 + t_minute between {start} and {start + 29}) as h{h}_{m:02d}"


def band9(i: int, low: int, high: int, least: int) -> str:
    def avg(c: str) -> str:
        return f"(from store_sales select {A(c)} where ss_quantity between {low} and {high})"
    return f"if((from store_sales select count(*) where ss_quantity between {low} and {high}) > {least}, {avg('ss_ext_discount_amt')}, {avg('ss_net_paid')}) as bucket{i}"


def band28(i: int, low: int, high: int, price: int, coupon: int, cost: int) -> str:
    return f"""(from store_sales select {A('ss_list_price')} as b{i}_lp, count(ss_list_price) as b{i}_cnt, count(distinct ss_list_price) as b{i}_cntd
      where ss_quantity between {low} and {high} and (ss_list_price between {price} and {price + 10}
        or ss_coupon_amt between {coupon} and {coupon + 1000} or ss_wholesale_cost between {cost} and {cost + 20}))"""


COMBO = """(i_category = 'Women' and ((i_color in ('powder', 'khaki') and i_units in ('Ounce', 'Oz') and i_size in ('medium', 'extra large'))
      or (i_color in ('brown', 'honeydew') and i_units in ('Bunch', 'Ton') and i_size in ('N/A', 'small'))
      or (i_color in ('slate', 'sienna') and i_units in ('Pound', 'Each') and i_size in ('medium', 'extra large'))))
    or (i_category = 'Men' and ((i_color in ('orange', 'frosted') and i_units in ('Dozen', 'Box') and i_size in ('petite', 'large'))
      or (i_color in ('slate', 'medium') and i_units in ('Box', 'Pound') and i_size in ('medium', 'extra large'))
      or (i_color in ('purple', 'medium') and i_units in ('Each', 'Ounce') and i_size in ('petite', 'large'))))"""
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def month_cols(kind: str, ws: str, cs: str) -> str:
    return ", ".join(f"cast(coalesce(sum({kind}) filter (d_moy = {i}), 0) as double) as {m}_{kind}" for i, m in enumerate(MONTHS, 1))


def missing(name: str, fact: str, p: str, col: str) -> str:
    return f"""from {fact} join date_dim on d_date_sk = {p}_sold_date_sk join item on i_item_sk = {p}_item_sk
        select '{name}' as channel, '{col}' as col_name, d_year, d_qoy, i_category, count(*) as sales_cnt, {S(p + '_ext_sales_price')} as sales_amt
        where {col} is null group by all"""


SQL = {
    "q03": brand("i_manufact_id = 28 and d_moy = 11", top("d_year", "-ext_price", "i_brand_id", "i_brand", limit=100)),
    "q52": brand("i_manager_id = 1 and d_moy = 11 and d_year = 1998", top("d_year", "-ext_price", "i_brand_id", "i_brand", limit=100)),
    "q55": brand("i_manager_id = 28 and d_moy = 11 and d_year = 1999", top("-ext_price", "i_brand_id", "i_brand", limit=100), ""),
    "q42": f"""from {SSDI} select d_year, i_category_id, i_category, {S('ss_ext_sales_price')} as sales
        where i_manager_id = 1 and d_moy = 11 and d_year = 1998 group by all {top('-sales', 'd_year', 'i_category_id', 'i_category', limit=100)}""",
    "q07": promoted("store_sales", "ss", "ss_cdemo_sk"),
    "q26": promoted("catalog_sales", "cs", "cs_bill_cdemo_sk"),
    "q13": f"""from {SSD} join store on s_store_sk = ss_store_sk join customer_demographics on cd_demo_sk = ss_cdemo_sk
        join household_demographics on hd_demo_sk = ss_hdemo_sk join customer_address on ca_address_sk = ss_addr_sk
        select {A('ss_quantity')} as avg_quantity, {A('ss_ext_sales_price')} as avg_price, {A('ss_ext_wholesale_cost')} as avg_cost,
          {S('ss_ext_wholesale_cost')} as sum_cost
        where d_year = 1998 and case cd_marital_status
            when 'M' then cd_education_status = 'Advanced Degree' and ss_sales_price between 100 and 150 and hd_dep_count = 3
            when 'S' then cd_education_status = 'College' and ss_sales_price between 50 and 100 and hd_dep_count = 1
            when 'W' then cd_education_status = '2 yr Degree' and ss_sales_price between 20 and 200 and hd_dep_count = 1 end and {PLACES}""",
    "q48": f"""from {SSD} join store on s_store_sk = ss_store_sk join customer_demographics on cd_demo_sk = ss_cdemo_sk
        join customer_address on ca_address_sk = ss_addr_sk select cast(sum(ss_quantity) as bigint) as quantity
        where d_year = 1998 and cd_marital_status = 'M' and cd_education_status = 'Advanced Degree' and ss_sales_price between 50 and 200 and {PLACES}""",
    "q15": f"""from catalog_sales join date_dim on d_date_sk = cs_sold_date_sk join ds_customer on c_customer_sk = cs_bill_customer_sk
        join customer_address on ca_address_sk = c_current_addr_sk select ca_zip, {S('cs_sales_price')} as sales
        where d_quarter_name = '1998Q2' and (ca_zip in {ZIPS} or ca_state in ('CA', 'GA') or cs_sales_price > 150)
        group by all {top('ca_zip', limit=100)}""",
    "q45": f"""from web_sales join date_dim on d_date_sk = ws_sold_date_sk join ds_customer on c_customer_sk = ws_bill_customer_sk
        join customer_address on ca_address_sk = c_current_addr_sk join item on i_item_sk = ws_item_sk
        select ca_zip, {S('ws_sales_price')} as sales
        where d_quarter_name = '1998Q2' and (ca_zip in {ZIPS} or i_item_id in (from item select i_item_id where i_item_sk in (2, 3, 5, 7, 11, 13, 17, 19, 23, 29)))
        group by all {top('ca_zip', limit=100)}""",
    "q19": f"""from {SSDI} join ds_customer on c_customer_sk = ss_customer_sk join customer_address on ca_address_sk = c_current_addr_sk
        join store on s_store_sk = ss_store_sk
        select i_brand, i_brand_id, i_manufact_id, i_manufact, {S('ss_ext_sales_price')} as ext_price
        where i_manager_id = 8 and d_year = 1998 and d_moy = 11 and ca_zip <> s_zip
        group by all {top('-ext_price', 'i_brand', 'i_brand_id', 'i_manufact_id', 'i_manufact', limit=100)}""",
    "q06": f"""with dear as (from item select *, cast(sum(i_current_price) over w as double) / count(*) over w as usual window w as (partition by i_category))
        from {SSD} join dear on i_item_sk = ss_item_sk join ds_customer on c_customer_sk = ss_customer_sk
          join customer_address on ca_address_sk = c_current_addr_sk
        select ca_state, count(*) as cnt
        where d_month_seq = (1998 - 1900) * 12 and cast(i_current_price as double) > cast(1.2 as double) * usual
        group by all having count(*) >= 10 {top('cnt', 'ca_state', limit=100)}""",
    "q43": f"""from {SSD} join store on s_store_sk = ss_store_sk select s_store_name, s_store_id,
        {', '.join(f"cast(sum(ss_sales_price) filter (d_dow = {i}) as double) as {d[:3].lower()}_sales" for i, d in enumerate(DAYS))}
        where s_gmt_offset = -5 and d_year = 1998 group by s_store_name, s_store_id {top('s_store_name', 's_store_id', limit=100)}""",
    "q61": f"""with f as (from {SSDI} join store on s_store_sk = ss_store_sk join ds_customer on c_customer_sk = ss_customer_sk
          join customer_address on ca_address_sk = c_current_addr_sk
          where ca_gmt_offset = -7 and s_gmt_offset = -7 and i_category = 'Jewelry' and d_year = 1998),
        p as (from f join promotion on p_promo_sk = ss_promo_sk select {S('ss_ext_sales_price')} as promotions
          where 'Y' in (p_channel_dmail, p_channel_email, p_channel_tv)),
        a as (from f select {S('ss_ext_sales_price')} as total)
        from p, a select promotions, total, promotions / total * 100 as share""",
    "q62": shipping("web_sales", "ws", "web_site", "web_site_sk = ws_web_site_sk", "web_name"),
    "q99": shipping("catalog_sales", "cs", "call_center", "cc_call_center_sk = cs_call_center_sk", "cc_name"),
    "q88": f"from {TIMED} select {', '.join(slot(k) for k in range(8))} where s_store_name = 'ese' and {HOMES}",
    "q96": f"from {TIMED} select count(*) as n where s_store_name = 'ese' and t_hour = 20 and t_minute >= 30 and hd_dep_count = 7",
    "q90": """from web_sales join time_dim on t_time_sk = ws_sold_time_sk join household_demographics on hd_demo_sk = ws_ship_hdemo_sk
        join web_page on wp_web_page_sk = ws_web_page_sk
        select cast(count_if(t_hour in (8, 9)) as double) / cast(count_if(t_hour in (19, 20)) as double) as am_pm_ratio
        where hd_dep_count = 6 and wp_char_count between 5000 and 6000""",
    "q09": "select " + ", ".join(band9(i, *b) for i, b in enumerate(
        ((1, 10, 2972), (11, 20, 4000), (21, 30, 9999999), (31, 40, 100), (41, 50, 9999999)), 1)) + " from reason where r_reason_sk = 1",
    "q28": "select * from " + ", ".join(band28(i, *b) for i, b in enumerate(
        ((0, 5, 8, 459, 57), (6, 10, 90, 2323, 31), (11, 15, 142, 12214, 79), (16, 20, 135, 6071, 38), (21, 25, 122, 836, 17), (26, 30, 154, 7326, 7)), 1)),
    "q91": f"""from catalog_returns join date_dim on d_date_sk = cr_returned_date_sk join call_center on cc_call_center_sk = cr_call_center_sk
        join ds_customer on c_customer_sk = cr_returning_customer_sk join customer_address on ca_address_sk = c_current_addr_sk
        join customer_demographics on cd_demo_sk = c_current_cdemo_sk join household_demographics on hd_demo_sk = c_current_hdemo_sk
        select cc_call_center_id, cc_name, cc_manager, {S('cr_net_loss')} as returns_loss
        where d_year between 1996 and 2001 and (cd_marital_status, cd_education_status) in (('M', 'Unknown'), ('W', 'Advanced Degree'))
          and prefix(hd_buy_potential, 'Unknown') and ca_gmt_offset = -7
        group by cc_call_center_id, cc_name, cc_manager, cd_marital_status, cd_education_status""",
    "q84": f"""from ds_customer join customer_address on ca_address_sk = c_current_addr_sk join household_demographics on hd_demo_sk = c_current_hdemo_sk
        join income_band on ib_income_band_sk = hd_income_band_sk join customer_demographics on cd_demo_sk = c_current_cdemo_sk
        join store_returns on sr_cdemo_sk = cd_demo_sk
        select c_customer_id as customer_id, format('{{}}, {{}}', c_last_name, c_first_name) as customername
        where ca_city = 'Edgewood' and ib_lower_bound >= 38128 and ib_upper_bound <= 88128 {top('customer_id', 'customername', limit=100)}""",
    "q41": f"""from item a select distinct i_product_name
        where i_manufact_id between 8 and 48 and (from item b select count(*) where b.i_manufact = a.i_manufact and ({COMBO})) > 0
        {top('i_product_name', limit=100)}""",
    "q76": f"""({missing('store', 'store_sales', 'ss', 'ss_store_sk')}) union all ({missing('web', 'web_sales', 'ws', 'ws_ship_customer_sk')})
        union all ({missing('catalog', 'catalog_sales', 'cs', 'cs_ship_addr_sk')})
        {top('channel', 'col_name', 'd_year', 'd_qoy', 'i_category', limit=100)}""",
    "q66": f"""with f as (
          from web_sales select ws_sold_date_sk as dk, ws_ship_mode_sk as mk, ws_warehouse_sk as wk, ws_sold_time_sk as tk,
            ws_ext_sales_price * ws_quantity as sales, ws_net_paid * ws_quantity as net
          union all from catalog_sales select cs_sold_date_sk, cs_ship_mode_sk, cs_warehouse_sk, cs_sold_time_sk,
            cs_sales_price * cs_quantity, cs_net_paid_inc_tax * cs_quantity),
        m as (from f join date_dim on d_date_sk = dk join ship_mode on sm_ship_mode_sk = mk join warehouse on w_warehouse_sk = wk
          select w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country, 'DHL,BARIAN' as ship_carriers, d_year as year,
            {month_cols('sales', '', '')}, {month_cols('net', '', '')}
          where d_year = 1998 and tk between 28800 and 64800 and sm_carrier in ('BARIAN', 'DHL') group by 1, 2, 3, 4, 5, 6, 7, 8)
        from m select *, {', '.join(f'{x}_sales / w_warehouse_sq_ft as {x}_sales_per_sq_foot' for x in MONTHS)}""",
    "q71": f"""with f as (from web_sales select ws_ext_sales_price as price, ws_sold_date_sk as dk, ws_item_sk as ik, ws_sold_time_sk as tk
          union all from catalog_sales select cs_ext_sales_price, cs_sold_date_sk, cs_item_sk, cs_sold_time_sk
          union all from store_sales select ss_ext_sales_price, ss_sold_date_sk, ss_item_sk, ss_sold_time_sk)
        from f join date_dim on d_date_sk = dk join item on i_item_sk = ik join time_dim on t_time_sk = tk
        select i_brand_id, i_brand, t_hour, t_minute, {S('price')} as ext_price
        where i_manager_id = 1 and d_year = 1998 and d_moy = 11 and t_meal_time in ('breakfast', 'dinner') group by all""",
}
SQL = {f"tpcds_{k}": with_tables(v) for k, v in SQL.items()}
