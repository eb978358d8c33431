from oracle.prelude import A, top, with_tables

INV = "inventory join date_dim on d_date_sk = inv_date_sk join item on i_item_sk = inv_item_sk"


def stocked(fact: str, key: str, price: int, start: str, makers: str) -> str:
    return f"""from {INV} join {fact} on {key} = i_item_sk select distinct i_item_id, i_item_desc, cast(i_current_price as double) as i_current_price
      where i_current_price between {price} and {price + 30} and d_date between date '{start}' and date '{start}' + 60
        and i_manufact_id in ({makers}) and inv_quantity_on_hand between 100 and 500 {top('i_item_id', 'i_item_desc', 'i_current_price', limit=100)}"""


M39 = """(from inventory join date_dim on d_date_sk = inv_date_sk join warehouse on w_warehouse_sk = inv_warehouse_sk
    select w_warehouse_sk, inv_item_sk as i_item_sk, {mean} as mean, stddev_samp(inv_quantity_on_hand) / nullif({mean}, 0) as cov
    where d_year = 1999 and d_moy = {m} group by all)"""


def m39(m: int) -> str:
    return M39.replace("{mean}", A("inv_quantity_on_hand")).replace("{m}", str(m))


SQL = {
    "q21": f"""with r as (from {INV} join warehouse on w_warehouse_sk = inv_warehouse_sk select w_warehouse_name, i_item_id,
          cast(coalesce(sum(inv_quantity_on_hand) filter (d_date < '1999-03-11'), 0) as bigint) as inv_before,
          cast(coalesce(sum(inv_quantity_on_hand) filter (d_date >= '1999-03-11'), 0) as bigint) as inv_after
          where i_current_price between 20 and 40 and d_date between date '1999-03-11' - 30 and date '1999-03-11' + 30 group by 1, 2)
        from r where inv_before > 0 and inv_after // inv_before between 2 / 3 and 3 / 2 {top('w_warehouse_name', 'i_item_id', limit=100)}""",
    "q37": stocked("catalog_sales", "cs_item_sk", 28, "1999-02-01", "7, 14, 28, 42"),
    "q82": stocked("store_sales", "ss_item_sk", 62, "1999-05-25", "9, 20, 21, 33"),
    "q39": f"""from {m39(1)} a join {m39(2)} b using (w_warehouse_sk, i_item_sk)
        select w_warehouse_sk, i_item_sk, 1 as d_moy, a.mean as mean1, round(a.cov, 6) as cov1, 2 as next_moy, b.mean as mean2, round(b.cov, 6) as cov2
        where a.cov > 1.5 and b.cov > 1""",
    "q72": f"""from catalog_sales join inventory on inv_item_sk = cs_item_sk join warehouse on w_warehouse_sk = inv_warehouse_sk join item on i_item_sk = cs_item_sk
          join customer_demographics on cd_demo_sk = cs_bill_cdemo_sk join household_demographics on hd_demo_sk = cs_bill_hdemo_sk
          join date_dim x on x.d_date_sk = cs_sold_date_sk join date_dim y on y.d_date_sk = inv_date_sk join date_dim z on z.d_date_sk = cs_ship_date_sk
          left join promotion on p_promo_sk = cs_promo_sk left join catalog_returns on (cr_item_sk, cr_order_number) = (cs_item_sk, cs_order_number)
        select i_item_desc, w_warehouse_name, x.d_week_seq as d_week_seq, count(*) as no_promo, count(*) as promo, count(*) as total_cnt
        where x.d_week_seq = y.d_week_seq and inv_quantity_on_hand < cs_quantity and z.d_date > x.d_date + 5 and hd_buy_potential = '>10000'
          and x.d_year = 1999 and cd_marital_status = 'D' group by 1, 2, 3 {top('-total_cnt', 'i_item_desc', 'w_warehouse_name', 'd_week_seq', limit=100)}""",
}
SQL = {f"tpcds_{k}": with_tables(v) for k, v in SQL.items()}
