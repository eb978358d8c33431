from oracle.prelude import A, S, with_tables

VOL = "select count(distinct order_id) as num_orders, cast(sum(item_quantity) as bigint) as num_items, count(distinct customer_id) as num_customers"
CNT = f"""count(distinct product_id) as prod_cnt, count(distinct order_id) as order_cnt, count(distinct customer_id) as cust_cnt,
    cast(sum(item_quantity) as bigint) as total_qty, {S('item_price * item_quantity')} as total_amt"""


def span(a: str, b: str) -> str:
    return f"order_datetime >= timestamp '{a}' and order_datetime <= timestamp '{b}'"


NOW = "order_datetime between '1998-04-11' and '1998-04-12'"
AGO = "order_datetime between '1997-04-10' and '1997-04-11'"


def period(p: str, cond: str) -> str:
    w = "date_diff('second', order_datetime, ship_datetime)"
    return f"""cast(sum({w}) filter ({cond}) as double) / nullif(count(*) filter ({cond}), 0) as {p}avg_seconds_to_ship,
      cast(sum(item_quantity) filter ({cond}) as bigint) as {p}total_quantity,
      count(distinct product_id) filter ({cond}) as {p}product_cnt, count(distinct order_id) filter ({cond}) as {p}total_orders"""


def without(bought: str, never: str) -> str:
    has = "from order_lineitems join categories_dim on category_id = product_category_id select customer_id where category_name in"
    return f"({has} ({bought})) except ({has} ({never}))"


def extremes(where: str = "true", last: str = "max(order_id) filter (order_datetime = low)", at: str = "min(low)") -> str:
    return f"""from (from order_lineitems select *, min(order_datetime) over w as low, max(order_datetime) over w as high
        where {where} window w as (partition by customer_id, product_category_id))
      select customer_id, product_category_name, min(low) as first_order_datetime, min(order_id) filter (order_datetime = low) as first_order_id,
        {at} as last_order_datetime, {last} as last_order_id group by customer_id, product_category_name"""


def three_grains(where: str = "true") -> str:
    def grain(label: str) -> str:
        return f"""from order_lineitems select product_category_name, {label} as type, cast(sum(item_quantity) as bigint) as total_quantity,
          {S('item_price')} as total_price where {where} group by all"""
    return " union all ".join(f"({grain(g)})" for g in ("'Total'", "strftime(order_datetime, '%Y')", "strftime(order_datetime, '%Y-%b')"))


def ten(direction: str) -> str:
    return f"""from (from order_lineitems select strftime(order_datetime, '%Y-%m') as order_month, product_id,
          cast(sum(item_quantity) as bigint) as total_sold
          where ({span('1998-01-01', '1998-01-30 23:59:59')}) or ({span('1997-01-01', '1997-01-30 23:59:59')}) group by all)
        join products_dim using (product_id)
        select order_month, total_sold, product_name, row_number() over (partition by order_month order by total_sold {direction}, product_id) as item_rank
        qualify item_rank <= 10"""


def last_state(until: str) -> str:
    return f"""with l as (from order_lineitems select customer_id, order_datetime as seen
          qualify row_number() over (partition by customer_id order by order_datetime desc, order_item_id desc) = 1)
        from l join customer_addresses_dim using (customer_id) select customer_id, arg_max(state_code, valid_from_timestamp) as state_code
        where seen >= valid_from_timestamp and seen <= {until} group by customer_id having arg_max(state_code, valid_from_timestamp) = 'CA'"""


Q = span("1998-09-01", "1999-02-01")
FIVE = "product_id in (20, 25, 29, 38, 50)"
SQL = {
    "r001": f"from order_lineitems {VOL} where {span('1998-01-05', '1998-01-06')}",
    "r565": f"from order_lineitems {VOL} where {span('1998-10-01', '1998-12-31')}",
    "r605": f"from order_lineitems {VOL} where {span('2001-01-01', '2001-08-15')}",
    "r004": f"""from order_lineitems join products_dim using (product_id) join categories_dim using (category_id)
        select category_name, {period('', NOW)}, {period('ya_', AGO)}
        where ship_datetime is not null and category_id = 10 and (({NOW}) or ({AGO})) group by category_name""",
    "r013": f"from order_lineitems select customer_id, {CNT} where customer_id = 79 group by customer_id",
    "r015": f"""from order_lineitems join products_dim using (product_id) join categories_dim using (category_id)
        select category_name, {CNT} where category_id = 5 and {span('1998-05-09', '1998-05-20')} group by category_name""",
    "r558": f"""from order_lineitems select product_category_id, cast(sum(item_quantity) as bigint) as category_item_count
        where {span('1998-01-01', '1998-01-31')} group by all having sum(item_quantity) > 900""",
    "r566": without("'Kitchen'", "'Software', 'Digital Software'"),
    "r568": without("'CE'", "'Software', 'Digital Software'"),
    "r573": without("'DVD'", "'Toys'"),
    "r580": without("'Shoes', 'Apparel'", "'Furniture'"),
    "r582": without("'Beauty'", "'Home'"),
    "r567": f"""from order_lineitems select strftime(order_datetime, '%Y/%m') as ship_month, item_shipment_status_code,
        count(distinct order_id) as num_orders where {span('1998-01-01', '1998-01-31')} group by all""",
    "r591": f"""from order_lineitems select item_shipment_status_code, count(distinct order_id) as num_orders
        where {span('1998-01-01', '1998-12-31')} group by all""",
    "r590": f"""from (from order_lineitems select sum(item_quantity) as items where {span('1998-01-01', '1998-12-31')}
        group by customer_id, date_trunc('month', order_datetime)) select round({A('items')}, 2) as average_item_count""",
    "r617": f"""from (from order_lineitems select sum(item_quantity) as items where {span('1998-01-01', '1998-12-31')}
        group by customer_id) select round({A('items')}, 2) as average_item_count""",
    "r592": """from order_lineitems select product_id, product_category_id, cast(sum(item_quantity) as bigint) as product_count,
        row_number() over (partition by product_category_id order by sum(item_quantity) desc, product_id) as category_rank
        group by product_id, product_category_id qualify category_rank <= 10""",
    "r594": last_state("valid_to_timestamp"),
    "r594_open": last_state("coalesce(valid_to_timestamp, timestamp '9999-12-31')"),
    "r596": extremes(),
    "r596_whole_frame": extremes(last="max(order_id) filter (order_datetime = high)", at="max(high)"),
    "r597": extremes("product_id = 2"),
    "r601": extremes(FIVE),
    "r603": three_grains(),
    "r604": three_grains(Q),
    "r618": three_grains(f"{Q} and {FIVE}"),
    "r619": three_grains(f"product_id = 28 and {span('1997-09-01', '1999-02-01')}"),
    "r621": three_grains(f"{Q} and product_id in (16, 51)"),
    "r622": ten("asc"),
    "r622_top": ten("desc"),
    "r634": f"""from retail_orders select strftime(order_datetime, '%Y') as order_year, count(*) as num_orders
        where ship_completion_datetime > order_datetime + interval 4 days
          and (({span('1998-01-01', '1998-03-31 23:59:59')}) or ({span('1997-01-01', '1997-03-31 23:59:59')})) group by all""",
}
SQL = {f"retail_{k}": with_tables(v) for k, v in SQL.items()}
