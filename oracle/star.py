"""Statements of the generated retail star, from the seed lists to its facts."""

from __future__ import annotations

from oracle.draws import Keyed
from oracle.prelude import with_tables
from tidemark.plans.retail_star import CIPHER_COUPON, DAY_WEIGHTS, FIRST_ORDER_ID, FIRST_SEQUENCE, FRAUD, MONTH_WEIGHTS, PAYMENT_METHODS, SHIPMENT_TYPES, SHIPPERS, YEAR_WEIGHTS

SEED = 7
FIRST, LAST, HELD_OUT = "date '2006-01-01'", "date '2010-12-31'", "date '2010-12-09'"
STATES = "['TN', 'GA', 'TX', 'OH', 'KY', 'NM', 'VA', 'CA']"

PERSON = Keyed(SEED, (("customer_id", 8),))
VERSION = Keyed(SEED, (("customer_id", 8), ("version", 4)))
DAY = Keyed(SEED, (("calendar_day - date '1970-01-01'", 4),))
ORDER = Keyed(SEED, (("calendar_day - date '1970-01-01'", 4), ("customer_id", 8)))
LINE = Keyed(SEED, (("calendar_day - date '1970-01-01'", 4), ("customer_id", 8), ("item_ctr", 4)))
PARCEL = Keyed(SEED, (("order_item_id", 8),))


def digits(x: str, width: int) -> str:
    return f"if(length(({x})::varchar) > {width}, repeat('#', {width}), lpad(({x})::varchar, {width}, '0'))"


def label(x: str, values: dict) -> str:
    return f"case {x} " + " ".join(f"when {k!r} then '{v}'" for k, v in values.items()) + " end"


def weight(x: str, values: dict) -> str:
    return f"(case {x} " + " ".join(f"when {k} then {float(v)}::double" for k, v in values.items()) + " else 0.0::double end)"


def after(name: str, low: int, high: int) -> str:
    return f"calendar_day::timestamp + to_seconds({LINE.bell(name, str(low), str(high), k=3, bound=False)})"


#: Frames that the statements share, by name.
FRAMES = {
    "g_calendar": f"select unnest(generate_series({FIRST}, {LAST}, interval 1 day))::date as calendar_day",
    "g_people": """from (from nation select concat('First', n_nationkey) as first_name, if(n_nationkey % 2 = 0, 'M', 'F') as gender,
          row_number() over (order by if(n_nationkey % 2 = 0, 'M', 'F'), concat('First', n_nationkey)) - 1 as i),
        (from customer select substr(c_name, 10, 9) as last_name, row_number() over (order by substr(c_name, 10, 9)) - 1 as j, count(*) over () as m)
        select (i * m + j + 1)::bigint as customer_id, first_name, last_name, gender""",
    "g_sites": """from (from supplier select lower(regexp_replace(s_name, '[^A-Za-z0-9]', '', 'g')) || '.example.com' as website_name)
        select website_name, row_number() over (order by website_name) as site""",
    "g_mails": f"""from (from g_people select *, {PERSON.whole('site', 1, '(select count(*) from g_sites)')} as site) join g_sites using (site)
        select customer_id, first_name || '.' || last_name || '@' || website_name as email_address""",
    "g_zips": f"""from (from supplier select lpad((s_suppkey * 37 % 100000)::varchar, 5, '0') as zip_code, 'City ' || s_suppkey % 40 as city, {STATES}[s_suppkey % 8 + 1] as state)
        select *, row_number() over (order by zip_code, city, state) as zip_key""",
    "g_streets": "from (from supplier select 'Street ' || s_suppkey as street_name) select street_name, row_number() over (order by street_name) as street_key",
    "g_versions": f"""from (from g_people select customer_id, unnest(range(1, 1 + {PERSON.power('address_count', 1, 15, 5)}))::int as version)
        select *, {VERSION.whole('house', 1, 9999)}::varchar as house_number, {VERSION.whole('street', 1, '(select count(*) from g_streets)')} as street_key,
          {VERSION.whole('zip', 1, '(select count(*) from g_zips)')} as zip_key, {VERSION.whole('apt', 1, 99)} as apt, {VERSION.whole('plus', 1, 9999)} as plus,
          (date '2011-01-01' - {VERSION.whole('days', 1, 1825)}::int)::timestamp + to_seconds({VERSION.whole('secs', 1, 86400)}) as valid_from_timestamp,
          '(' || {digits(VERSION.whole('p1', 1, 999), 3)} || ')' || {digits(VERSION.whole('p2', 1, 999), 3)} || '-' || {digits(VERSION.whole('p3', 1, 9999), 4)} as phone_number""",
    "g_addresses": """from g_versions join g_zips using (zip_key) join g_streets using (street_key)
        select customer_id, version, valid_from_timestamp, lag(valid_from_timestamp) over (partition by customer_id order by valid_from_timestamp desc, version desc) as valid_to_timestamp,
          house_number, street_name, if(apt > 75, 'Apt ' || (apt - 75), null) as appt_suite_no, city, state as state_code, zip_code, zip_code || '-' || plus as zip_plus_four,
          'USA' as country, phone_number""",
    "g_factors": f"""from g_calendar select calendar_day, ({weight('dayofweek(calendar_day)', DAY_WEIGHTS)} + {weight('month(calendar_day)', MONTH_WEIGHTS)} + {weight('year(calendar_day)', YEAR_WEIGHTS)})
        * (1.0::double + {DAY.bell('noise', '-4', '4', k=3, bound=False)} / 100.0::double) as factor""",
    "g_joined": f"""from (from g_people select customer_id, {PERSON.whole('joined.low', 1, 10)} as low)
        select customer_id, if({PERSON.power('founder', 0, 10, 5)} = 0, {FIRST}, {LAST} - least({PERSON.half_bell('joined', 'low', f'({LAST} - {FIRST})', k=2, bound=False)}, {LAST} - {FIRST})::int) as start_date,
          ({PERSON.power('stay', 0, 10, 5)} * {PERSON.bell('stay.unit', '1', '50', k=3)})::int as days, {PERSON.bell('segment', '1', '10')}::smallint as customer_segment""",
    "g_lives": f"from g_joined select customer_id, start_date, if(days = 0, {LAST}, least(start_date + days, {LAST})) as last_date, customer_segment",
    "g_line": """from g_factors join (from (from g_calendar select calendar_day, 0 as n union all from g_lives select start_date, 1 union all from g_lives select last_date + 1, -1)
              select calendar_day, sum(sum(n)) over (order by calendar_day) as active group by calendar_day) using (calendar_day)
        select calendar_day, if(active = 0, 1.0, least((select count(*) from orders)::double * factor / (select sum(factor) from g_factors) / active, 1.0)) as p""",
    "g_stretch": "from g_line select calendar_day, p, sum(p) over (order by calendar_day) as upto, sum(p) over (order by calendar_day) - p as since",
    "g_points": f"""from (from g_lives join g_stretch a on a.calendar_day = start_date join g_stretch b on b.calendar_day = last_date
              select customer_id, customer_segment, a.since as low, b.upto - a.since as wanted, {PERSON.whole('at', 0, 999999999)} / 1000000000.0::double as shift)
        select customer_id, customer_segment, low + shift + unnest(range(ceil(wanted - shift)::bigint)) as spot""",
    "g_daily": "from g_points join g_stretch on spot >= since and spot < upto select distinct calendar_day, customer_id, customer_segment",
    "g_numbered": f"""from (from g_daily select *, row_number() over (order by calendar_day, customer_id) - 1 + {FIRST_ORDER_ID} as order_id)
        select *, order_id - {FIRST_ORDER_ID} + {FIRST_SEQUENCE} as bigseq, {ORDER.whole('big', 1, 9999999999)} as bigrand, {ORDER.bell('store', '1', '100')}::smallint as store_id,
          {ORDER.whole('pay', 1, 5)}::smallint as payment_method_id, {ORDER.power('items', 1, 25, 16)}::smallint as item_count, calendar_day::timestamp + to_seconds({ORDER.whole('clock', 0, 86399)}) as order_ts""",
    "g_items": f"""from (from g_numbered select *, unnest(range(1, 1 + item_count))::int as item_ctr, (select count(*) from part)::int as goods)
        select *, order_id * 26 + item_ctr as order_item_id, {LINE.bell('status', '1', '10')}::smallint as status_code, {LINE.bell('product', '1', 'goods')} as product_id,
          {after('ship', 86400, 604800)} as ship_ts, if({LINE.flag('kept', 0.9)}, null, {after('return', 604800, 2592000)}) as item_return_ts,
          if({LINE.flag('unrefunded', 0.966)}, null, {after('refund', 604800, 2592000)}) as item_refund_ts, {LINE.power('quantity', 1, 25, 15)}::smallint as item_quantity,
          {LINE.power('discount', 1, 25, 15)}::smallint as discount_code, {LINE.half_bell('coupon', '1', '10')}::smallint as coupon_no""",
    "g_goods": """from (from part select p_type || ' ' || string_split(p_name, ' ')[-1] as category_name, concat(p_name, ' ', p_partkey) as product_name, (100 * p_retailprice::decimal(15,2))::bigint as cents)
        join (from (from part select distinct p_type || ' ' || string_split(p_name, ' ')[-1] as category_name) select category_name, row_number() over (order by category_name) as category_id) using (category_name)
        select row_number() over (order by product_name, category_id, cents) as product_id, category_name, product_name, cents""",
    # Tax in thousandths of a percent, money in cents: whole numbers all the way.
    "g_lines": """from g_items join g_goods using (product_id) join (from g_addresses where valid_to_timestamp is null) using (customer_id)
        select *, if(item_quantity > 12, item_quantity - 11, 1) as pieces, 1000 * (4 + ascii(state_code) % 5) as rate""",
}


def _sql(text: str) -> str:
    return with_tables(text, FRAMES)


ADDRESS = "customer_id, version, valid_from_timestamp, valid_to_timestamp, house_number, street_name, appt_suite_no, city, state_code, zip_code, zip_plus_four, country, phone_number"
DRAWN = Keyed(SEED, (("o_orderkey", 8),))
DRAWS = {
    "normal": DRAWN.normal("normal", "50.0::double", "10.0::double"), "bell": DRAWN.bell("bell", "1", "100"), "bell_3": DRAWN.bell("bell3", "1", "50", k=3),
    "two_bells": DRAWN.two_bells("two", "1", "100", "201", "300"), "half_bell": DRAWN.half_bell("half", "1", "10"), "power": DRAWN.power("power", 1, 25, 15),
    "whole": DRAWN.whole("whole", 1, 6), "flag": f"{DRAWN.flag('flag', 0.25)}::int",
}
DRAWN_ROWS = " union all ".join(f"(from orders select '{n}' as name, ({x})::double as x)" for n, x in DRAWS.items())

SQL = {
    "draws_bounds": f"""from ({DRAWN_ROWS}) select name, count(*) as draws, min(x::decimal(18,6))::double as least, max(x::decimal(18,6))::double as greatest,
        sum(x::decimal(18,6))::double as total group by name""",
    "draws_histogram": f"from ({DRAWN_ROWS}) select name, x, count(*) as n where name <> 'normal' group by all",
    "star_calendar": """from g_calendar select calendar_day, year(calendar_day)::smallint as reporting_year, quarter(calendar_day)::smallint as reporting_quarter,
        month(calendar_day)::smallint as reporting_month, weekofyear(calendar_day)::smallint as reporting_week, dayofweek(calendar_day)::smallint as reporting_dow""",
    "star_customers": "from g_people",
    "star_emails": "from g_mails",
    "star_addresses": f"from g_addresses select {ADDRESS}",
    "star_lifetimes": "from g_lives",
    "star_days": """from g_factors join (from g_daily select calendar_day, count(*) as drawn group by 1) using (calendar_day)
        select calendar_day, round(factor, 6) as factor, round(factor / (select sum(factor) from g_factors) * (select count(*) from orders), 6) as wanted, drawn""",
    "star_order_base": f"""from g_numbered select order_id, calendar_day, customer_id, customer_segment, store_id, payment_method_id, item_count, order_ts,
        'ON' || {digits('order_id // 100000', 5)} || '-' || {digits('order_id % 100000', 5)} || '-' || {digits('bigseq % 100', 2)} || '-' || {digits('bigrand % 1000000', 6)} as order_num,
        'OS' || {digits('bigseq % 100000', 5)} || '-' || {digits('(bigrand * 13 // 100) % 1000000', 6)} || '-' || {digits('customer_segment', 2)} || '-' || {digits('customer_id % 100000', 5)} as ordering_session_id""",
    "star_items": """from g_items select order_item_id, order_id, item_ctr, status_code, product_id, ship_ts, item_return_ts, item_refund_ts, item_quantity, discount_code, coupon_no""",
    "star_line_items": f"""from g_lines select if(order_ts < {HELD_OUT}, 'preload', 'later') as part, category_name as product_category_name,
        case when status_code < 3 then 'Received' when status_code = 3 then 'Prep' when status_code = 4 then 'Shipper_Notified' else 'Shipped' end as item_shipment_status_code,
        count(*) as n, sum(pieces)::bigint as quantity, (sum((pieces * cents * rate + 50) // 100)::decimal(38,0)::double / 100000) as tax group by all""",
    "star_coupons": f"""from g_lines select order_item_id, case coupon_no when 1 then 'BOGO-PDX' when 2 then 'None' when 3 then 'HOLIDAY' when 4 then 'Coupon-' || translate(bigrand::varchar, '0123456789', '{CIPHER_COUPON}')
        else 'CUST-Ret-' || translate(customer_id::varchar, '0123456789', '{CIPHER_COUPON}') end as coupon_code,
        (case coupon_no when 1 then 50 when 2 then 0 when 3 then 15 when 4 then 10 * item_quantity else 5 end / 100.0)::double as coupon_amount,
        (case discount_code when 1 then 50 when 2 then 0 else 50 + 15 * discount_code end / 1000.0)::double as discount_amount""",
    "star_orders": f"""from (from g_lines select order_id, any_value(year(order_ts)) as year, any_value({label('payment_method_id', PAYMENT_METHODS)}) as payment_method_code, sum(pieces) as pieces,
            sum(pieces * cents) as cents, count(item_return_ts) as returned, substr(order_id::varchar, 2, 2) as mark group by order_id)
        select year::int as year, payment_method_code, count(*) as orders, sum(pieces)::bigint as items, sum(cents)::double / 100 as paid, count(*) filter (returned > 0) as with_returns,
          count(*) filter (mark in ({', '.join(repr(k) for k in FRAUD)})) as frauds group by 1, 2""",
    "star_shipments": f"""from (from g_lines select {PARCEL.whole('shipper', 1, 4)} as shipper, {PARCEL.whole('type', 1, 4)} as kind, (8 * (50000 + 3 * cents) + 500) // 1000 as paid)
        select {label('shipper', SHIPPERS)} as shipper_code, {label('kind', SHIPMENT_TYPES)} as shipment_type_code, count(*) as n, sum(paid)::double / 100 as paid group by all""",
}


def span(day: str, monthly_end: str, weekly_end: str, first: str = FIRST, end: str = "date '2011-01-01'") -> str:
    """Name of the span of a day: months, then weeks, then one open span."""
    month, week = f"date_trunc('month', {day})::date", f"{monthly_end} + (({day} - {monthly_end}) // 7 * 7)::int"
    return f"""case when {day} < {first} or {day} >= {end} then 'other' when {day} < {monthly_end}
        then 'month_' || greatest({month}, {first}) || '_' || least(({month} + interval 1 month)::date, {monthly_end})
        when {day} < {weekly_end} then 'week_' || ({week}) || '_' || least({week} + 7, {weekly_end}) else 'open_' || {weekly_end} || '_' || {end} end"""


def by_span(fact: str, monthly_end: str, weekly_end: str, n: str = "count(*)") -> str:
    return f"(from g_lines select '{fact}' as fact, {span('calendar_day', monthly_end, weekly_end)} as span, {n} as n, sum(pieces)::bigint as quantity group by all)"


SQL |= {
    "star_replay": " union all ".join(by_span(f, "date '2010-01-01'", HELD_OUT, n) for f, n in (("lines", "count(*)"), ("orders", "count(distinct order_id)"), ("shipments", "count(*)"))),
    "star_rolled": by_span("lines", "date '2010-07-01'", "date '2010-12-25'"),
    "star_months": f"""from g_lines select strftime(calendar_day, '%Y-%m') as month, count(*) as n, sum(pieces)::bigint as quantity
        where order_ts >= timestamp '2009-11-20 12:00' and order_ts < timestamp '2010-02-03' group by 1""",
}
SQL = {k: _sql(v) for k, v in SQL.items()}
