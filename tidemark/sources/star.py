"""Definitions of the derived tables, by suite.

All money is built from whole cents, so that both engines hold equal decimals.
"""

from __future__ import annotations

from tidemark.sources.derive import JULIAN, Derived, cents, code, idiv, pick

SHIP_MODES = ["REG AIR", "AIR", "RAIL", "SHIP", "TRUCK", "MAIL", "FOB"]
SHIP_INSTRUCT = ["DELIVER IN PERSON", "COLLECT COD", "NONE", "TAKE BACK RETURN"]
CONTAINERS = ["SM CASE", "SM BOX", "MED BAG", "MED BOX", "LG CASE", "LG BOX", "JUMBO CASE", "WRAP JAR"]
FINISH = ["ANODIZED", "BURNISHED", "PLATED", "POLISHED", "BRUSHED"]
METAL = ["TIN", "NICKEL", "BRASS", "STEEL", "COPPER"]

SHIP_DAY = "cast(l_shipdate as date)"

TPCH = {
    "lineitem": Derived(
        "lineitem",
        (
            {
                "l_commitdate": f"{SHIP_DAY} + cast((l_orderkey*7 + l_linenumber*13) % 61 - 30 as int)",
                "l_receiptdate": f"{SHIP_DAY} + cast(1 + (l_orderkey*11 + l_linenumber*5) % 30 as int)",
                "l_shipmode": pick("l_orderkey + l_linenumber", SHIP_MODES),
                "l_shipinstruct": pick("l_orderkey*3 + l_linenumber", SHIP_INSTRUCT),
                "l_comment": "'item ' || cast(l_partkey as string) || ' of ' || cast(l_orderkey as string)",
                "l_shipdate": SHIP_DAY,
            },
        ),
        keep=True,
    ),
    "orders": Derived(
        "orders",
        (
            {
                # As in TPC-H, two customers of three never order.
                "o_custkey": "o_custkey - o_custkey % 3",
                "o_shippriority": "0",
                "o_clerk": code("Clerk#", "o_orderkey % 1000", 9),
                "o_comment": pick("o_orderkey", ["express deposits", "express regular deposits", "final pinto", "slow packages", "special requests"])
                + " || ' ' || cast(o_orderkey % 5000 as string)",
                "o_orderdate": "cast(o_orderdate as date)",
            },
        ),
        keep=True,
    ),
    "customer": Derived(
        "customer",
        (
            {
                "c_phone": "cast(c_nationkey + 10 as string) || '-' || lpad(cast(c_custkey % 1000 as string), 3, '0')",
                "c_address": code("Street ", "c_custkey", 6),
                "c_comment": code("customer note ", "c_custkey % 97", 2),
            },
        ),
        keep=True,
    ),
    "supplier": Derived(
        "supplier",
        (
            {
                "s_phone": "cast(s_nationkey + 10 as string) || '-' || lpad(cast(s_suppkey % 1000 as string), 3, '0')",
                "s_address": code("Avenue ", "s_suppkey", 6),
                "s_comment": pick("s_suppkey", ["quiet", "Customer slow Complaints", "fast", "steady", "blunt"]),
            },
        ),
        keep=True,
    ),
    "part": Derived(
        "part",
        (
            {
                "p_mfgr": "'Manufacturer#' || cast(1 + p_partkey % 5 as string)",
                "p_container": pick("p_partkey", CONTAINERS),
                "p_comment": code("part note ", "p_partkey % 89", 2),
                "p_type": f"p_type || ' ' || {pick('p_partkey', FINISH)} || ' ' || {pick(idiv('p_partkey', 5), METAL)}",
            },
        ),
        keep=True,
    ),
    # Four suppliers per part; @suppliers is the row count of supplier.
    "partsupp": Derived(
        "part",
        (
            {
                "ps_partkey": "p_partkey",
                "ps_suppkey": "(p_partkey*7 + copy*13) % @suppliers",
                "ps_availqty": "cast(1 + (p_partkey*31 + copy*17) % 999 as int)",
                "ps_supplycost": "cast((10000 + (p_partkey*97 + copy*1009) % 90000) * 0.01 as decimal(15,2))",
            },
        ),
        times=("copy", "4"),
    ),
}

# --- TPC-DS -----------------------------------------------------------------

CITIES = ["Fairview", "Midway", "Edgewood", "Oakdale", "Riverside", "Five Points", "Salem", "Glendale", "Clinton", "Union"]
COUNTIES = ["Williamson County", "Rush County", "Toole County", "Dona Ana County", "Walker County"]
STATES = ["TN", "GA", "TX", "OH", "KY", "NM", "VA", "CA"]
FIRST = ["James", "Mary", "John", "Linda", "Robert", "Susan", "David", "Karen", "Paul", "Nancy", "Mark", "Lisa", "Brian"]
LAST = ["Smith", "Johnson", "Brown", "Jones", "Miller", "Davis", "Wilson", "Moore", "Taylor", "White", "Harris"]
CATEGORIES = ["Books", "Music", "Electronics", "Home", "Sports", "Women", "Men", "Children", "Jewelry", "Shoes"]
CLASSES = ["personal", "portable", "reference", "classical", "accessories", "pants", "football", "stereo", "dresses", "shirts"]
COLORS = ["slate", "sienna", "purple", "medium", "powder", "khaki", "brown", "honeydew", "orange", "frosted"]
UNITS = ["Ounce", "Oz", "Bunch", "Ton", "Dozen", "Box", "Pound", "Each"]
SIZES = ["medium", "extra large", "N/A", "small", "petite", "large"]
DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
EDUCATION = ["College", "Advanced Degree", "2 yr Degree", "4 yr Degree", "Primary", "Secondary", "Unknown"]
BUY_POTENTIAL = [">10000", "Unknown", "0-500", "501-1000", "1001-5000", "5001-10000"]

FIRST_DAY = 9100  # 1994-12-01
CALENDAR_DAYS = 3000  # to 2003-02-16

STORE_ROWS = "l_orderkey % 3 = 0"
# A third of the returned store lines are bought again by catalog, and a
# quarter of the store lines also on the web.
CATALOG_ROWS = "(l_orderkey % 3 = 1 or (l_orderkey % 3 = 0 and l_returnflag = 'R' and l_linenumber % 2 = 0))"
WEB_ROWS = "(l_orderkey % 3 = 2 or (l_orderkey % 3 = 0 and l_linenumber % 4 = 1))"

SHIP_KEY = f"{JULIAN} + @days({SHIP_DAY})"
LATE_KEY = f"{SHIP_KEY} + (case when l_orderkey % 3 = 0 then 40 else 0 end)"


#: Per date key of a fact: the stored day it is derived from, and the least and the
#: greatest number of days by which the key is later.
STORED_DAYS = {
    "ss_sold_date_sk": ("ss_stored_day", 0, 0), "cs_sold_date_sk": ("cs_stored_day", 0, 40), "ws_sold_date_sk": ("ws_stored_day", 0, 40),
    "cs_ship_date_sk": ("cs_stored_day", 1, 170), "ws_ship_date_sk": ("ws_stored_day", 1, 170),
    "sr_returned_date_sk": ("sr_stored_day", 3, 142), "cr_returned_date_sk": ("cr_stored_day", 3, 182), "wr_returned_date_sk": ("wr_stored_day", 3, 182),
    "date_sk": ("stored_day", 0, 40),
}


def _line(sold: str) -> dict[str, str]:
    """Keys and unit prices, in cents, of one sold line."""
    return {
        "ok": "l_orderkey",
        "ln": "l_linenumber",
        "pk": "l_partkey",
        "sk": "l_suppkey",
        "sold": sold,
        "day": "l_shipdate",
        "cust": idiv("l_orderkey", 10),
        "qty": "cast(l_quantity as int)",
        "lp": "(l_partkey*37 + l_orderkey*11) % 20000 + 100",
    }


PRICES = {
    **{k: k for k in ("ok", "ln", "pk", "sk", "sold", "day", "cust", "qty", "lp")},
    "sp": "lp - " + idiv("lp * ((ok + ln) % 10)", 20),
    "wc": idiv("lp * (40 + pk % 40)", 100),
    "coupon": "case when (ok + pk) % 5 = 0 then " + idiv("qty * lp", 10) + " else 0 end",
}


def _sales(p: str, rows: str, sold: str, keys: dict[str, str]) -> Derived:
    money = {
        "wholesale_cost": "wc",
        "list_price": "lp",
        "sales_price": "sp",
        "ext_discount_amt": "qty * (lp - sp)",
        "ext_sales_price": "qty * sp",
        "ext_wholesale_cost": "qty * wc",
        "ext_list_price": "qty * lp",
        "ext_tax": idiv("qty * sp * (ok % 9)", 100),
        "coupon_amt": "coupon",
        "ext_ship_cost": "qty * (50 + pk % 150)",
        "net_paid": "qty * sp - coupon",
        "net_paid_inc_tax": "qty * sp - coupon + " + idiv("qty * sp * (ok % 9)", 100),
        "net_profit": "qty * sp - coupon - qty * wc",
    }
    out = {f"{p}_{k}": v for k, v in keys.items()}
    out[f"{p}_stored_day"] = "day"
    out[f"{p}_sold_date_sk"] = "cast(sold as bigint)"
    out[f"{p}_sold_time_sk"] = "(ok*3607 + ln*1009 + pk*17) % 86400"
    out[f"{p}_item_sk"] = "pk"
    out[f"{p}_promo_sk"] = "(ok + ln) % 30"
    out[f"{p}_quantity"] = "qty"
    out |= {f"{p}_{k}": cents(v) for k, v in money.items()}
    return Derived("lineitem", (_line(sold), PRICES, out), where=rows)


def _returns(p: str, rows: str, sold: str, keys: dict[str, str], amount: str) -> Derived:
    back = {**{k: k for k in PRICES}, "rq": idiv("qty + 1", 2)}
    money = {
        amount: "rq * sp",
        "return_tax": idiv("rq * sp * (ok % 9)", 100),
        f"{amount}_inc_tax": "rq * sp + " + idiv("rq * sp * (ok % 9)", 100),
        "fee": "50 + (ok*3 + ln) % 9950",
        "return_ship_cost": "rq * (50 + pk % 150)",
        "refunded_cash": idiv("rq * sp", 2),
        "reversed_charge": idiv("rq * sp", 4),
        "store_credit": idiv("rq * sp", 5),
        "net_loss": "50 + (ok*3 + ln) % 9950 + rq * (50 + pk % 150)",
    }
    out = {f"{p}_{k}": v for k, v in keys.items()}
    out[f"{p}_stored_day"] = "day"
    out[f"{p}_returned_date_sk"] = "cast(sold + 3 + (ok*5 + ln*17) % 140 as bigint)"
    out[f"{p}_item_sk"] = "pk"
    out[f"{p}_reason_sk"] = "(ok + pk) % 35"
    out[f"{p}_return_quantity"] = "rq"
    out |= {f"{p}_{k}": cents(v) for k, v in money.items()}
    return Derived("lineitem", (_line(sold), PRICES, back, out), where=f"l_returnflag = 'R' and {rows}")


ADDRESS = f"case when ok % 2 = 0 then cust else {idiv('cust', 2)} end"
CDEMO = "(ok*13 + ln*29) % 9800"
HDEMO = "(ok*7 + ln*301) % 7200"


def _place(p: str, k: str) -> dict[str, str]:
    return {
        f"{p}_street_number": f"cast(1 + {k} % 900 as string)",
        f"{p}_street_name": pick(idiv(k, 7), ["Main", "Oak", "Park", "Elm", "Lake"]),
        f"{p}_street_type": pick(k, ["St", "Ave", "Blvd"]),
        f"{p}_suite_number": f"'Suite ' || cast({k} % 50 as string)",
        f"{p}_city": pick(k, CITIES),
        f"{p}_county": pick(k, COUNTIES),
        f"{p}_state": pick(k, STATES),
        f"{p}_zip": f"cast(10000 + ({k} % 200)*37 as string)",
        f"{p}_country": "'United States'",
        f"{p}_gmt_offset": f"cast(-5 - {k} % 4 as int)",
    }


def _outlet(prefix: str, sk: str, name: str, rows: int, extra: dict[str, str]) -> Derived:
    return Derived(f"range:{rows}", ({sk: "id", **_place(prefix, "id"), **extra},))


TPCDS = {
    "store_sales": _sales(
        "ss", STORE_ROWS, SHIP_KEY,
        {
            "customer_sk": "cust", "cdemo_sk": CDEMO, "hdemo_sk": HDEMO,
            "addr_sk": f"case when (ok + ln) % 53 = 7 then null else {ADDRESS} end",
            "store_sk": "case when ok % 97 = 6 then null else sk end", "ticket_number": "ok",
        },
    ),
    "catalog_sales": _sales(
        "cs", CATALOG_ROWS, LATE_KEY,
        {
            "bill_customer_sk": "cust", "ship_customer_sk": idiv("ok", 20), "bill_cdemo_sk": CDEMO, "bill_hdemo_sk": HDEMO,
            "bill_addr_sk": ADDRESS, "ship_addr_sk": f"case when ok % 41 = 7 then null else {ADDRESS} end",
            "ship_date_sk": "cast(sold + 1 + (ok*5 + ln*17) % 130 as bigint)", "warehouse_sk": "(ok + ln) % 5",
            "call_center_sk": "ok % 6", "catalog_page_sk": "pk % 100", "ship_mode_sk": "(ok + ln) % 20", "order_number": "ok",
        },
    ),
    "web_sales": _sales(
        "ws", WEB_ROWS, LATE_KEY,
        {
            "bill_customer_sk": "cust", "ship_customer_sk": "case when ok % 43 = 7 then null else cust end",
            "bill_addr_sk": ADDRESS, "ship_addr_sk": ADDRESS, "ship_hdemo_sk": HDEMO,
            "ship_date_sk": "cast(sold + 1 + (ok*5 + ln*17) % 130 as bigint)", "warehouse_sk": "(ok + ln) % 5",
            "web_page_sk": "(ok + ln) % 60", "web_site_sk": "ok % 30", "ship_mode_sk": "(ok + ln) % 20", "order_number": "ok",
        },
    ),
    "store_returns": _returns(
        "sr", STORE_ROWS, SHIP_KEY,
        {
            "customer_sk": "cust", "cdemo_sk": CDEMO, "hdemo_sk": HDEMO, "addr_sk": ADDRESS, "store_sk": "sk",
            "ticket_number": "ok",
        }, "return_amt",
    ),
    "catalog_returns": _returns(
        "cr", CATALOG_ROWS + " and l_orderkey % 2 = 1", LATE_KEY,
        {
            "refunded_customer_sk": "cust", "returning_customer_sk": "cust", "returning_addr_sk": ADDRESS,
            "call_center_sk": "ok % 6", "catalog_page_sk": "pk % 100", "warehouse_sk": "(ok + ln) % 5", "order_number": "ok",
        }, "return_amount",
    ),
    "web_returns": _returns(
        "wr", WEB_ROWS + " and l_orderkey % 2 = 0", LATE_KEY,
        {
            "refunded_customer_sk": "cust", "returning_customer_sk": "cust", "refunded_addr_sk": ADDRESS,
            "returning_addr_sk": ADDRESS, "refunded_cdemo_sk": CDEMO,
            # Half of the returns are made by the buyer's own demographic group.
            "returning_cdemo_sk": f"case when ok % 4 = 0 then {CDEMO} else (ok*13 + ln*31 + 11) % 9800 end",
            "web_page_sk": "(ok + ln) % 60", "order_number": "ok",
        }, "return_amt",
    ),
    # Weekly stock of 1999 in three warehouses; cubes give a wide spread.
    "inventory": Derived(
        "part",
        (
            {"pk": "p_partkey", "w": idiv("slot", 3), "wh": "slot % 3"},
            {"pk": "pk", "w": "w", "wh": "wh", "u": "(pk*31 + w*w*17 + wh*7 + w*pk) % 100"},
            {
                "inv_date_sk": f"cast({JULIAN + 10595} + 7*w as bigint)",  # from Monday 1999-01-04
                "inv_item_sk": "pk",
                "inv_warehouse_sk": "cast(wh as bigint)",
                "inv_quantity_on_hand": "cast(floor(u*u*u / 1000) as int)",
            },
        ),
        times=("slot", "156"),
    ),
    "item": Derived(
        "part",
        (
            {"pk": "p_partkey", "p_name": "p_name", "p_brand": "p_brand", "grp": idiv("p_partkey", 2)},
            {
                "i_item_sk": "pk",
                "i_item_id": code("ITEM", "grp"),
                "i_item_desc": "p_name || ' made in ' || " + pick("pk", COLORS) + " || ' number ' || cast(pk % 500 as string)",
                "i_current_price": cents("(pk*73) % 9900 + 99"),
                "i_wholesale_cost": cents("(pk*41) % 6000 + 50"),
                "i_brand_id": "1001 + pk % 20",
                "i_brand": "'brand #' || cast(1 + pk % 20 as string)",
                "i_class_id": idiv("pk", 3) + " % 10",
                "i_class": pick(idiv("pk", 3), CLASSES),
                "i_category_id": idiv("pk", 10) + " % 10",
                "i_category": pick(idiv("pk", 10), CATEGORIES),
                "i_manufact_id": "pk % 50",
                "i_manufact": "'manufact ' || cast(pk % 50 as string)",
                "i_size": pick(idiv("pk", 11), SIZES),
                "i_color": pick(idiv("pk", 4), COLORS),
                "i_units": pick(idiv("pk", 6), UNITS),
                "i_manager_id": "pk % 40",
                "i_product_name": "p_name || '-' || cast(pk as string)",
            },
        ),
    ),
    "ds_customer": Derived(
        "customer",
        (
            {
                "c_customer_sk": "c_custkey",
                "c_customer_id": code("CUST", "c_custkey"),
                "c_current_cdemo_sk": "(c_custkey*31) % 9800",
                "c_current_hdemo_sk": "(c_custkey*17) % 7200",
                "c_current_addr_sk": "c_custkey",
                "c_first_sales_date_sk": f"cast({JULIAN + FIRST_DAY + 31} + (c_custkey*19) % 1000 as bigint)",
                "c_first_shipto_date_sk": f"cast({JULIAN + FIRST_DAY + 61} + (c_custkey*19) % 1000 as bigint)",
                "c_salutation": pick("c_custkey", ["Mr.", "Mrs.", "Dr."]),
                "c_first_name": pick("c_custkey", FIRST),
                "c_last_name": pick(idiv("c_custkey", 3), LAST),
                "c_preferred_cust_flag": pick(idiv("c_custkey", 5), ["Y", "N"]),
                "c_birth_day": "1 + c_custkey % 28",
                "c_birth_month": "1 + c_custkey % 12",
                "c_birth_year": "1930 + c_custkey % 60",
                "c_birth_country": pick(idiv("c_custkey", 2), ["UNITED STATES", "CANADA", "MEXICO"]),
                "c_login": code("login", "c_custkey", 6),
                "c_email_address": "'c' || cast(c_custkey as string) || '@example.com'",
                "c_last_review_date": f"cast({JULIAN + FIRST_DAY} + c_custkey % 900 as bigint)",
            },
        ),
    ),
    "customer_address": Derived(
        "customer",
        (
            {
                "ca_address_sk": "c_custkey",
                **_place("ca", "c_custkey"),
                "ca_location_type": pick("c_custkey", ["single family", "condo", "apartment"]),
            },
        ),
    ),
    "store": Derived(
        "supplier",
        (
            {
                "s_store_sk": "s_suppkey",
                "s_store_id": code("STORE", idiv("s_suppkey", 2)),
                "s_store_name": pick(idiv("s_suppkey", 2), ["ese", "ought", "able", "anti", "bar"]),
                **_place("s", "s_suppkey"),
                "s_market_id": "s_suppkey % 5",
                "s_company_id": "1",
                "s_company_name": "'Unknown'",
                "s_number_employees": "200 + (s_suppkey*13) % 100",
            },
        ),
    ),
    "customer_demographics": Derived(
        "range:9800",
        (
            {
                "cd_demo_sk": "id",
                "cd_gender": pick("id", ["M", "F"]),
                "cd_marital_status": pick(idiv("id", 2), ["M", "S", "D", "W", "U"]),
                "cd_education_status": pick(idiv("id", 10), EDUCATION),
                "cd_purchase_estimate": f"500 * (1 + {idiv('id', 70)} % 20)",
                "cd_credit_rating": pick(idiv("id", 140), ["Good", "Low Risk", "High Risk", "Unknown"]),
                "cd_dep_count": f"{idiv('id', 1400)} % 7",
                "cd_dep_employed_count": f"{idiv('id', 200)} % 7",
                "cd_dep_college_count": f"{idiv('id', 100)} % 7",
            },
        ),
    ),
    "household_demographics": Derived(
        "range:7200",
        (
            {
                "hd_demo_sk": "id",
                "hd_income_band_sk": "id % 20",
                "hd_buy_potential": pick(idiv("id", 20), BUY_POTENTIAL),
                "hd_dep_count": f"{idiv('id', 120)} % 10",
                "hd_vehicle_count": f"{idiv('id', 1200)} % 6",
            },
        ),
    ),
    "income_band": Derived("range:20", ({"ib_income_band_sk": "id", "ib_lower_bound": "id*10000 + (case when id = 0 then 0 else 1 end)", "ib_upper_bound": "(id + 1)*10000"},)),
    "date_dim": Derived(
        f"range:{CALENDAR_DAYS}",
        (
            {"n": f"{FIRST_DAY} + id", "d": f"@date(cast({FIRST_DAY} + id as int))"},
            {
                "d_date_sk": f"{JULIAN} + n",
                "d_date": "d",
                "d_month_seq": "(year(d) - 1900)*12 + month(d) - 1",
                "d_week_seq": idiv("n + 3", 7),  # weeks start on Monday
                "d_year": "year(d)",
                "d_dow": "(n + 4) % 7",
                "d_moy": "month(d)",
                "d_dom": "day(d)",
                "d_qoy": "quarter(d)",
                "d_day_name": pick("n + 4", DAYS),
                "d_quarter_name": "cast(year(d) as string) || 'Q' || cast(quarter(d) as string)",
            },
        ),
    ),
    "time_dim": Derived(
        "range:86400",
        (
            {
                "t_time_sk": "id",
                "t_hour": idiv("id", 3600),
                "t_minute": f"{idiv('id', 60)} % 60",
                "t_meal_time": f"case when {idiv('id', 3600)} between 6 and 8 then 'breakfast' when {idiv('id', 3600)} between 11 and 13 then 'lunch' "
                f"when {idiv('id', 3600)} between 17 and 19 then 'dinner' end",
            },
        ),
    ),
    "promotion": Derived(
        "range:30",
        ({"p_promo_sk": "id", "p_channel_dmail": pick("id", ["Y", "N"]), "p_channel_email": pick(idiv("id", 2), ["N", "Y", "N"]),
          "p_channel_tv": pick("id", ["N", "N", "Y"]), "p_channel_event": pick("id", ["N", "Y"])},),
    ),
    "reason": Derived("range:35", ({"r_reason_sk": "id", "r_reason_desc": "'reason ' || cast(id as string)"},)),
    "ship_mode": Derived("range:20", ({"sm_ship_mode_sk": "id", "sm_type": pick("id", ["EXPRESS", "OVERNIGHT", "REGULAR", "TWO DAY", "LIBRARY"]),
                                       "sm_carrier": pick(idiv("id", 2), ["DHL", "BARIAN", "UPS", "FEDEX", "USPS"])},)),
    "warehouse": _outlet("w", "w_warehouse_sk", "w", 5, {"w_warehouse_name": "'Warehouse of the region ' || cast(id as string)", "w_warehouse_sq_ft": "100000 + id*50000"}),
    "call_center": _outlet("cc", "cc_call_center_sk", "cc", 6, {"cc_call_center_id": code("CC", "id"), "cc_name": "'center ' || cast(id as string)", "cc_manager": pick("id", FIRST)}),
    "web_site": _outlet("web", "web_site_sk", "web", 30, {"web_site_id": code("SITE", idiv("id", 2)), "web_name": "'site_' || cast(" + idiv("id", 6) + " as string)", "web_company_name": pick("id", ["pri", "able", "ought", "bar"])}),
    "web_page": Derived("range:60", ({"wp_web_page_sk": "id", "wp_char_count": "3000 + id*70"},)),
    "catalog_page": Derived("range:100", ({"cp_catalog_page_sk": "id", "cp_catalog_page_id": code("PAGE", idiv("id", 2))},)),
}

# --- Retail warehouse ---------------------------------------------------------

RETAIL_CATEGORIES = ["Kitchen", "Software", "Digital Software", "CE", "DVD", "Toys", "Shoes", "Apparel", "Furniture", "Beauty",
                     "Home", "Books", "Games", "Music", "Grocery", "Automotive", "Tools", "Garden", "Baby", "Office"]
STATUS = ["Shipped", "Shipped", "Delivered", "Pending", "Canceled", "Returned", "Shipped"]
# Every 16th order is placed at midnight, where BETWEEN ... AND date matters.
CLOCK = "case when ok % 16 = 0 then 0 else (ok*3607) % 86400 end"
HAS_SHIPPED = "(ok + ln) % 7 not in (3, 4)"

RETAIL = {
    "order_lineitems": Derived(
        "lineitem",
        (
            {"ok": "l_orderkey", "ln": "l_linenumber", "pk": "l_partkey", "sk": "l_suppkey", "day": "l_shipdate",
             "qty": "cast(l_quantity as int)", "price": "cast(l_extendedprice as decimal(10,2))",
             "tax": "cast(l_extendedprice * l_tax as decimal(15,5))", "disc": "cast(l_extendedprice * l_discount as decimal(15,5))"},
            {
                "order_id": code("O", "ok", 12),
                "order_item_id": "ok*10000000 + pk*10 + ln",
                "product_id": "pk",
                "product_name": "'product ' || cast(pk as string)",
                "customer_id": idiv("ok", 10),
                "store_id": "sk",
                "item_shipment_status_code": pick("ok + ln", STATUS),
                # The stored day of the time: what a scan is pruned by.
                "order_day": "day",
                "order_datetime": f"day + @secs({CLOCK})",
                "ship_datetime": f"case when {HAS_SHIPPED} then day + @secs(86400*((ok*5 + ln) % 8) + 90000) end",
                "product_category_id": "pk % 20",
                "product_category_name": pick("pk", RETAIL_CATEGORIES),
                "tax_amount": "tax",
                "item_quantity": "qty",
                "item_price": "price",
                "discount_amount": "disc",
            },
        ),
    ),
    "retail_orders": Derived(
        "orders",
        (
            {"ok": "o_orderkey", "ck": "o_custkey", "day": "o_orderdate", "o_totalprice": "o_totalprice"},
            {
                "order_id": code("O", "ok", 12),
                "customer_id": "ck",
                "order_day": "day",
                "order_datetime": f"day + @secs({CLOCK})",
                "ship_completion_datetime": "case when ok % 11 <> 3 then day + @secs(86400*((ok*5) % 9) + 43200) end",
                "total_paid_amount": "cast(o_totalprice as decimal(15,5))",
            },
        ),
    ),
    "products_dim": Derived(
        "part",
        ({"product_id": "p_partkey", "category_id": "p_partkey % 20", "price": "cast(p_retailprice as decimal(15,2))",
          "product_name": "'product ' || cast(p_partkey as string)"},),
    ),
    "categories_dim": Derived("range:20", ({"category_id": "id", "category_name": pick("id", RETAIL_CATEGORIES)},)),
    # One to five address versions per customer; the last one is open.
    "customer_addresses_dim": Derived(
        "customer",
        (
            {
                "customer_id": "c_custkey",
                "version": "version",
                "state_code": pick("c_custkey*3 + version", STATES),
                "valid_from_timestamp": "cast(@date(cast(8800 + c_custkey % 97 + version*700 as int)) as timestamp_ntz)",
                "valid_to_timestamp": "case when version < c_custkey % 5 then cast(@date(cast(8800 + c_custkey % 97 + (version + 1)*700 as int)) as timestamp_ntz) end",
            },
        ),
        times=("version", "1 + c_custkey % 5"),
    ),
}

# --- Benchmark runs and telemetry ------------------------------------------------

#: Queries of one run, over its workloads.
RUN_QUERIES = 24 * 22

MONITOR = {
    # One row per executed action of a run.
    "test_result": Derived(
        "events",
        (
            {
                "tr_id": "cast(101 + event_id % 6 as int)",
                "s_id": "cast(user_id % 24 as int)",
                # The key-distributed twin of a randomly distributed scenario.
                "adj_s_id": "cast((user_id % 24 + 1) % 24 as int)",
                "action_type": "case when event_id % 5 = 0 then 'Loading' else 'Execution' end",
                "action_target": "case when event_id % 40 = 7 then 'QUERY_STREAM' else 'query_' || lpad(cast(event_id % 22 + 1 as string), 2, '0') end",
                "stream": "cast(event_id % 3 as int)",
                "status": "case when event_id % 97 = 3 then 'ERROR' when event_id % 61 = 5 then 'SKIP' else 'SUCCESS' end",
                "start_time": "ts",
                "duration": "cast(floor(value * 10) as bigint) + event_id % 7",
            },
        ),
    ),
    "test_baseline": Derived(
        "events",
        (
            {
                "storage_version": "case when event_id % 2 = 0 then 'S1' else 'S2' end",
                "engine_version": "case when event_id % 2 = 0 then 'E1' else 'E2' end",
                "s_id": "cast(user_id % 24 as int)",
                "adj_s_id": "cast((user_id % 24 + 1) % 24 as int)",
                "action_type": "case when event_id % 5 = 0 then 'Loading' else 'Execution' end",
                "action_target": "'query_' || lpad(cast(event_id % 22 + 1 as string), 2, '0')",
                "stream": "cast(event_id % 3 as int)",
                "status": "case when event_id % 53 = 5 then 'SKIP' else 'SUCCESS' end",
                "duration": "cast(floor(value * 9) as bigint) + event_id % 11",
            },
        ),
        where="user_id % 24 <> 23",
    ),
    "scenario": Derived("range:24", ({"s_id": "cast(id as int)", "wl_id": "cast(id as int)"},)),
    "workload": Derived(
        "range:24",
        (
            {
                "wl_id": "cast(id as int)",
                "wl_name": "'WL_' || lpad(cast(id as string), 2, '0')",
                "wl_category": pick("id", ["TPCH", "TPCDS", "RETAIL"]),
                "wl_disrandomly": "id % 2 = 1",
                "wl_orientation": pick("id", ["ROW", "COLUMN", "PARQUET"]),
                "wl_compression_type": pick(idiv("id", 3), ["NONE", "SNAPPY", "GZIP"]),
                "wl_partitions": "cast(id % 4 as int)",
                "wl_concurrency": "cast(case when id % 3 = 0 then 4 else 1 end as int)",
            },
        ),
    ),
    # A parameter tried over a range of runs.
    "parameters": Derived("range:6", ({"param_value": pick(idiv("id", 2), ["SEG4", "SEG8", "SEG12"]), "run_id": "cast(101 + id as int)", "param_name": pick(idiv("id", 4), ["SEG_NUM", "MEMORY"])},)),
    # Two runs follow each other, each over half of the events, so that they grow with the
    # table, and number their connections anew. A connection runs for 50 samples and holds
    # two timed queries; the workloads of a run and their queries follow each other too.
    "run_spans": Derived(
        "events",
        (
            {
                "run_id": f"cast(1 + {idiv('event_id', 'run_events')} as int)",
                "wl_name": f"'WL_' || lpad(cast({idiv('event_id % run_events * 24', 'run_events')} as string), 2, '0') || case when {idiv('event_id % run_events * 24', 'run_events')} % 3 = 0 then '_CONCURRENT' else '' end",
                "action_type": "case when event_id % 125 = 0 then 'Loading' else 'Execution' end",
                "action_target": f"'query_' || lpad(cast({idiv(f'event_id % run_events * {RUN_QUERIES}', 'run_events')} % 22 + 1 as string), 2, '0')",
                "stream": "cast(event_id % 3 as int)",
                "con_id": idiv("event_id % run_events", 50),
                "status": "case when event_id % 175 = 0 then 'SKIP' else 'SUCCESS' end",
                "start_time": "ts",
                "end_time": "ts + @secs(600 + (event_id * 37) % 5000)",
            },
        ),
        where="event_id % 25 = 0",
    ),
    "worker_samples": Derived(
        "events",
        (
            {
                "run_id": f"cast(1 + {idiv('event_id', 'run_events')} as int)",
                "hostname": "'w' || cast(1 + user_id % 8 as string)",
                "timeslot": "cast(floor(date_diff_s / 60) as bigint)",
                "real_time": "ts",
                "con_id": idiv("event_id % run_events", 50),
                "seg_id": "'seg' || cast(event_id % 4 as string)",
                "slice": "'slice' || cast(event_id % 3 as string)",
                "rss": "cast((cast(floor(value * 10) as bigint) + process * 37) * 0.01 as decimal(8,2))",
                "pmem": "cast((event_id * 7 + user_id) % 200 * 0.1 as decimal(4,1))",
                "pcpu": "cast((event_id * 13 + user_id) % 900 * 0.1 as decimal(4,1))",
            },
        ),
        times=("process", "1 + event_id % 3"),
    ),
    "master_samples": Derived(
        "events",
        (
            {
                "run_id": f"cast(1 + {idiv('event_id', 'run_events')} as int)",
                "hostname": "'mst1'",
                "timeslot": "cast(floor(date_diff_s / 60) as bigint)",
                "real_time": "ts",
                "con_id": idiv("event_id % run_events", 50),
                "rss": "cast(cast(floor(value * 7) as bigint) * 0.01 as decimal(8,2))",
                "pmem": "cast((event_id * 3 + user_id) % 100 * 0.1 as decimal(4,1))",
                "pcpu": "cast((event_id * 11 + user_id) % 300 * 0.1 as decimal(4,1))",
            },
        ),
        where="event_id % 2 = 0",
    ),
    # Process list lines in three layouts, and lines that are none of them.
    "process_lines": Derived(
        "events",
        (
            {
                "hostname": "'w' || cast(1 + user_id % 8 as string)",
                "timeslot": "event_id",
                "line": "cast(1000 + event_id as string) || '  ' || cast((event_id * 13) % 90 as string) || '.5 650000 ' || "
                "case when event_id % 31 = 4 then 'n/a' else cast(10000 + event_id * 3 as string) end || ' 0.' || cast(event_id % 10 as string) || "
                "' S server: port 40000, user db 127.0.0.1(' || cast(user_id as string) || ') con' || cast(" + idiv("event_id", 50) + " as string) || ' ' || "
                "case event_id % 5 when 0 then 'seg1 idle' when 1 then 'seg0 cmd6 MPPEXEC INSERT' when 2 then 'seg2 cmd2 slice1 MPPEXEC SELECT' "
                "when 3 then 'writer process' else 'seg3 cmd4 slice2 MPPEXEC' end",
            },
        ),
    ),
    # Activity snapshots: a running query shows once in every snapshot.
    "activity": Derived(
        "events",
        ({"sess_id": "user_id", "query_no": idiv("event_id", 400), "user_name": "event_type", "snapshot": "ts"},),
    ),
    "log_lines": Derived(
        "events",
        (
            {
                "host": "'w' || cast(1 + user_id % 8 as string)",
                "logged": "ts",
                "message": "case event_type when 'error' then case when event_id % 2 = 0 then 'ERROR: relation missing' else 'fatal: connection lost' end "
                "when 'signup' then case when event_id % 4 = 0 then 'WARNING: disk slow, will fail over' else 'session opened' end "
                "when 'purchase' then case when event_id % 16 = 1 then 'PANIC: exception in writer' else 'commit' end else 'statement done' end",
            },
        ),
    ),
    # Gauges of a host: an idle share, memory, and byte rates.
    "gauges": Derived(
        "events",
        (
            {
                "host": "'w' || cast(1 + user_id % 8 as string)",
                "slot": idiv("event_id", 8),
                "cpu_idle": "cast((event_id * 17 + user_id) % 1000 * 0.1 as double)",
                "mem_total": "cast(67108864 as double)",
                "mem_cached": "cast(8000000 + (event_id * 101) % 4000000 as double)",
                # Free memory falls as the run goes on.
                "mem_free": "cast(30000000 - (event_id % 10000) * 400 - (user_id * 997) % 1000000 as double)",
                "bytes_written": "cast((event_id * 7919) % 400000000 as double)",
                "bytes_read": "cast((event_id * 104729) % 300000000 as double)",
                "bytes_out": "cast((event_id * 1299709) % 150000000 as double)",
                "bytes_in": "cast((event_id * 15485863) % 120000000 as double)",
                "disk_used": "cast((event_id * 3 + user_id) % 101 as int)",
                "disk_path": "'/data' || cast(event_id % 4 as string)",
            },
        ),
    ),
}
for _name in ("run_spans", "worker_samples", "master_samples"):
    _d = MONITOR[_name]
    _keep = {c: c for c in ("event_id", "ts", "user_id", "value")}
    _keep |= {_d.times[0]: _d.times[0]} if _d.times else {}
    MONITOR[_name] = Derived(_d.base, ({**_keep, "date_diff_s": "@epoch(ts)", "run_events": "@run_events"}, *_d.stages), _d.where, _d.times)
