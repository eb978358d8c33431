"""Star joins with plain aggregation: one fact, filtered dimensions, one group."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import mean, ordered, ratio, total, when
from tidemark.plans.tpcds.common import (
    Tables, any_of, by_day, dates, join, latency, sold,
)


def _brand_sales(t: Tables, items: str, days: str, *order: str):
    facts = join(sold(t, "store_sales", days, "d_year"), t["item"].filter(items), "ss_item_sk = i_item_sk")
    return facts.groupBy("d_year", "i_brand_id", "i_brand").agg(total("ss_ext_sales_price").alias("ext_price"))


def q03(t: Tables, manufact: int = 28, month: int = 11):
    out = _brand_sales(t, f"i_manufact_id = {manufact}", f"d_moy = {month}")
    return ordered(out, "d_year", "-ext_price", "i_brand_id", "i_brand", limit=100)


def q52(t: Tables, manager: int = 1, year: int = 1998, month: int = 11):
    out = _brand_sales(t, f"i_manager_id = {manager}", f"d_moy = {month} and d_year = {year}")
    return ordered(out, "d_year", "-ext_price", "i_brand_id", "i_brand", limit=100)


def q55(t: Tables, manager: int = 28, year: int = 1999, month: int = 11):
    out = _brand_sales(t, f"i_manager_id = {manager}", f"d_moy = {month} and d_year = {year}").drop("d_year")
    return ordered(out, "-ext_price", "i_brand_id", "i_brand", limit=100)


def q42(t: Tables, manager: int = 1, year: int = 1998, month: int = 11):
    facts = join(sold(t, "store_sales", f"d_moy = {month} and d_year = {year}", "d_year"),
                 t["item"].filter(f"i_manager_id = {manager}"), "ss_item_sk = i_item_sk")
    out = facts.groupBy("d_year", "i_category_id", "i_category").agg(total("ss_ext_sales_price").alias("sales"))
    return ordered(out, "-sales", "d_year", "i_category_id", "i_category", limit=100)


PERSON = "cd_gender = 'M' and cd_marital_status = 'S' and cd_education_status = 'College'"


def _four_means(p: str):
    return [
        mean(f"{p}_quantity").alias("agg1"), mean(f"{p}_list_price").alias("agg2"),
        mean(f"{p}_coupon_amt").alias("agg3"), mean(f"{p}_sales_price").alias("agg4"),
    ]


def _promoted(t: Tables, table: str, p: str, demo: str, year: int, person: str):
    people = t["customer_demographics"].filter(person).select("cd_demo_sk")
    promos = t["promotion"].filter("p_channel_email = 'N' or p_channel_event = 'N'").select("p_promo_sk")
    facts = join(join(sold(t, table, f"d_year = {year}"), people, f"{demo} = cd_demo_sk"), promos, f"{p}_promo_sk = p_promo_sk")
    out = join(facts, t["item"], f"{p}_item_sk = i_item_sk").groupBy("i_item_id").agg(*_four_means(p))
    return ordered(out, "i_item_id", limit=100)


def q07(t: Tables, year: int = 1998, person: str = PERSON):
    return _promoted(t, "store_sales", "ss", "ss_cdemo_sk", year, person)


def q26(t: Tables, year: int = 1998, person: str = PERSON):
    return _promoted(t, "catalog_sales", "cs", "cs_bill_cdemo_sk", year, person)


STATE_PROFIT = (  # states, least and greatest net profit
    "ca_state in ('TX', 'OH') and ss_net_profit between 100 and 2000",
    "ca_state in ('GA', 'NM', 'KY') and ss_net_profit between 150 and 3000",
    "ca_state in ('VA', 'TX', 'TN') and ss_net_profit between 50 and 2500",
)
PEOPLE_PRICE = (
    "cd_marital_status = 'M' and cd_education_status = 'Advanced Degree' and ss_sales_price between 100 and 150 and hd_dep_count = 3",
    "cd_marital_status = 'S' and cd_education_status = 'College' and ss_sales_price between 50 and 100 and hd_dep_count = 1",
    "cd_marital_status = 'W' and cd_education_status = '2 yr Degree' and ss_sales_price between 20 and 200 and hd_dep_count = 1",
)


def q13(t: Tables, year: int = 1998, people=PEOPLE_PRICE, places=STATE_PROFIT):
    """The equi keys are common to all arms of the disjunctions: they are joined
    once and the arms stay as filters."""
    facts = sold(t, "store_sales", f"d_year = {year}").filter("ss_store_sk is not null")
    facts = join(facts, t["customer_demographics"], "ss_cdemo_sk = cd_demo_sk")
    facts = join(facts, t["household_demographics"], "ss_hdemo_sk = hd_demo_sk").filter(any_of(people))
    facts = join(facts, t["customer_address"].filter("ca_country = 'United States'"), "ss_addr_sk = ca_address_sk").filter(any_of(places))
    facts = join(facts, t["store"].select("s_store_sk"), "ss_store_sk = s_store_sk")
    return facts.agg(
        mean("ss_quantity").alias("avg_quantity"), mean("ss_ext_sales_price").alias("avg_price"),
        mean("ss_ext_wholesale_cost").alias("avg_cost"), total("ss_ext_wholesale_cost").alias("sum_cost"),
    )


PRICE_BANDS = (
    "cd_marital_status = 'M' and cd_education_status = 'Advanced Degree' and ss_sales_price between 100 and 150",
    "cd_marital_status = 'M' and cd_education_status = 'Advanced Degree' and ss_sales_price between 50 and 100",
    "cd_marital_status = 'M' and cd_education_status = 'Advanced Degree' and ss_sales_price between 150 and 200",
)


def q48(t: Tables, year: int = 1998, people=PRICE_BANDS, places=STATE_PROFIT):
    facts = join(sold(t, "store_sales", f"d_year = {year}"), t["customer_demographics"], "ss_cdemo_sk = cd_demo_sk").filter(any_of(people))
    facts = join(facts, t["customer_address"].filter("ca_country = 'United States'"), "ss_addr_sk = ca_address_sk").filter(any_of(places))
    return join(facts, t["store"].select("s_store_sk"), "ss_store_sk = s_store_sk").agg(F.sum("ss_quantity").alias("quantity"))


ZIPS = ("10000", "10370", "11110", "12220", "13330", "14440", "15550", "16660", "10555")


def q15(t: Tables, year: int = 1998, quarter: int = 2, zips=ZIPS, states=("CA", "GA"), price: int = 150):
    facts = sold(t, "catalog_sales", f"d_qoy = {quarter} and d_year = {year}")
    people = join(t["customer"], t["customer_address"], "c_current_addr_sk = ca_address_sk").select("c_customer_sk", "ca_zip", "ca_state")
    mine = join(facts, people, "cs_bill_customer_sk = c_customer_sk").filter(
        F.substring("ca_zip", 1, 5).isin(*zips) | F.col("ca_state").isin(*states) | (F.col("cs_sales_price") > price))
    return ordered(mine.groupBy("ca_zip").agg(total("cs_sales_price").alias("sales")), "ca_zip", limit=100)


def q45(t: Tables, year: int = 1998, quarter: int = 2, zips=ZIPS, items=(2, 3, 5, 7, 11, 13, 17, 19, 23, 29)):
    """A zip list or the item ids of ten items: the ids become a flag on item."""
    listed = t["item"].filter(F.col("i_item_sk").isin(*items)).select(F.col("i_item_id").alias("listed_id")).distinct()
    flagged = join(t["item"].select("i_item_sk", "i_item_id"), F.broadcast(listed), "i_item_id = listed_id", "left")
    facts = join(sold(t, "web_sales", f"d_qoy = {quarter} and d_year = {year}"), flagged, "ws_item_sk = i_item_sk")
    people = join(t["customer"], t["customer_address"], "c_current_addr_sk = ca_address_sk").select("c_customer_sk", "ca_zip")
    mine = join(facts, people, "ws_bill_customer_sk = c_customer_sk").filter(
        F.substring("ca_zip", 1, 5).isin(*zips) | F.col("listed_id").isNotNull())
    return ordered(mine.groupBy("ca_zip").agg(total("ws_sales_price").alias("sales")), "ca_zip", limit=100)


def q19(t: Tables, manager: int = 8, year: int = 1998, month: int = 11):
    items = t["item"].filter(f"i_manager_id = {manager}")
    facts = join(sold(t, "store_sales", f"d_moy = {month} and d_year = {year}"), items, "ss_item_sk = i_item_sk")
    people = join(t["customer"], t["customer_address"], "c_current_addr_sk = ca_address_sk").select("c_customer_sk", "ca_zip")
    facts = join(join(facts, people, "ss_customer_sk = c_customer_sk"), t["store"],
                 "ss_store_sk = s_store_sk and substring(ca_zip, 1, 5) <> substring(s_zip, 1, 5)")
    out = facts.groupBy("i_brand", "i_brand_id", "i_manufact_id", "i_manufact").agg(total("ss_ext_sales_price").alias("ext_price"))
    return ordered(out, "-ext_price", "i_brand", "i_brand_id", "i_manufact_id", "i_manufact", limit=100)


def q06(t: Tables, year: int = 1998, month: int = 1, factor: float = 1.2, least: int = 10):
    dear = t["item"].groupBy(F.col("i_category").alias("cat")).agg((F.lit(factor) * mean("i_current_price")).alias("bound"))
    items = join(t["item"], dear, "i_category = cat and cast(i_current_price as double) > bound").select("i_item_sk")
    seq = t["date_dim"].filter(f"d_year = {year} and d_moy = {month}").agg(F.max("d_month_seq")).scalar()
    facts = join(sold(t, "store_sales", F.col("d_month_seq") == seq), items, "ss_item_sk = i_item_sk")
    people = join(t["customer"], t["customer_address"], "c_current_addr_sk = ca_address_sk").select("c_customer_sk", "ca_state")
    out = join(facts, people, "ss_customer_sk = c_customer_sk").groupBy("ca_state").agg(F.count("*").alias("cnt"))
    return ordered(out.filter(F.col("cnt") >= least), "cnt", "ca_state", limit=100)


def q43(t: Tables, offset: int = -5, year: int = 1998):
    stores = t["store"].filter(f"s_gmt_offset = {offset}")
    facts = join(sold(t, "store_sales", f"d_year = {year}", "d_day_name"), stores, "ss_store_sk = s_store_sk")
    out = facts.groupBy("s_store_name", "s_store_id").agg(*[c for c in by_day("ss_sales_price")])
    out = out.select("s_store_name", "s_store_id", *[F.col(c).cast("double").alias(c) for c in out.columns[2:]])
    return ordered(out, "s_store_name", "s_store_id", *out.columns[2:], limit=100)


def q61(t: Tables, category: str = "Jewelry", offset: int = -7, days: str = "d_year = 1998"):
    """Promotional and all sales are conditional sums of one pass."""
    stores = t["store"].filter(f"s_gmt_offset = {offset}").select("s_store_sk")
    items = t["item"].filter(F.col("i_category") == category).select("i_item_sk")
    here = t["customer_address"].filter(f"ca_gmt_offset = {offset}").select("ca_address_sk")
    people = join(t["customer"], here, "c_current_addr_sk = ca_address_sk", "left_semi").select("c_customer_sk")
    facts = join(join(sold(t, "store_sales", days), items, "ss_item_sk = i_item_sk"), stores, "ss_store_sk = s_store_sk")
    facts = join(join(facts, people, "ss_customer_sk = c_customer_sk"), t["promotion"], "ss_promo_sk = p_promo_sk", "left")
    promoted = "p_channel_dmail = 'Y' or p_channel_email = 'Y' or p_channel_tv = 'Y'"
    out = facts.agg(total(when(promoted, "ss_ext_sales_price")).alias("promotions"), total("ss_ext_sales_price").alias("total"))
    return out.withColumn("share", ratio("promotions", "total") * 100)


def _shipping(t: Tables, table: str, p: str, outlet, key: str, outlet_name: str, year: int):
    facts = join(t[table], dates(t, f"d_year = {year}"), f"{p}_ship_date_sk = d_date_sk")
    facts = join(facts, F.broadcast(t["ship_mode"]), f"{p}_ship_mode_sk = sm_ship_mode_sk")
    facts = join(join(facts, t["warehouse"], f"{p}_warehouse_sk = w_warehouse_sk"), outlet, key)
    out = facts.groupBy(F.substring("w_warehouse_name", 1, 20).alias("warehouse"), "sm_type", outlet_name).agg(
        *latency(f"{p}_ship_date_sk", f"{p}_sold_date_sk"))
    return ordered(out, "warehouse", "sm_type", outlet_name, limit=100)


def q62(t: Tables, year: int = 1998):
    return _shipping(t, "web_sales", "ws", t["web_site"], "ws_web_site_sk = web_site_sk", "web_name", year)


def q99(t: Tables, year: int = 1998):
    return _shipping(t, "catalog_sales", "cs", t["call_center"], "cs_call_center_sk = cc_call_center_sk", "cc_name", year)


HALF_HOURS = tuple((8 + (h + 1) // 2, 30 * ((h + 1) % 2)) for h in range(8))  # 8:30 to 12:00


def q88(t: Tables, store: str = "ese", slots=HALF_HOURS):
    """Eight counts of half hours, as conditional counts of one pass."""
    homes = t["household_demographics"].filter(any_of(
        [f"hd_dep_count = {n} and hd_vehicle_count <= {n + 2}" for n in (4, 2, 0)])).select("hd_demo_sk")
    times = F.broadcast(t["time_dim"].filter("t_hour between 8 and 12").select("t_time_sk", "t_hour", "t_minute"))
    facts = join(join(t["store_sales"], times, "ss_sold_time_sk = t_time_sk"), homes, "ss_hdemo_sk = hd_demo_sk")
    facts = join(facts, t["store"].filter(F.col("s_store_name") == store).select("s_store_sk"), "ss_store_sk = s_store_sk")
    return facts.agg(*[
        F.count(when(f"t_hour = {h} and t_minute between {m} and {m + 29}", "1")).alias(f"h{h}_{m:02d}") for h, m in slots])


def q96(t: Tables, store: str = "ese", hour: int = 20, dependants: int = 7):
    homes = t["household_demographics"].filter(f"hd_dep_count = {dependants}").select("hd_demo_sk")
    times = F.broadcast(t["time_dim"].filter(f"t_hour = {hour} and t_minute >= 30").select("t_time_sk"))
    facts = join(join(t["store_sales"], times, "ss_sold_time_sk = t_time_sk"), homes, "ss_hdemo_sk = hd_demo_sk")
    return join(facts, t["store"].filter(F.col("s_store_name") == store).select("s_store_sk"), "ss_store_sk = s_store_sk").agg(F.count("*").alias("n"))


def q90(t: Tables, morning: int = 8, evening: int = 19, dependants: int = 6, chars=(5000, 6000)):
    homes = t["household_demographics"].filter(f"hd_dep_count = {dependants}").select("hd_demo_sk")
    pages = t["web_page"].filter(F.col("wp_char_count").between(*chars)).select("wp_web_page_sk")
    am, pm = f"t_hour between {morning} and {morning + 1}", f"t_hour between {evening} and {evening + 1}"
    times = F.broadcast(t["time_dim"].filter(f"({am}) or ({pm})").select("t_time_sk", "t_hour"))
    facts = join(join(t["web_sales"], times, "ws_sold_time_sk = t_time_sk"), homes, "ws_ship_hdemo_sk = hd_demo_sk")
    facts = join(facts, pages, "ws_web_page_sk = wp_web_page_sk")
    return facts.agg(ratio(F.count(when(am, "1")), F.count(when(pm, "1"))).alias("am_pm_ratio"))


BANDS_09 = ((1, 10, 2972), (11, 20, 4000), (21, 30, 9999999), (31, 40, 100), (41, 50, 9999999))


def q09(t: Tables, bands=BANDS_09, reason: int = 1):
    """Fifteen scalar subqueries as one conditional pass over the fact."""
    aggs = []
    for i, (low, high, least) in enumerate(bands, 1):
        band = f"ss_quantity between {low} and {high}"
        aggs.append(F.when(F.count(when(band, "1")) > least, mean(when(band, "ss_ext_discount_amt")))
                    .otherwise(mean(when(band, "ss_net_paid"))).alias(f"bucket{i}"))
    # The reason table only has to hold the one row asked for.
    return t["store_sales"].agg(*aggs).filter(t["reason"].filter(f"r_reason_sk = {reason}").exists())


BANDS_28 = (  # quantity from, to; list price, coupon and wholesale cost from
    (0, 5, 8, 459, 57), (6, 10, 90, 2323, 31), (11, 15, 142, 12214, 79),
    (16, 20, 135, 6071, 38), (21, 25, 122, 836, 17), (26, 30, 154, 7326, 7),
)


def q28(t: Tables, bands=BANDS_28):
    """Six disjoint bands: band number as the group, then one row. The distinct
    prices are counted per band in the same two-phase aggregation."""
    arm = F.lit(None).cast("int")
    for i, (low, high, price, coupon, cost) in reversed(list(enumerate(bands, 1))):
        arm = F.when(F.expr(
            f"ss_quantity between {low} and {high} and (ss_list_price between {price} and {price + 10} "
            f"or ss_coupon_amt between {coupon} and {coupon + 1000} or ss_wholesale_cost between {cost} and {cost + 20})"), F.lit(i)).otherwise(arm)
    banded = t["store_sales"].select(arm.alias("band"), "ss_list_price").filter("band is not null")
    per_price = banded.groupBy("band", "ss_list_price").agg(F.count("*").alias("n"))
    aggs = []
    for i in range(1, len(bands) + 1):
        mine = F.col("band") == i
        n = F.sum(F.when(mine, F.col("n")))
        worth = F.sum(F.when(mine, F.expr("ss_list_price * n"))).cast("double")
        aggs += [F.try_divide(worth, n).alias(f"b{i}_lp"), F.coalesce(n, F.lit(0)).alias(f"b{i}_cnt"),
                 F.count(F.when(mine, F.lit(1))).alias(f"b{i}_cntd")]
    return per_price.agg(*aggs)


def q91(t: Tables, days: str = "d_year between 1996 and 2001", offset: int = -7):
    people = t["customer_demographics"].filter(
        "(cd_marital_status = 'M' and cd_education_status = 'Unknown') or (cd_marital_status = 'W' and cd_education_status = 'Advanced Degree')"
    ).select("cd_demo_sk", "cd_marital_status", "cd_education_status")
    homes = t["household_demographics"].filter("hd_buy_potential like 'Unknown%'").select("hd_demo_sk")
    here = t["customer_address"].filter(f"ca_gmt_offset = {offset}").select("ca_address_sk")
    who = join(join(t["customer"], people, "c_current_cdemo_sk = cd_demo_sk"), homes, "c_current_hdemo_sk = hd_demo_sk")
    who = join(who, here, "c_current_addr_sk = ca_address_sk").select("c_customer_sk", "cd_marital_status", "cd_education_status")
    back = join(t["catalog_returns"], dates(t, days), "cr_returned_date_sk = d_date_sk")
    facts = join(join(back, who, "cr_returning_customer_sk = c_customer_sk"), t["call_center"], "cr_call_center_sk = cc_call_center_sk")
    out = facts.groupBy("cc_call_center_id", "cc_name", "cc_manager", "cd_marital_status", "cd_education_status").agg(
        total("cr_net_loss").alias("returns_loss"))
    return ordered(out.drop("cd_marital_status", "cd_education_status"), "-returns_loss")


def q84(t: Tables, city: str = "Edgewood", income: int = 38128):
    homes = join(t["household_demographics"], F.broadcast(t["income_band"].filter(
        f"ib_lower_bound >= {income} and ib_upper_bound <= {income + 50000}")), "hd_income_band_sk = ib_income_band_sk").select("hd_demo_sk")
    here = t["customer_address"].filter(F.col("ca_city") == city).select("ca_address_sk")
    who = join(join(t["customer"], here, "c_current_addr_sk = ca_address_sk"), homes, "c_current_hdemo_sk = hd_demo_sk")
    # Each return of the demographic group repeats the customer's row.
    back = t["store_returns"].groupBy("sr_cdemo_sk").agg(F.count("*").alias("times"))
    out = join(who, back, "c_current_cdemo_sk = sr_cdemo_sk").select(
        F.col("c_customer_id").alias("customer_id"),
        F.concat("c_last_name", F.lit(", "), "c_first_name").alias("customername"),
        F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("i"))
    return ordered(out.drop("i"), "customer_id", "customername", limit=100)


def q41(t: Tables, low: int = 8, high: int = 48):
    """Products of manufacturers which make one of the listed combinations."""
    combos = (
        ("Women", ("powder", "khaki"), ("Ounce", "Oz"), ("medium", "extra large")),
        ("Women", ("brown", "honeydew"), ("Bunch", "Ton"), ("N/A", "small")),
        ("Men", ("orange", "frosted"), ("Dozen", "Box"), ("petite", "large")),
        ("Men", ("slate", "medium"), ("Box", "Pound"), ("medium", "extra large")),
        ("Women", ("slate", "sienna"), ("Pound", "Each"), ("medium", "extra large")),
        ("Men", ("purple", "medium"), ("Each", "Ounce"), ("petite", "large")),
    )
    match = F.lit(False)
    for category, colors, units, sizes in combos:
        match = match | ((F.col("i_category") == category) & F.col("i_color").isin(*colors) & F.col("i_units").isin(*units) & F.col("i_size").isin(*sizes))
    makers = t["item"].filter(match).select(F.col("i_manufact").alias("maker"))
    items = t["item"].filter(F.col("i_manufact_id").between(low, high))
    out = join(items, makers, "i_manufact = maker", "left_semi").select("i_product_name").distinct()
    return ordered(out, "i_product_name", limit=100)


def q76(t: Tables):
    """Sales whose outlet or address key is missing, by channel."""
    parts = []
    for name, table, p, missing in (("store", "store_sales", "ss", "ss_store_sk"), ("web", "web_sales", "ws", "ws_ship_customer_sk"),
                                    ("catalog", "catalog_sales", "cs", "cs_ship_addr_sk")):
        parts.append(t[table].filter(F.col(missing).isNull()).select(
            F.lit(name).alias("channel"), F.lit(missing).alias("col_name"), F.col(f"{p}_sold_date_sk").alias("date_sk"),
            F.col(f"{p}_item_sk").alias("item_sk"), F.col(f"{p}_ext_sales_price").alias("price")))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    rows = join(join(rows, dates(t, "true", "d_year", "d_qoy"), "date_sk = d_date_sk"), t["item"], "item_sk = i_item_sk")
    keys = ["channel", "col_name", "d_year", "d_qoy", "i_category"]
    out = rows.groupBy(*keys).agg(F.count("*").alias("sales_cnt"), total("price").alias("sales_amt"))
    return ordered(out, *keys, limit=100)


def q66(t: Tables, year: int = 1998, start: int = 28800, seconds: int = 36000, carriers=("DHL", "BARIAN")):
    """Monthly web and catalog sales per warehouse, in one pass of conditional sums.

    Time keys are seconds of the day, so the range needs no time table.
    """
    months = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
    parts = []
    for table, p, price, net in (("web_sales", "ws", "ext_sales_price", "net_paid"), ("catalog_sales", "cs", "sales_price", "net_paid_inc_tax")):
        parts.append(t[table].filter(F.col(f"{p}_sold_time_sk").between(start, start + seconds)).select(
            F.col(f"{p}_sold_date_sk").alias("date_sk"), F.col(f"{p}_ship_mode_sk").alias("mode_sk"), F.col(f"{p}_warehouse_sk").alias("wh_sk"),
            F.expr(f"{p}_{price} * {p}_quantity").alias("sales"), F.expr(f"{p}_{net} * {p}_quantity").alias("net")))
    rows = join(parts[0].unionByName(parts[1]), dates(t, f"d_year = {year}", "d_year", "d_moy"), "date_sk = d_date_sk")
    modes = F.broadcast(t["ship_mode"].filter(F.col("sm_carrier").isin(*carriers)).select("sm_ship_mode_sk"))
    rows = join(join(rows, modes, "mode_sk = sm_ship_mode_sk"), t["warehouse"], "wh_sk = w_warehouse_sk")
    place = ["w_warehouse_name", "w_warehouse_sq_ft", "w_city", "w_county", "w_state", "w_country"]
    monthly = rows.groupBy(*place, F.col("d_year").alias("year")).agg(*[
        total(F.when(F.col("d_moy") == i, F.col(c)).otherwise(F.lit(0))).alias(f"{m}_{c}")
        for c in ("sales", "net") for i, m in enumerate(months, 1)])
    per_foot = [(F.col(f"{m}_sales") / F.col("w_warehouse_sq_ft")).alias(f"{m}_sales_per_sq_foot") for m in months]
    out = monthly.select(*place, F.lit(",".join(carriers)).alias("ship_carriers"), "year",
                         *[f"{m}_sales" for m in months], *per_foot, *[f"{m}_net" for m in months])
    return ordered(out, "w_warehouse_name", limit=100)


def q71(t: Tables, manager: int = 1, year: int = 1998, month: int = 11):
    """Brand sales by minute at meal times, over all channels."""
    parts = [t[table].select(F.col(f"{p}_ext_sales_price").alias("price"), F.col(f"{p}_sold_date_sk").alias("date_sk"),
                             F.col(f"{p}_item_sk").alias("item_sk"), F.col(f"{p}_sold_time_sk").alias("time_sk"))
             for table, p in (("web_sales", "ws"), ("catalog_sales", "cs"), ("store_sales", "ss"))]
    rows = join(parts[0].unionByName(parts[1]).unionByName(parts[2]), dates(t, f"d_moy = {month} and d_year = {year}"), "date_sk = d_date_sk")
    rows = join(rows, t["item"].filter(f"i_manager_id = {manager}"), "item_sk = i_item_sk")
    meals = F.broadcast(t["time_dim"].filter("t_meal_time in ('breakfast', 'dinner')").select("t_time_sk", "t_hour", "t_minute"))
    out = join(rows, meals, "time_sk = t_time_sk").groupBy("i_brand_id", "i_brand", "t_hour", "t_minute").agg(total("price").alias("ext_price"))
    return ordered(out, "-ext_price", "i_brand_id", "i_brand", "t_hour", "t_minute")
