"""Totals over hierarchies: rollups, ranks within a parent, means of means."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from tidemark.functions.columns import mean, ordered, ratio, total
from tidemark.plans.tpcds.common import Tables, dates, join, sold


def _sums(columns: dict[str, str]):
    """Sum and count per mean, which add up over grains."""
    out = []
    for name, c in columns.items():
        out += [F.sum(F.expr(c)).alias(f"{name}_s"), F.count(F.expr(c)).alias(f"{name}_n")]
    return out


def _means(columns):
    return [F.try_divide(F.sum(f"{name}_s").cast("double"), F.sum(f"{name}_n")).alias(name) for name in columns]


def _mean_of_means(names):
    """Unweighted mean of the finest grain's means, as exact decimals."""
    return [mean(F.col(n).cast("decimal(24,9)")).alias(n) for n in names]


def rollup_means(facts, keys: list[str], columns: dict[str, str], extra=()):
    """Means at every grain. The rows are aggregated once at the finest grain;
    only those few are expanded into the coarser ones."""
    return facts.groupBy(*keys).agg(*_sums(columns)).rollup(*keys).agg(*_means(columns), *extra)


def union_means(facts, keys: list[str], columns: dict[str, str], extra=()):
    """As the unioned grains have it: coarser grains average the finest means."""
    finest = facts.groupBy(*keys).agg(*[mean(c).alias(n) for n, c in columns.items()])
    return finest.rollup(*keys).agg(*_mean_of_means(columns), *extra)


FOUR = ("quantity", "list_price", "coupon_amt", "sales_price")


def _q18_facts(t: Tables, year: int, months, states, education: str):
    demo = t["customer_demographics"].filter(f"cd_gender = 'F' and cd_education_status = '{education}'").select("cd_demo_sk", "cd_dep_count")
    facts = join(sold(t, "catalog_sales", f"d_year = {year}"), demo, "cs_bill_cdemo_sk = cd_demo_sk")
    people = join(t["customer"].filter(F.col("c_birth_month").isin(*months)), t["customer_demographics"].select(F.col("cd_demo_sk").alias("own_sk")),
                  "c_current_cdemo_sk = own_sk", "left_semi")
    people = join(people, t["customer_address"].filter(F.col("ca_state").isin(*states)), "c_current_addr_sk = ca_address_sk").select(
        "c_customer_sk", "c_birth_year", "ca_country", "ca_state", "ca_county")
    return join(join(facts, people, "cs_bill_customer_sk = c_customer_sk"), t["item"], "cs_item_sk = i_item_sk")


KEYS_18 = ["i_item_id", "ca_country", "ca_state", "ca_county"]
MEANS_18 = {f"agg{i}": c for i, c in enumerate((*[f"cs_{c}" for c in FOUR], "cs_net_profit", "c_birth_year", "cd_dep_count"), 1)}
ORDER_18 = ["ca_country", "ca_state", "ca_county", "i_item_id"]
ARGS_18 = dict(year=1998, months=(1, 6, 8, 9, 12, 2), states=("GA", "TX", "OH", "NM", "VA", "TN"), education="Unknown")


def q18(t: Tables, **args):
    return ordered(rollup_means(_q18_facts(t, **{**ARGS_18, **args}), KEYS_18, MEANS_18), *ORDER_18, limit=100)


def q18a(t: Tables, **args):
    return ordered(union_means(_q18_facts(t, **{**ARGS_18, **args}), KEYS_18, MEANS_18), *ORDER_18, limit=100)


def _q22_facts(t: Tables, year: int):
    facts = join(t["inventory"], dates(t, f"d_year = {year}"), "inv_date_sk = d_date_sk")
    # Stock is aggregated per item before the item's attributes are attached.
    per = join(facts, t["warehouse"].select("w_warehouse_sk"), "inv_warehouse_sk = w_warehouse_sk").groupBy("inv_item_sk").agg(
        F.sum("inv_quantity_on_hand").alias("qoh_s"), F.count("inv_quantity_on_hand").alias("qoh_n"))
    return join(per, t["item"], "inv_item_sk = i_item_sk")


KEYS_22 = ["i_product_name", "i_brand", "i_class", "i_category"]


def q22(t: Tables, year: int = 1999):
    out = _q22_facts(t, year).rollup(*KEYS_22).agg(F.try_divide(F.sum("qoh_s").cast("double"), F.sum("qoh_n")).alias("qoh"))
    return ordered(out, "qoh", *KEYS_22, limit=100)


def q22a(t: Tables, year: int = 1999):
    """The coarser grains add the finest grain's averages up."""
    finest = _q22_facts(t, year).groupBy(*KEYS_22).agg(F.try_divide(F.sum("qoh_s").cast("double"), F.sum("qoh_n")).cast("decimal(24,9)").alias("a"))
    return ordered(finest.rollup(*KEYS_22).agg(total("a").alias("qoh")), "qoh", *KEYS_22, limit=100)


def _q27_facts(t: Tables, year: int, states, person: str):
    demo = t["customer_demographics"].filter(person).select("cd_demo_sk")
    facts = join(sold(t, "store_sales", f"d_year = {year}"), demo, "ss_cdemo_sk = cd_demo_sk")
    facts = join(facts, t["store"].filter(F.col("s_state").isin(*states)), "ss_store_sk = s_store_sk")
    return join(facts, t["item"], "ss_item_sk = i_item_sk")


MEANS_27 = {f"agg{i}": f"ss_{c}" for i, c in enumerate(FOUR, 1)}
ARGS_27 = dict(year=1998, states=("TN", "GA", "TX"), person="cd_gender = 'M' and cd_marital_status = 'S'")


def q27(t: Tables, **args):
    out = rollup_means(_q27_facts(t, **{**ARGS_27, **args}), ["i_item_id", "s_state"], MEANS_27, [F.grouping("s_state").cast("int").alias("g_state")])
    return ordered(out, "i_item_id", "s_state", limit=100)


def q27a(t: Tables, **args):
    out = union_means(_q27_facts(t, **{**ARGS_27, **args}), ["i_item_id", "s_state"], MEANS_27, [F.grouping("s_state").cast("int").alias("g_state")])
    return ordered(out, "i_item_id", "s_state", limit=100)


def _within_parent(rows, value: str, parent: str, order):
    """Rank within the hierarchy level, and at the lowest one within the parent."""
    w = W.partitionBy("lochierarchy", F.when(F.col("lochierarchy") == 0, F.col(parent))).orderBy(order)
    out = rows.withColumn("rank_within_parent", F.rank().over(w)).withColumn("own", F.when(F.col("lochierarchy") == 0, F.col(parent)))
    return out


def _levels(per, upper: str, lower: str, sums: dict[str, str]):
    """A two-column rollup with its level: 0 lowest, 2 the grand total."""
    level = F.grouping(upper).cast("int") + F.grouping(lower).cast("int")
    return per.rollup(upper, lower).agg(*[F.sum(c).alias(n) for n, c in sums.items()], level.alias("lochierarchy"))


def _margins(t: Tables, year: int, states):
    facts = join(sold(t, "store_sales", f"d_year = {year}"), t["store"].filter(F.col("s_state").isin(*states)), "ss_store_sk = s_store_sk")
    return join(facts, t["item"], "ss_item_sk = i_item_sk").groupBy("i_category", "i_class").agg(
        F.sum("ss_net_profit").alias("profit"), F.sum("ss_ext_sales_price").alias("price"))


def q36(t: Tables, year: int = 1998, states=("TN", "GA", "TX")):
    """Without grains every category and class is its own partition."""
    per = _margins(t, year, states).withColumn("gross_margin", ratio("profit", "price"))
    w = W.partitionBy("i_category", "i_class").orderBy(F.col("gross_margin").asc_nulls_last())
    out = per.select("gross_margin", "i_category", "i_class", F.rank().over(w).alias("rank_within_parent"))
    return ordered(out, "rank_within_parent", "i_category", "i_class", limit=100)


def q36a(t: Tables, year: int = 1998, states=("TN", "GA", "TX")):
    rows = _levels(_margins(t, year, states), "i_category", "i_class", {"p": "profit", "s": "price"}).withColumn("gross_margin", ratio("p", "s"))
    out = _within_parent(rows, "gross_margin", "i_category", F.col("gross_margin").asc_nulls_last())
    out = ordered(out, "-lochierarchy", "own", "rank_within_parent", "i_category", "i_class", limit=100)
    return out.select("gross_margin", "i_category", "i_class", "lochierarchy", "rank_within_parent")


def _state_profit(t: Tables, year: int):
    facts = join(sold(t, "store_sales", f"d_year = {year}"), t["store"], "ss_store_sk = s_store_sk")
    per = facts.groupBy("s_state", "s_county").agg(F.sum("ss_net_profit").alias("total"))
    # The ranking is within each state, so every state with sales is among its first five.
    states = per.groupBy("s_state").agg(F.sum("total").alias("x"))
    best = states.withColumn("r", F.rank().over(W.partitionBy("s_state").orderBy(F.desc("x")))).filter("r <= 5").select("s_state")
    return per.join(best, "s_state", "left_semi")


def q70(t: Tables, year: int = 1998):
    w = W.partitionBy("s_state", "s_county").orderBy(F.desc("total"))
    out = _state_profit(t, year).select(F.col("total").cast("double").alias("total_sum"), "s_state", "s_county", F.rank().over(w).alias("rank_within_parent"))
    return ordered(out, "rank_within_parent", "s_state", "s_county", limit=100)


def q70a(t: Tables, year: int = 1998):
    rows = _levels(_state_profit(t, year), "s_state", "s_county", {"total": "total"})
    out = _within_parent(rows, "total", "s_state", F.col("total").desc_nulls_first())
    out = ordered(out, "-lochierarchy", "own", "rank_within_parent", "s_state", "s_county")
    return out.select(F.col("total").cast("double").alias("total_sum"), "s_state", "s_county", "lochierarchy", "rank_within_parent")


def _web_paid(t: Tables, year: int):
    return join(sold(t, "web_sales", f"d_year = {year}"), t["item"], "ws_item_sk = i_item_sk").groupBy("i_category", "i_class").agg(F.sum("ws_net_paid").alias("total"))


def q86(t: Tables, year: int = 1998):
    w = W.partitionBy("i_category", "i_class").orderBy(F.desc("total"))
    out = _web_paid(t, year).select(F.col("total").cast("double").alias("total_sum"), "i_category", "i_class", F.rank().over(w).alias("rank_within_parent"))
    return ordered(out, "rank_within_parent", "i_category", "i_class", limit=100)


def q86a(t: Tables, year: int = 1998):
    rows = _levels(_web_paid(t, year), "i_category", "i_class", {"total": "total"})
    out = _within_parent(rows, "total", "i_category", F.col("total").desc_nulls_first())
    out = ordered(out, "-lochierarchy", "own", "rank_within_parent", "i_category", "i_class", limit=100)
    return out.select(F.col("total").cast("double").alias("total_sum"), "i_category", "i_class", "lochierarchy", "rank_within_parent")


KEYS_67 = ["i_category", "i_class", "i_brand", "i_product_name", "d_year", "d_qoy", "d_moy", "s_store_id"]


def q67(t: Tables, year: int = 1998, n: int = 100):
    """The hundred best sums per category over eight grains. The rank bound
    reaches below the shuffle, so no task sees more than its first rows."""
    facts = join(join(sold(t, "store_sales", f"d_year = {year}", "d_year", "d_qoy", "d_moy"), t["store"], "ss_store_sk = s_store_sk"), t["item"], "ss_item_sk = i_item_sk")
    finest = facts.groupBy(*KEYS_67).agg(F.sum(F.expr("coalesce(ss_sales_price * ss_quantity, 0)")).alias("x"))
    grains = finest.rollup(*KEYS_67).agg(total("x").alias("sumsales"))
    ranked = grains.withColumn("rk", F.rank().over(W.partitionBy("i_category").orderBy(F.desc("sumsales")))).filter(F.col("rk") <= n)
    return ordered(ranked, *KEYS_67, "sumsales", "rk", limit=100)


def q67a(t: Tables, year: int = 1998):
    """The unioned grains are the same rollup: sums of sums are the sums."""
    return q67(t, year)
