"""The generated retail star as stored tables.

Dimensions, the order base and the order items are plain tables, each made once from those
before it. Lines draw addresses, e-mails and items themselves from the customers and the
order base, so that these are not stored for them. The facts are stored in months, weeks and an open span, as far as the first load
goes; what it holds out waits in files, a folder per day, for the replay. A fact is written
in one pass; orders and shipments are made from the lines where they are stored.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import retail_star
from tidemark.plans.retail_star import RetailConfig
from tidemark.sources.layout import joins_by_some_keys
from tidemark.sources.shared import new_folder
from tidemark.sources.spans import CODEC, Grains, SpanFact
from tidemark.streaming import replay

#: Time and key of each fact.
FACTS = {"lines": ("order_datetime", "order_item_id"), "orders": ("order_datetime", "order_id"), "shipments": ("order_datetime", "order_item_id")}
MONTHLY_END = "2010-01-01"


def preload_grains(cfg: RetailConfig) -> Grains:
    """Months, then weeks up to the end of the first load, then one span for the rest."""
    return Grains(cfg.first_day, MONTHLY_END, cfg.preload_end, str(dt.date.fromisoformat(cfg.last_day) + dt.timedelta(days=1)))


#: How each table is made from the seed lists and earlier tables.
MAKERS: dict[str, Callable[[StarStore], DataFrame]] = {
    "calendar": lambda s: retail_star.calendar(s.spark, s.cfg.first_day, s.cfg.last_day),
    "customers": lambda s: retail_star.customers(s.spark, s.seeds["first_names"], s.seeds["surnames"]),
    "categories": lambda s: retail_star.categories(s.seeds["products"]),
    "products": lambda s: retail_star.products(s.seeds["products"], s.table("categories")),
    "emails": lambda s: retail_star.emails(s.table("customers"), s.seeds["websites"], s.cfg.seed),
    "addresses": lambda s: retail_star.addresses(s.table("customers"), s.seeds["zips"], s.seeds["streets"], s.cfg),
    "day_factors": lambda s: retail_star.day_factors(s.spark, s.cfg),
    "lifetimes": lambda s: retail_star.lifetimes(s.table("customers"), s.cfg),
    "daily": lambda s: retail_star.daily_customers(s.table("lifetimes"), s.table("day_factors"), s.cfg),
    "orders_base": lambda s: retail_star.order_base(s.table("daily"), s.cfg),
    "items": lambda s: retail_star.order_items(s.table("orders_base"), s.table("products").count(), s.cfg),
}


def _lines(star: StarStore) -> DataFrame:
    """What a customer's row or an order's alone tells is drawn here again and not read back."""
    people, orders = star.table("customers"), star.table("orders_base")
    # dealt once: the parts of a customer's profile then meet where they are drawn
    people = people.repartition(retail_star.tasks_for(star.spark, people.count(), retail_star.MOST_PEOPLE), "customer_id")
    addrs = retail_star.addresses(people, star.seeds["zips"], star.seeds["streets"], star.cfg)
    mails = retail_star.emails(people, star.seeds["websites"], star.cfg.seed)
    items = retail_star.order_items(orders, star.table("products").count(), star.cfg)
    return retail_star.line_items(orders, items, star.table("products"), star.table("categories"), people, addrs, mails, star.seeds["taxes"])


#: The rows of each fact, and whether they lie gathered by time.
FACT_MAKERS: dict[str, tuple[Callable[[StarStore], DataFrame], bool]] = {
    "lines": (_lines, True),
    "orders": (lambda s: retail_star.orders_of(s.whole("lines")), False),
    "shipments": (lambda s: retail_star.shipments(s.whole("lines"), s.cfg), True),
}


@dataclass
class StarStore:
    """A star that is stored as its tables are asked for, in a folder of its own."""

    spark: SparkSession
    seeds: Mapping[str, DataFrame]
    cfg: RetailConfig
    folder: str = ""
    _tables: dict[str, DataFrame] = field(default_factory=dict)
    _facts: dict[str, SpanFact] = field(default_factory=dict)

    def __post_init__(self):
        self.folder = self.folder or new_folder(self.spark, "star")

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            rows = MAKERS[name](self)
            rows.write.mode("overwrite").option("compression", CODEC).parquet(f"{self.folder}/{name}")
            self._tables[name] = self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{name}")
        return self._tables[name]

    def fact(self, name: str) -> SpanFact:
        """A fact as the first load leaves it; its held-out rows are put aside."""
        if name not in self._facts:
            (ts, key), (made, gathered) = FACTS[name], FACT_MAKERS[name]
            with joins_by_some_keys(self.spark):
                self._facts[name] = SpanFact.create_apart(
                    made(self), _table_name(self.folder, name), ts, key, preload_grains(self.cfg), self.cfg.preload_end,
                    f"{self.folder}/facts/{name}", f"{self.folder}/held-out/{name}", replay.DAY, gathered=gathered)
        return self._facts[name]

    def held_out(self, name: str) -> DataFrame:
        schema = self.fact(name).rows().schema
        return self.spark.read.schema(schema).parquet(f"{self.folder}/held-out/{name}").select(*schema.names)

    def whole(self, name: str) -> DataFrame:
        return self.fact(name).rows().unionByName(self.held_out(name))

    def replayed(self, name: str, steps: int, fresh: str) -> SpanFact:
        """A copy of a fact below the folder `fresh`, to which the held-out days were delivered
        in so many steps and loaded by a stream."""
        fact, spark = self.fact(name), self.spark
        copy = SpanFact.create(fact.rows(), _table_name(fresh, name), fact.ts, fact.key, fact.grains(), path=f"{fresh}/facts/{name}", gathered=True)
        waiting, inbox = f"{fresh}/waiting/{name}", f"{fresh}/inbox/{name}"
        replay.hold_out(self.held_out(name), fact.ts, waiting)
        days = -(-len(replay.days_held(spark, waiting)) // steps)
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fact.rows().schema.fields)
        while replay.deliver(spark, waiting, inbox, days):
            replay.replay(spark, inbox, schema, copy, f"{fresh}/checkpoints/{name}").awaitTermination()
        return copy


def _table_name(folder: str, name: str) -> str:
    return f"{folder.rsplit('/', 1)[1].replace('-', '_')}_{name}"
