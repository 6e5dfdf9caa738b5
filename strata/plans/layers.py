"""Wiring of the layers as lazy DataFrames: raw -> Bronze -> Silver -> Gold -> Platinum.

``Layers`` builds each table on first use and memoises the DataFrame (not its
data), so asking for one mart plans only what that mart needs.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import CALENDAR_SPAN
from strata.functions.columns import blank_to_null, to_timestamp
from strata.plans import dims, facts, marts, silver
from strata.plans.bronze import bronze
from strata.session import cut_lineage


class Layers:
    """``keep`` names Silver tables that are written once (to the shared folder) when first
    asked for, for plans that read them several times."""

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame],
                 calendar_span: tuple[str, str] | None = CALENDAR_SPAN, geo_box: dict | None = None,
                 keep: Collection[str] = ()):
        self.spark = spark
        self.raw = raw
        self.calendar_span = calendar_span
        self.geo_box = geo_box
        self.keep = keep
        self._memo: dict[str, DataFrame] = {}
        self._bronze: Mapping[str, DataFrame] | None = None

    def _get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    # ---- bronze / silver -----------------------------------------------------------
    @property
    def bronze(self) -> Mapping[str, DataFrame]:
        if self._bronze is None:
            self._bronze = bronze(self.raw)
        return self._bronze

    def silver(self, name: str) -> DataFrame:
        if name == "geolocation" and self.geo_box:
            return self._get("silver.geolocation", lambda: silver.geolocation(
                self.bronze["geolocation"], self.geo_box["lat"], self.geo_box["lng"]))
        build = silver.BUILDERS[name]
        return self._get(f"silver.{name}", lambda: cut_lineage(build(self.bronze))
                         if name in self.keep else build(self.bronze))

    def purchases(self) -> DataFrame:
        """The purchase times of all orders, from their raw column alone: for the ends of the
        calendar no order needs its items, other columns or the removal of its copies."""
        orders = self.bronze["orders"].where(F.col("order_id").isNotNull())
        column = "order_purchase_timestamp"
        return orders.select(to_timestamp(blank_to_null(F.col(column).cast("string"))).alias(column))

    @property
    def payments(self) -> DataFrame:
        """Silver payments without their order's total, which no Gold table uses."""
        return self._get("silver.payments", lambda: silver.payments_without_total(
            self.bronze["order_payments"]))

    # ---- gold / platinum -------------------------------------------------------------
    def gold(self, name: str) -> DataFrame:
        builders = gold_builders(self.spark, self.silver, lambda: self.payments,
                                 self.calendar_span, self.purchases)
        return self._get(f"gold.{name}", builders[name])

    def mart(self, name: str) -> DataFrame:
        return self._get(f"platinum.{name}", mart_builders(
            self.gold, covering=self.calendar_span is None)[name])


Table = Callable[[str], DataFrame]


def gold_builders(spark: SparkSession, silver: Table, payments: Callable[[], DataFrame],
                  span: tuple[str, str] | None,
                  purchases: Callable[[], DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """How each Gold table is built from Silver tables (found by name). Without a ``span`` the
    calendar covers ``purchases``."""
    return {
        "dim_customer": lambda: dims.dim_customer(silver("customers")),
        "dim_product": lambda: dims.dim_product(silver("products")),
        "dim_seller": lambda: dims.dim_seller(silver("sellers")),
        "dim_date": lambda: dims.calendar(spark, span, purchases),
        "dim_payment_type": lambda: dims.dim_payment_type(payments()),
        "fact_orders": lambda: facts.fact_orders(silver("orders"), silver("order_items")),
        "fact_order_items": lambda: facts.fact_order_items(silver("order_items")),
        "fact_reviews": lambda: facts.fact_reviews(silver("order_reviews")),
        "fact_payments": lambda: facts.fact_payments(payments()),
    }


def mart_builders(gold: Table, covering: bool = False) -> dict[str, Callable[[], DataFrame]]:
    """How each mart is built from Gold tables (found by name). ``covering``: the calendar has
    every purchase day, so that it need not be built to find the orders' months."""
    return {
        "mart_monthly_revenue": lambda: marts.monthly_revenue(
            gold("fact_orders"), None if covering else gold("dim_date")),
        "mart_state_performance": lambda: marts.state_performance(gold("fact_orders"),
                                                                  gold("dim_customer")),
        "mart_category_ranking": lambda: marts.category_ranking(gold("fact_order_items"),
                                                                gold("dim_product")),
        "mart_delivery_kpi": lambda: marts.delivery_kpi(gold("fact_orders")),
        "mart_review_by_category": lambda: marts.review_by_category(
            gold("fact_reviews"), gold("fact_order_items"), gold("dim_product")),
        "mart_payment_distribution": lambda: marts.payment_distribution(gold("fact_payments")),
        "mart_customer_retention": lambda: marts.customer_retention(gold("fact_orders"),
                                                                    gold("dim_customer")),
    }


SILVER_TABLES = ["orders", "order_items", "customers", "products", "sellers", "order_payments",
                 "order_reviews", "geolocation"]
DIMENSIONS = ["dim_customer", "dim_product", "dim_seller", "dim_date", "dim_payment_type"]
FACTS = ["fact_orders", "fact_order_items", "fact_reviews", "fact_payments"]
MARTS = ["mart_monthly_revenue", "mart_state_performance", "mart_category_ranking",
         "mart_delivery_kpi", "mart_review_by_category", "mart_payment_distribution",
         "mart_customer_retention"]
