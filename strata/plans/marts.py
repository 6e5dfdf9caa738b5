"""Gold -> Platinum marts: small pre-aggregated business tables.

Sorts follow the reference's order, with the group key added as a tie-break so
the order is total. Money totals are exact sums rounded to 2 places (``money_parts``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import merged_parts, money_parts, money_total, pct, round2
from strata.operators.joins import join_keyed


def monthly_revenue(fact_orders: DataFrame, dim_date: DataFrame | None) -> DataFrame:
    """year, month, revenue, order_count (distinct orders) for orders whose purchase day is in
    the calendar; without a calendar, for all that have a purchase day (as with one that covers
    them).

    Orders are summed per purchase day before the calendar is joined, so the join sees a row a
    day. Days add up to months, as an order has one purchase day (one row an order, checked by the
    gates); the distinct count is planned on (day, order), which spreads a day over many tasks."""
    days = fact_orders.where(F.col("purchase_date_id").isNotNull()) \
        .groupBy(F.col("purchase_date_id").alias("date_id")).agg(
            *money_parts("total_revenue").named("__revenue"),
            F.countDistinct("order_id").alias("__orders"))
    if dim_date is None:
        day = F.col("date_id")  # yyyymmdd
        dated = days.withColumns({"year": F.floor(day / 10000).cast("int"),
                                  "month": F.floor(day / 100).cast("int") % 100})
    else:
        dated = days.join(dim_date, "date_id", "inner")
    return (dated.groupBy("year", "month")
            .agg(merged_parts("__revenue").rounded().alias("revenue"),
                 F.sum("__orders").alias("order_count"))
            .orderBy("year", "month"))


def _per_customer(fact_orders: DataFrame) -> DataFrame:
    """Orders summed per customer_id before any join with customers.

    A customer holding a third of all orders is then one row on each side of the
    join (its rows were combined map-side, and its distinct orders counted on
    (customer, order), spread by order), where joining the orders themselves would
    send all of them to one task. Summing these counts per state or person equals
    counting distinct orders there, as each order has one row and so one customer
    in ``fact_orders`` (one row per order_id: built so, checked by the gates).
    """
    return fact_orders.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("__orders"),
        *money_parts("total_revenue").named("__revenue"),
        F.sum("delivery_days").alias("__days"),
        F.count("delivery_days").alias("__delivered"))


def state_performance(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Per customer state: distinct orders, revenue, average delivery days
    (undelivered orders ignored). Orders are aggregated per customer first."""
    return (_per_customer(fact_orders).join(dim_customer, "customer_id", "inner")
            .groupBy("state")
            .agg(F.sum("__orders").alias("order_count"),
                 merged_parts("__revenue").rounded().alias("revenue"),
                 round2(F.try_divide(F.sum("__days").cast("double"), F.sum("__delivered")))
                 .alias("avg_delivery_days"))
            .orderBy(F.desc("order_count"), F.asc("state")))


def category_ranking(fact_items: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Per English category: item revenue and items sold, highest revenue first.

    Items are summed per product before the join, so the join sees one row per
    product instead of one per item."""
    per_product = fact_items.groupBy("product_id").agg(
        *money_parts("price").named("__revenue"),
        F.count(F.lit(1)).alias("__n"))
    return (per_product.join(dim_product, "product_id", "inner")
            .groupBy("category_name_english")
            .agg(merged_parts("__revenue").rounded().alias("revenue"),
                 F.sum("__n").alias("items_sold"))
            .orderBy(F.desc("revenue"), F.asc("category_name_english")))


def delivery_kpi(fact_orders: DataFrame) -> DataFrame:
    """One row: total_orders, avg_delivery_days, late_delivery_rate_pct. The rate
    is over all orders, undelivered ones included."""
    return fact_orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        round2(F.avg("delivery_days")).alias("avg_delivery_days"),
        pct(F.sum(F.col("is_late_delivery").cast("int")), F.count(F.lit(1)))
        .alias("late_delivery_rate_pct"))


def review_by_category(fact_reviews: DataFrame, fact_items: DataFrame,
                       dim_product: DataFrame) -> DataFrame:
    """Per English category: average review score and review count over
    review x item pairs (a review of a 3-item order weighs 3).

    Equal to joining reviews to items to products and aggregating, but each side
    is aggregated first: reviews per order (score sum, scored count, row count) and
    items per (order, product). The pairs are then weighted, not materialised, so
    an order with many items or many reviews never fans out in a shuffle.
    """
    per_order = fact_reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("__s"),
        F.count("review_score").alias("__scored"),
        F.count(F.lit(1)).alias("__rows"))
    per_item = fact_items.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("__k"))
    # an order with very many products is split, not sent to one task
    per_product = (join_keyed(per_item, per_order, "order_id", "inner")
                   .groupBy("product_id")
                   .agg(F.sum(F.col("__s") * F.col("__k")).alias("__s"),
                        F.sum(F.col("__scored") * F.col("__k")).alias("__scored"),
                        F.sum(F.col("__rows") * F.col("__k")).alias("__rows")))
    return (per_product.join(dim_product, "product_id", "inner")
            .groupBy("category_name_english")
            .agg(round2(F.try_divide(F.sum("__s").cast("double"), F.sum("__scored")))
                 .alias("avg_review_score"),
                 F.sum("__rows").alias("review_count"))
            .orderBy(F.desc("avg_review_score"), F.asc("category_name_english")))


def payment_distribution(fact_payments: DataFrame) -> DataFrame:
    """Per payment type: payment count and total value, most used first."""
    return (fact_payments.groupBy("payment_type")
            .agg(F.count(F.lit(1)).alias("payment_count"),
                 money_total("payment_value").alias("total_value"))
            .orderBy(F.desc("payment_count"), F.asc("payment_type")))


def customer_retention(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """One row: total_customers (people, by customer_unique_id), repeat_customers
    (two or more distinct orders) and retention_rate_pct. Orders are aggregated per
    customer first."""
    per_person = (_per_customer(fact_orders).join(dim_customer, "customer_id", "inner")
                  .groupBy("customer_unique_id")
                  .agg(F.sum("__orders").alias("order_count")))
    people, returning = F.count(F.lit(1)), F.count_if(F.col("order_count") >= 2)
    return per_person.agg(people.alias("total_customers"), returning.alias("repeat_customers"),
                          pct(returning, people).alias("retention_rate_pct"))
