"""The three quality suites that gate the layers (Bronze, Silver, Gold)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from strata.config import CHECK_NAMES, PRIMARY_KEYS, PURCHASE_WINDOW
from strata.operators import quality as dq


def bronze_suite(tables: Mapping[str, DataFrame], prefix: str = "bronze.") -> DataFrame:
    """Per table: more than 0 rows, and no NULL in each key column present."""
    results = []
    for name, df in tables.items():
        checks = [dq.row_count_gt(0)] + [dq.not_null(k) for k in PRIMARY_KEYS.get(name, [])
                                         if k in df.columns]
        results.append(dq.run_checks(df, checks, f"{prefix}{name}", "bronze"))
    return dq.combine(results)


def silver_suite(orders: DataFrame, items: DataFrame, reviews: DataFrame,
                 purchase_window: tuple[str, str] = PURCHASE_WINDOW,
                 prefix: str = "silver.") -> DataFrame:
    """Order key present and unique, purchase time inside the window; item key
    unique and price positive; review score 1..5. One pass per table."""
    return dq.combine([
        dq.run_checks(orders, [dq.not_null("order_id"), dq.unique("order_id"),
                               dq.timestamp_in_range("order_purchase_timestamp",
                                                     *purchase_window,
                                                     name=CHECK_NAMES["purchase_window"])],
                      f"{prefix}orders", "silver"),
        dq.run_checks(items, [dq.unique("order_id", "order_item_id"), dq.positive("price")],
                      f"{prefix}order_items", "silver"),
        dq.run_checks(reviews, [dq.between("review_score", 1, 5)],
                      f"{prefix}order_reviews", "silver"),
    ])


def gold_suite(fact_orders: DataFrame, fact_items: DataFrame, dim_customer: DataFrame,
               dim_product: DataFrame, dim_seller: DataFrame, silver_orders: DataFrame,
               prefix: str = "gold.") -> DataFrame:
    """No orphan foreign keys, dimension keys present, one fact row per Silver order."""
    return dq.run_suite([
        (fact_items, [dq.no_orphans("order_id", fact_orders, "order_id"),
                      dq.no_orphans("product_id", dim_product, "product_id"),
                      dq.no_orphans("seller_id", dim_seller, "seller_id")],
         f"{prefix}fact_order_items", "gold"),
        (fact_orders, [dq.no_orphans("customer_id", dim_customer, "customer_id"),
                       dq.row_count_matches(silver_orders, CHECK_NAMES["silver_order_count"])],
         f"{prefix}fact_orders", "gold"),
        (dim_customer, [dq.not_null("customer_id")], f"{prefix}dim_customer", "gold"),
        (dim_product, [dq.not_null("product_id")], f"{prefix}dim_product", "gold"),
    ])


def acceptance_suite(silver_orders: DataFrame, silver_items: DataFrame,
                     silver_reviews: DataFrame, fact_orders: DataFrame, fact_items: DataFrame,
                     dim_customer: DataFrame, silver_prefix: str = "silver.",
                     gold_prefix: str = "gold.") -> DataFrame:
    """The after-run table tests: Silver keys present and unique, review score
    1..5; Gold items without an order, negative order revenue, one fact row per
    Silver order, customer key present. Layer ``tests``; one pass per table, one shuffle.
    ``gate(spark, "tests", ...)`` turns a failure into ``DQError``."""
    return dq.run_suite([
        (silver_orders, [dq.not_null("order_id"), dq.unique("order_id")],
         f"{silver_prefix}orders", "tests"),
        (silver_items, [dq.unique("order_id", "order_item_id")],
         f"{silver_prefix}order_items", "tests"),
        (silver_reviews, [dq.between("review_score", 1, 5)],
         f"{silver_prefix}order_reviews", "tests"),
        (fact_items, [dq.no_orphans("order_id", fact_orders, "order_id")],
         f"{gold_prefix}fact_order_items", "tests"),
        (fact_orders, [dq.non_negative("total_revenue"),
                       dq.row_count_matches(silver_orders, CHECK_NAMES["silver_order_count"])],
         f"{gold_prefix}fact_orders", "tests"),
        (dim_customer, [dq.not_null("customer_id")], f"{gold_prefix}dim_customer", "tests"),
    ])


def source_reconciliation(spark, tables: Mapping[str, DataFrame], directory: str,
                          prefix: str = "bronze.") -> DataFrame | None:
    """Table rows must equal the CSV records of its source file (quoted newlines
    respected); tables whose file is missing are skipped. ``None`` if none exist."""
    from strata.config import SOURCES
    from strata.sources.files import path_exists, read_csv

    results = []
    for name, df in tables.items():
        spec = SOURCES.get(name)
        path = f"{directory.rstrip('/')}/{spec.file_name}" if spec else None
        if path is None or not path_exists(spark, path):
            continue
        records = read_csv(spark, path, spec.schema)
        results.append(dq.run_checks(df, [dq.row_count_matches(records, "rowcount_matches_csv")],
                                     f"{prefix}{name}", "bronze"))
    return dq.combine(results) if results else None
