"""Bronze -> Silver builders: clean, cast, de-duplicate, enrich.

Each builder is a pure function from Bronze DataFrame(s) to the Silver DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.config import GEO_BOX, UNKNOWN_CATEGORY
from strata.functions.columns import day_diff, money_sum
from strata.operators.cleaning import (cast_columns, clean_strings, require_keys, upper_columns,
                                       within_box)
from strata.operators.dedupe import dedupe
from strata.operators.joins import attach_group_total, lookup

ORDER_TIMESTAMPS = ["order_purchase_timestamp", "order_approved_at",
                    "order_delivered_carrier_date", "order_delivered_customer_date",
                    "order_estimated_delivery_date"]


def orders(bronze: DataFrame) -> DataFrame:
    """Trimmed, typed orders with a key, ``order_duration_days``; one row per order_id."""
    # A NULL raw key stays NULL after trimming: filtering it first lets the scan skip it.
    df = clean_strings(bronze.where(F.col("order_id").isNotNull()))
    df = cast_columns(df, {c: "timestamp" for c in ORDER_TIMESTAMPS})
    df = require_keys(df, ["order_id"])
    df = df.withColumn("order_duration_days",
                       day_diff("order_delivered_customer_date", "order_purchase_timestamp"))
    return dedupe(df, ["order_id"])


def order_items(bronze: DataFrame) -> DataFrame:
    """Typed order items; one row per (order_id, order_item_id)."""
    df = cast_columns(clean_strings(bronze), {
        "price": "double", "freight_value": "double",
        "shipping_limit_date": "timestamp", "order_item_id": "int"})
    return dedupe(df, ["order_id", "order_item_id"])


def customers(bronze: DataFrame) -> DataFrame:
    """Upper-case state; one row per customer_id."""
    return dedupe(upper_columns(clean_strings(bronze), ["customer_state"]), ["customer_id"])


def products(bronze: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with their English category name (``UNKNOWN_CATEGORY`` when missing)."""
    names = clean_strings(translation).select("product_category_name",
                                              "product_category_name_english")
    df = lookup(clean_strings(bronze), names, "product_category_name",
                {"product_category_name_english": UNKNOWN_CATEGORY})
    return dedupe(df, ["product_id"])


def sellers(bronze: DataFrame) -> DataFrame:
    """Upper-case state; one row per seller_id."""
    return dedupe(upper_columns(clean_strings(bronze), ["seller_state"]), ["seller_id"])


def typed_payments(bronze: DataFrame) -> DataFrame:
    return cast_columns(clean_strings(bronze), {
        "payment_value": "double", "payment_sequential": "int", "payment_installments": "int"})


def payments_without_total(bronze: DataFrame) -> DataFrame:
    """One row per (order_id, payment_sequential): what the payment fact and the payment types
    need, without the pass over the payments that the order's total takes."""
    return dedupe(typed_payments(bronze), ["order_id", "payment_sequential"])


def order_payments(bronze: DataFrame) -> DataFrame:
    """Typed payments with ``total_payment_value`` per order.

    The total is taken over the rows *before* de-duplication (a repeated payment
    counts twice), as in the reference. De-duplication runs on the composite key
    and the totals are joined afterwards (hot orders salted): a hot order_id then
    never has to sit in one window partition or one join task.
    """
    df = typed_payments(bronze)
    kept = dedupe(df, ["order_id", "payment_sequential"])
    return attach_group_total(kept, df, "order_id", money_sum("payment_value"),
                              "total_payment_value")


def order_reviews(bronze: DataFrame) -> DataFrame:
    """Typed reviews; one row per review_id."""
    df = cast_columns(clean_strings(bronze), {
        "review_score": "int", "review_creation_date": "timestamp",
        "review_answer_timestamp": "timestamp"})
    return dedupe(df, ["review_id"])


def geolocation(bronze: DataFrame, lat_range: tuple[float, float] = GEO_BOX["lat"],
                lng_range: tuple[float, float] = GEO_BOX["lng"]) -> DataFrame:
    """Points inside the box (filter first), then one row per ZIP prefix."""
    df = cast_columns(clean_strings(bronze), {"geolocation_lat": "double",
                                              "geolocation_lng": "double"})
    df = within_box(df, "geolocation_lat", "geolocation_lng", lat_range, lng_range)
    return dedupe(df, ["geolocation_zip_code_prefix"])


BUILDERS = {
    "orders": lambda b: orders(b["orders"]),
    "order_items": lambda b: order_items(b["order_items"]),
    "customers": lambda b: customers(b["customers"]),
    "products": lambda b: products(b["products"], b["category_translation"]),
    "sellers": lambda b: sellers(b["sellers"]),
    "order_payments": lambda b: order_payments(b["order_payments"]),
    "order_reviews": lambda b: order_reviews(b["order_reviews"]),
    "geolocation": lambda b: geolocation(b["geolocation"]),
}
