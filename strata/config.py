"""Source registry: the nine retail sources, their keys and raw schemas.

Everything downstream takes plain DataFrames; this module only names things.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# --- fixed values: names, keys and bounds of the data model, down to the end of SOURCES ----
# Layer namespaces, in pipeline order, plus the one holding quality results.
NAMESPACES = ["bronze", "silver", "gold", "platinum", "meta"]

AUDIT_TIME, AUDIT_FILE = "_ingested_at", "_source_file"
UNKNOWN_CATEGORY = "unknown"
DQ_RESULTS_TABLE = "dq_results"
CHECK_NAMES = {
    "row_count_gt": "row_count_gt_{n}",
    "not_null": "{column}_not_null",
    "unique": "unique_{columns}",
    "between": "{column}_between_{low}_{high}",
    "positive": "{column}_positive",
    "no_orphans": "fk_{child_key}_in_{parent_key}",
    "purchase_window": "purchase_ts_in_range",
    "silver_order_count": "rowcount_matches_silver_orders",
}

GEO_BOX = {"lat": (-35.0, 6.0), "lng": (-75.0, -34.0)}
PURCHASE_WINDOW = ("2016-01-01 00:00:00", "2019-12-31 00:00:00")
CALENDAR_SPAN = ("2016-01-01", "2019-12-31")


def _text(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


def _num(*names: str) -> list[StructField]:
    return [StructField(n, DoubleType(), True) for n in names]


@dataclass(frozen=True)
class SourceSpec:
    """One raw source: where it comes from and how it is keyed.

    ``schema`` is the explicit raw schema used for file reads (no inference pass,
    ZIP prefixes keep leading zeros). Columns that Silver casts arrive as text.
    """

    table: str
    file_name: str
    keys: tuple[str, ...]
    schema: StructType
    partitioned: bool = False
    extra: dict = field(default_factory=dict)


SOURCES: dict[str, SourceSpec] = {
    s.table: s
    for s in [
        SourceSpec("orders", "olist_orders_dataset.csv", ("order_id",), StructType(_text(
            "order_id", "customer_id", "order_status", "order_purchase_timestamp",
            "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date")), True),
        SourceSpec("order_items", "olist_order_items_dataset.csv", ("order_id", "order_item_id"),
                   StructType(_text("order_id", "order_item_id", "product_id", "seller_id",
                                    "shipping_limit_date", "price", "freight_value")), True),
        SourceSpec("customers", "olist_customers_dataset.csv", ("customer_id",), StructType(_text(
            "customer_id", "customer_unique_id", "customer_zip_code_prefix",
            "customer_city", "customer_state"))),
        SourceSpec("products", "olist_products_dataset.csv", ("product_id",), StructType(
            _text("product_id", "product_category_name")
            + _num("product_name_lenght", "product_description_lenght", "product_photos_qty",
                   "product_weight_g", "product_length_cm", "product_height_cm",
                   "product_width_cm"))),
        SourceSpec("sellers", "olist_sellers_dataset.csv", ("seller_id",), StructType(_text(
            "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"))),
        SourceSpec("order_payments", "olist_order_payments_dataset.csv",
                   ("order_id", "payment_sequential"), StructType(_text(
                       "order_id", "payment_sequential", "payment_type",
                       "payment_installments", "payment_value")), True),
        SourceSpec("order_reviews", "olist_order_reviews_dataset.csv", ("review_id",),
                   StructType(_text("review_id", "order_id", "review_score",
                                    "review_comment_title", "review_comment_message",
                                    "review_creation_date", "review_answer_timestamp")), True),
        SourceSpec("geolocation", "olist_geolocation_dataset.csv",
                   ("geolocation_zip_code_prefix",), StructType(_text(
                       "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                       "geolocation_city", "geolocation_state"))),
        SourceSpec("category_translation", "product_category_name_translation.csv",
                   ("product_category_name",), StructType(_text(
                       "product_category_name", "product_category_name_english"))),
    ]
}

PRIMARY_KEYS: dict[str, list[str]] = {name: list(s.keys) for name, s in SOURCES.items()}
