"""Silver -> Gold dimension builders (star schema)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import CALENDAR_SPAN
from strata.operators.calendar import date_spine, date_spine_covering, with_calendar_columns
from strata.operators.dedupe import dedupe
from strata.operators.keys import dense_surrogate_key


# --- fixed values: the output columns of the dimensions, by source column ---------------
CUSTOMER = {"customer_id": "customer_id", "customer_unique_id": "customer_unique_id",
            "customer_city": "city", "customer_state": "state",
            "customer_zip_code_prefix": "zip_code"}
PRODUCT = {"product_id": "product_id", "product_category_name": "category_name",
           "product_category_name_english": "category_name_english",
           "product_weight_g": "weight_g", "product_length_cm": "length_cm",
           "product_height_cm": "height_cm", "product_width_cm": "width_cm"}
SELLER = {"seller_id": "seller_id", "seller_city": "city", "seller_state": "state",
          "seller_zip_code_prefix": "zip_code"}
# ----------------------------------------------------------------------------------------


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def dim_customer(customers: DataFrame, unique: bool = True) -> DataFrame:
    """Customers by order-level id, with the id of the person behind it for retention.

    Silver customers hold one row per customer_id, so nothing is shuffled here; a frame that
    does not come from Silver is reduced first with ``unique=False``."""
    return _renamed(customers if unique else dedupe(customers, ["customer_id"]), CUSTOMER)


def dim_product(products: DataFrame) -> DataFrame:
    """Products with both category names and their measures."""
    return _renamed(products, PRODUCT)


def dim_seller(sellers: DataFrame) -> DataFrame:
    """Sellers with their place."""
    return _renamed(sellers, SELLER)


def dim_date(spark: SparkSession, start: str = CALENDAR_SPAN[0],
             end: str = CALENDAR_SPAN[1]) -> DataFrame:
    """Calendar rows for every day in ``[start, end]``: date_id (yyyymmdd),
    full_date, year, quarter, month, day, day_of_week (1 = Sunday), is_weekend."""
    return with_calendar_columns(date_spine(spark, start, end))


def dim_date_covering(df: DataFrame, column: str) -> DataFrame:
    """The calendar dimension spanning the dates present in ``df[column]``."""
    return with_calendar_columns(date_spine_covering(df, column))


def calendar(spark: SparkSession, span: tuple[str, str] | None,
             purchases: Callable[[], DataFrame]) -> DataFrame:
    """The calendar of ``span``; without one, of all purchase days, so that no order falls
    outside it."""
    return dim_date(spark, *span) if span else \
        dim_date_covering(purchases(), "order_purchase_timestamp")


def dim_payment_type(payments: DataFrame) -> DataFrame:
    """payment_type_id 1..n by ascending payment_type; NULL types dropped."""
    return dense_surrogate_key(payments, "payment_type", "payment_type_id")
