"""Binding of the driver's test tables to the nine raw retail sources.

The reference consumes nine retail CSV files; the test harness provides
TPC-H-like tables instead. This module derives, with Spark, one raw frame per
retail source from those tables, so the real layer builders run over them and
their work grows with the tables:

=====================  ===============================================================
retail source          derived from
=====================  ===============================================================
orders                 orders; delivery = last ship date of its items, carrier pick-up
                       = first ship date, estimate = order date + 30 days; times as text
order_items            lineitem (price = extended price, freight = price x tax)
customers              customer + nation (state = nation name, person = customer name)
products               part (category = size as text)
category_translation   nation (key as text -> name)
sellers                supplier + nation
order_payments         events (order = user, sequence = event id, installments = JSON k)
order_reviews          orders (score = first character of the priority, a comment only
                       on finished orders)
geolocation            embeddings (ZIP prefix = label, lat/lng = first two dimensions)
=====================  ===============================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.lazy import LazyFrames

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Box used with the embeddings binding (its first two dimensions lie within about +-0.4).
EMBEDDING_BOX = {"lat": (-0.2, 0.2), "lng": (-0.2, 0.2)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text_time(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def raw_sources(spark: SparkSession, sf_dir: str) -> LazyFrames:
    t = LazyFrames({n: (lambda n=n: table(spark, sf_dir, n)) for n in TABLES})

    def nation_names() -> DataFrame:
        return t["nation"].select("n_nationkey", F.lower("n_name").alias("__state"))

    def raw_orders() -> DataFrame:
        orders = t["orders"]
        shipped = t["lineitem"].groupBy("l_orderkey").agg(F.min("l_shipdate").alias("__first"),
                                                          F.max("l_shipdate").alias("__last"))
        return (orders.join(shipped, orders["o_orderkey"] == shipped["l_orderkey"], "left")
                .select(F.col("o_orderkey").alias("order_id"),
                        F.col("o_custkey").alias("customer_id"),
                        F.col("o_orderstatus").alias("order_status"),
                        _text_time("o_orderdate").alias("order_purchase_timestamp"),
                        _text_time("o_orderdate").alias("order_approved_at"),
                        _text_time("__first").alias("order_delivered_carrier_date"),
                        _text_time("__last").alias("order_delivered_customer_date"),
                        _text_time(F.col("o_orderdate") + F.expr("interval 30 days"))
                        .alias("order_estimated_delivery_date")))

    def raw_items() -> DataFrame:
        return t["lineitem"].select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
            _text_time("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"))

    def raw_customers() -> DataFrame:
        customer, names = t["customer"], nation_names()
        return (customer.join(names, customer["c_nationkey"] == names["n_nationkey"], "left")
                .select(F.col("c_custkey").alias("customer_id"),
                        F.col("c_name").alias("customer_unique_id"),
                        F.lpad(F.col("c_nationkey").cast("string"), 5, "0")
                        .alias("customer_zip_code_prefix"),
                        F.lower("c_mktsegment").alias("customer_city"),
                        F.col("__state").alias("customer_state")))

    def raw_products() -> DataFrame:
        return t["part"].select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_size").cast("string").alias("product_category_name"),
            F.col("p_retailprice").alias("product_weight_g"),
            F.col("p_size").cast("double").alias("product_length_cm"),
            F.length("p_name").cast("double").alias("product_height_cm"),
            F.length("p_brand").cast("double").alias("product_width_cm"))

    def raw_translation() -> DataFrame:
        return t["nation"].select(
            F.col("n_nationkey").cast("string").alias("product_category_name"),
            F.lower("n_name").alias("product_category_name_english"))

    def raw_sellers() -> DataFrame:
        supplier, names = t["supplier"], nation_names()
        return (supplier.join(names, supplier["s_nationkey"] == names["n_nationkey"], "left")
                .select(F.col("s_suppkey").alias("seller_id"),
                        F.lpad(F.col("s_nationkey").cast("string"), 5, "0")
                        .alias("seller_zip_code_prefix"),
                        F.col("s_name").alias("seller_city"),
                        F.col("__state").alias("seller_state")))

    def raw_payments() -> DataFrame:
        return t["events"].select(
            F.col("user_id").alias("order_id"), F.col("event_id").alias("payment_sequential"),
            F.col("event_type").alias("payment_type"),
            F.get_json_object("props", "$.k").alias("payment_installments"),
            F.col("value").alias("payment_value"))

    def raw_reviews() -> DataFrame:
        return t["orders"].select(
            F.col("o_orderkey").alias("review_id"), F.col("o_orderkey").alias("order_id"),
            F.substring("o_orderpriority", 1, 1).alias("review_score"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
            .alias("review_comment_message"),
            _text_time("o_orderdate").alias("review_creation_date"),
            _text_time(F.col("o_orderdate") + F.expr("interval 1 day"))
            .alias("review_answer_timestamp"))

    def raw_geo() -> DataFrame:
        return t["embeddings"].select(
            F.col("label").alias("geolocation_zip_code_prefix"),
            F.col("embedding")[0].cast("double").alias("geolocation_lat"),
            F.col("embedding")[1].cast("double").alias("geolocation_lng"))

    return LazyFrames({
        "orders": raw_orders, "order_items": raw_items, "customers": raw_customers,
        "products": raw_products, "category_translation": raw_translation,
        "sellers": raw_sellers, "order_payments": raw_payments, "order_reviews": raw_reviews,
        "geolocation": raw_geo,
    })
