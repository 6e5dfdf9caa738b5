"""Layer builders on hand-made frames: the semantics the driver tables cannot show."""

import datetime as dt

from strata.plans import dims, facts, marts, silver

ORD = ("order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
       "order_approved_at string, order_delivered_carrier_date string, "
       "order_delivered_customer_date string, order_estimated_delivery_date string")


def test_silver_orders(spark):
    rows = [(" o1 ", "c1", "delivered", "2018-01-01 10:00:00", None, None, "2018-01-05 09:00:00",
             "2018-01-04 00:00:00"),
            ("o1", "c1", "delivered", "2018-01-01 10:00:00", None, None, "2018-01-05 09:00:00",
             "2018-01-04 00:00:00"),
            ("   ", "c2", "x", "2018-01-01", None, None, None, None),
            (None, "c3", "x", "2018-01-01", None, None, None, None),
            ("o2", "c2", " ", "garbage", None, None, None, None)]
    out = {r.order_id: r for r in silver.orders(spark.createDataFrame(rows, ORD)).collect()}
    assert set(out) == {"o1", "o2"}
    assert out["o1"].order_duration_days == 4
    assert out["o2"].order_purchase_timestamp is None and out["o2"].order_status is None


def test_silver_payments_total_before_dedupe(spark):
    rows = [("o1", "1", "card", "3", "10.0"), ("o1", "1", "card", "3", "10.0"),
            ("o1", "2", "voucher", "1.0", "5.5"), (None, "1", "card", "x", "1")]
    df = spark.createDataFrame(rows, "order_id string, payment_sequential string, payment_type string, "
                                     "payment_installments string, payment_value string")
    out = sorted((tuple(r) for r in silver.order_payments(df).collect()), key=repr)
    assert out == sorted([("o1", 1, "card", 3, 10.0, 25.5), ("o1", 2, "voucher", 1, 5.5, 25.5),
                          (None, 1, "card", None, 1.0, None)], key=repr)


def test_silver_products_unknown_category(spark):
    prods = spark.createDataFrame([("p1", " cama "), ("p2", "x"), ("p3", None)],
                                  "product_id string, product_category_name string")
    trans = spark.createDataFrame([("cama", "bed")], "product_category_name string, "
                                                     "product_category_name_english string")
    got = {r.product_id: r.product_category_name_english
           for r in silver.products(prods, trans).collect()}
    assert got == {"p1": "bed", "p2": "unknown", "p3": "unknown"}


def test_geolocation_filters_before_dedupe(spark):
    df = spark.createDataFrame([("01001", "-80", "-40"), ("01001", "-10", "-50"), ("2", None, "-50")],
                               "geolocation_zip_code_prefix string, geolocation_lat string, "
                               "geolocation_lng string")
    got = [tuple(r) for r in silver.geolocation(df).collect()]
    assert got == [("01001", -10.0, -50.0)]  # leading zero kept


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id string, customer_id string, order_status string, "
                                       "order_purchase_timestamp timestamp_ntz, "
                                       "order_delivered_customer_date timestamp_ntz, "
                                       "order_estimated_delivery_date timestamp_ntz, "
                                       "order_duration_days int")


def test_fact_orders_and_delivery_kpi(spark):
    d = dt.datetime
    orders = _orders(spark, [
        ("o1", "c1", "delivered", d(2018, 1, 1), d(2018, 1, 10), d(2018, 1, 5), 9),
        ("o2", "c1", "delivered", d(2018, 2, 1), d(2018, 2, 3), d(2018, 2, 5), 2),
        ("o3", "c2", "shipped", d(2018, 3, 1), None, d(2018, 3, 5), None)])
    items = spark.createDataFrame([("o1", 1, "p", "s", 10.0, 1.5), ("o1", 2, "p", "s", 0.1, 0.2),
                                   ("o2", 1, "q", "s", 0.2, 0.0)],
                                  "order_id string, order_item_id int, product_id string, "
                                  "seller_id string, price double, freight_value double")
    fo = facts.fact_orders(orders, items)
    got = {r.order_id: r for r in fo.collect()}
    assert (got["o1"].total_items, got["o1"].total_revenue, got["o1"].freight_total) == (2, 10.1, 1.7)
    assert (got["o3"].total_items, got["o3"].total_revenue) == (0, 0.0)
    assert got["o1"].is_late_delivery is True and got["o2"].is_late_delivery is False
    assert got["o3"].is_late_delivery is None and got["o3"].delivered_date_id is None
    assert got["o1"].purchase_date_id == 20180101 and got["o1"].delivery_days == 9
    kpi = marts.delivery_kpi(fo).first()
    # the late rate divides by all orders, the undelivered one included
    assert (kpi.total_orders, kpi.avg_delivery_days, kpi.late_delivery_rate_pct) == (3, 5.5, 33.33)


def test_review_by_category_weights_items(spark):
    reviews = spark.createDataFrame([("r1", "o1", 20180101, 5, True), ("r2", "o2", 20180101, 1, False),
                                     ("r3", "o2", 20180101, None, False)],
                                    "review_id string, order_id string, review_date_id int, "
                                    "review_score int, has_comment boolean")
    items = spark.createDataFrame([("o1", 1, "p1", "s", 1.0, 0.0, 1), ("o1", 2, "p1", "s", 1.0, 0.0, 1),
                                   ("o1", 3, "p1", "s", 1.0, 0.0, 1), ("o2", 1, "p2", "s", 1.0, 0.0, 1)],
                                  "order_id string, order_item_id int, product_id string, "
                                  "seller_id string, price double, freight_value double, quantity int")
    prod = spark.createDataFrame([("p1", "a", "bed", 1.0, 1.0, 1.0, 1.0),
                                  ("p2", "b", "bed", 1.0, 1.0, 1.0, 1.0)],
                                 "product_id string, category_name string, category_name_english string, "
                                 "weight_g double, length_cm double, height_cm double, width_cm double")
    r = marts.review_by_category(reviews, items, prod).first()
    # pairs: 3 x score 5 (o1 has 3 items), then o2: score 1 and a NULL score
    assert (r.category_name_english, r.avg_review_score, r.review_count) == ("bed", 4.0, 5)


def test_customer_retention_by_person_and_empty(spark):
    d = dt.datetime(2018, 1, 1)
    fo = facts.fact_orders(_orders(spark, [("o1", "c1", "x", d, None, None, None),
                                           ("o2", "c2", "x", d, None, None, None),
                                           ("o3", "c3", "x", d, None, None, None)]),
                           spark.createDataFrame([], "order_id string, price double, freight_value double"))
    cust = spark.createDataFrame([("c1", "u1", "a", "SP", "01"), ("c2", "u1", "a", "SP", "01"),
                                  ("c3", "u2", "b", "RJ", "02")],
                                 "customer_id string, customer_unique_id string, customer_city string, "
                                 "customer_state string, customer_zip_code_prefix string")
    r = marts.customer_retention(fo, dims.dim_customer(cust)).first()
    assert (r.total_customers, r.repeat_customers, r.retention_rate_pct) == (2, 1, 50.0)
    empty = marts.customer_retention(fo.limit(0), dims.dim_customer(cust)).first()
    assert empty.total_customers == 0 and empty.retention_rate_pct is None


def test_dim_payment_type_and_date(spark):
    pay = spark.createDataFrame([("voucher",), ("card",), (None,), ("card",), ("boleto",)],
                                "payment_type string")
    assert [tuple(r) for r in dims.dim_payment_type(pay).orderBy("payment_type_id").collect()] == \
        [(1, "boleto"), (2, "card"), (3, "voucher")]
    dd = dims.dim_date(spark)
    assert dd.count() == 1461
    first = dd.orderBy("date_id").first()
    assert (first.date_id, first.day_of_week, first.is_weekend) == (20160101, 6, False)
