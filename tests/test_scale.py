"""Skewed inputs (one key holds a third of the rows) and plan shape."""

import contextlib
import io

from pyspark.sql import functions as F

from strata.operators import count_orphans, dedupe
from strata.operators import quality as dq
from strata.plans import facts, marts
from strata.plans.registry import queries

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def skewed(spark, n=30000):
    # a third of the rows share order 0; the rest spread over 2000 orders
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("order_id"),
        (F.col("id") % 7).cast("int").alias("order_item_id"),
        (F.col("id") % 50).alias("product_id"), F.lit(1).alias("seller_id"),
        ((F.col("id") % 1000) / 10).alias("price"), F.lit(0.5).alias("freight_value"))


def test_dedupe_hot_key_is_exact_and_limited_before_shuffle(spark):
    items = skewed(spark)
    got = dedupe(items, ["order_id", "order_item_id"])
    rows = items.collect()
    expect = {}
    for r in rows:
        k = (r.order_id, r.order_item_id)
        cand = (r.product_id, r.seller_id, r.price, r.freight_value)
        expect[k] = min(expect.get(k, cand), cand)
    assert {(r.order_id, r.order_item_id): (r.product_id, r.seller_id, r.price, r.freight_value)
            for r in got.collect()} == expect
    p = plan(got)
    # a partial group limit runs before the exchange, a final one after it
    assert p.count("WindowGroupLimit") >= 2
    assert p.index("WindowGroupLimit") < p.index("Exchange")


def test_fact_orders_hot_order(spark):
    items = skewed(spark)
    orders = spark.range(0, 2001).select(F.col("id").alias("order_id"), F.lit("c").alias("customer_id"),
                                         F.lit("x").alias("order_status"),
                                         F.lit(None).cast("timestamp_ntz").alias("order_purchase_timestamp"),
                                         F.lit(None).cast("timestamp_ntz").alias("order_delivered_customer_date"),
                                         F.lit(None).cast("timestamp_ntz").alias("order_estimated_delivery_date"),
                                         F.lit(None).cast("int").alias("order_duration_days"))
    fo = {r.order_id: r.total_items for r in facts.fact_orders(orders, items).collect()}
    assert fo[0] == 10000 and sum(fo.values()) == 30000


def test_orphans_and_unique_with_hot_key(spark):
    child = skewed(spark)
    parent = spark.range(1, 1500).select(F.col("id").alias("order_id"))
    o = count_orphans(child, "order_id", parent, "order_id").first().orphans
    assert o == child.where("order_id = 0 OR order_id >= 1500").count()
    res = dq.run_checks(child, [dq.unique("order_id", "order_item_id")], "t", "l").first()
    assert res.value == 30000 - child.select("order_id", "order_item_id").distinct().count()


def test_review_mart_equals_pair_join_under_fan_out(spark):
    items = skewed(spark).withColumn("quantity", F.lit(1))
    reviews = spark.range(0, 2001).select(F.col("id").alias("review_id"), F.col("id").alias("order_id"),
                                          F.lit(20180101).alias("review_date_id"),
                                          (F.col("id") % 5 + 1).cast("int").alias("review_score"),
                                          F.lit(True).alias("has_comment"))
    prod = spark.range(0, 50).select(F.col("id").alias("product_id"), F.lit("c").alias("category_name"),
                                     (F.col("id") % 3).cast("string").alias("category_name_english"),
                                     *[F.lit(1.0).alias(c) for c in ["weight_g", "length_cm",
                                                                      "height_cm", "width_cm"]])
    got = {r.category_name_english: (r.avg_review_score, r.review_count)
           for r in marts.review_by_category(reviews, items, prod).collect()}
    brute = (reviews.join(items, "order_id").join(prod, "product_id")
             .groupBy("category_name_english")
             .agg(F.round(F.avg("review_score"), 2).alias("a"), F.count(F.lit(1)).alias("n")))
    assert got == {r.category_name_english: (r.a, r.n) for r in brute.collect()}


def test_scan_pushdown_and_pruning(spark):
    p = plan(queries()["silver_orders"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in p
    li = plan(queries()["fact_orders"](spark, SF))
    # lineitem is read with only the columns the plan needs
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in li


def single_partition_inputs(text: str) -> list[str]:
    """For each exchange to a single partition, the operator feeding it."""
    import re
    tree, _, details = text.partition("\n\n\n")
    ids = re.findall(r"\((\d+)\) Exchange\s*\nInput \[[^\n]*\nArguments: SinglePartition", details)
    lines = tree.splitlines()
    feeders = []
    for i in ids:
        at = next(n for n, line in enumerate(lines) if line.rstrip().endswith(f"Exchange ({i})"))
        feeders.append(lines[at + 1].split("- ")[-1].strip())
    return feeders


def test_calendar_is_broadcast_and_single_partitions_only_get_partials(spark):
    assert "BroadcastHashJoin" in plan(queries()["months_of_a_short_calendar"](spark, SF))
    for name in ["mart_monthly_revenue", "mart_state_performance", "mart_review_by_category",
                 "mart_customer_retention", "mart_delivery_kpi", "fact_orders", "dq_silver_suite",
                 "dq_gold_suite", "silver_order_payments"]:
        for feeder in single_partition_inputs(plan(queries()[name](spark, SF))):
            # only global aggregates of per-task partial results (one row per task)
            assert feeder.startswith("HashAggregate"), (name, feeder)


def test_group_total_salts_a_hot_key(spark):
    from strata.operators import add_group_total

    items = skewed(spark)                      # order 0 holds 10,000 of 30,000 rows
    expected = {r.order_id: r.t for r in
                items.groupBy("order_id").agg(F.sum("product_id").alias("t")).collect()}
    keys = ["spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "false")
    spark.conf.set(keys[1], "16")
    try:
        got = add_group_total(items, "order_id", F.sum("product_id"), "t", hot_rows=1000)
        rows = got.collect()
        assert len(rows) == 30000 and all(r.t == expected[r.order_id] for r in rows)
        assert got.columns == items.columns + ["t"]
        # the hot order is split over 10 salts: no join task holds most of it
        per_task = (got.where("order_id = 0").select(F.spark_partition_id().alias("p"))
                    .groupBy("p").count().collect())
        assert len(per_task) > 1 and max(r["count"] for r in per_task) < 5000
        # without a hot key nothing is salted and the result is the same
        plain = add_group_total(items, "order_id", F.sum("product_id"), "t")
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, rows))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_customer_marts_with_a_hot_customer_equal_the_join_formulation(spark):
    n = 9000
    fact = spark.range(n).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 400 + 2).alias("customer_id"),
        ((F.col("id") % 1000) / 7).alias("total_revenue"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise((F.col("id") % 9).cast("int"))
         .alias("delivery_days"))
    dim = spark.range(1, 380).select(
        F.col("id").alias("customer_id"), (F.col("id") % 150).cast("string").alias("customer_unique_id"),
        (F.col("id") % 7).cast("string").alias("state"))
    joined = fact.join(dim, "customer_id")
    brute_state = {r.state: (r.n, r.rev, r.avg) for r in joined.groupBy("state").agg(
        F.countDistinct("order_id").alias("n"),
        F.round(F.sum(F.col("total_revenue").cast("decimal(38,18)")), 2).cast("double").alias("rev"),
        F.round(F.avg("delivery_days"), 2).alias("avg")).collect()}
    got_state = {r.state: (r.order_count, r.revenue, r.avg_delivery_days)
                 for r in marts.state_performance(fact, dim).collect()}
    assert got_state == brute_state
    per_person = joined.groupBy("customer_unique_id").agg(F.countDistinct("order_id").alias("k"))
    total, repeat = per_person.count(), per_person.where("k >= 2").count()
    r = marts.customer_retention(fact, dim).first()
    assert (r.total_customers, r.repeat_customers) == (total, repeat)


def test_join_keyed_and_lookup_split_a_hot_key(spark):
    from strata.operators import join_keyed, lookup

    items = skewed(spark)                      # order 0 holds 10,000 of 30,000 rows
    keyed = spark.range(0, 1800).select(F.col("id").alias("order_id"),
                                        (F.col("id") * 10).alias("attr"))
    keyed = keyed.union(spark.createDataFrame([(None, -1)], "order_id long, attr long"))
    for how in ["left", "inner"]:
        brute = sorted(map(tuple, items.join(keyed, "order_id", how).collect()))
        got = join_keyed(items, keyed, "order_id", how, hot_rows=500)
        assert sorted(map(tuple, got.collect())) == brute
    looked = lookup(items, keyed, "order_id", {"attr": 0}, hot_rows=500, broadcast_rows=100)
    assert looked.where("order_id = 0 AND attr = 0").count() == 10000
    assert looked.where("order_id >= 1800 AND attr = 0").count() == \
        items.where("order_id >= 1800").count()
    assert looked.count() == items.count()
    # a lookup within the row bound is broadcast after its count: no salting at all
    small = lookup(items, keyed, "order_id", {"attr": 0}, hot_rows=500)
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "__salt" not in plan
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, looked.collect()))


def test_left_joins_spread_many_null_keys(spark):
    from strata.operators import add_group_total, join_keyed

    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 100).alias("k"),
        F.col("id"))                             # a third of the keys are NULL
    keyed = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("attr"))
    keys = ["spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "false")
    spark.conf.set(keys[1], "16")
    try:
        for got in [join_keyed(rows, keyed, "k", "left", hot_rows=1000),
                    add_group_total(rows, "k", F.count(F.lit(1)), "attr", hot_rows=1000)]:
            assert got.count() == 30000
            nulls = got.where("k IS NULL")
            assert nulls.count() == 10000 and nulls.where("attr IS NOT NULL").count() == 0
            per_task = nulls.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
            assert len(per_task) > 1 and max(r["count"] for r in per_task) < 5000
        brute = sorted(map(tuple, rows.join(keyed, "k", "left").collect()), key=repr)
        assert sorted(map(tuple, join_keyed(rows, keyed, "k", "left", hot_rows=1000).collect()),
                      key=repr) == brute
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_lookup_broadcast_needs_rows_and_bytes_within_bounds(spark):
    from strata.operators import lookup

    items = skewed(spark)
    wide = spark.range(0, 2000).select(F.col("id").alias("order_id"),
                                       F.repeat(F.lit("x"), 10_000).alias("attr"))  # ~20 MB
    plan = lookup(items, wide, "order_id", hot_rows=500)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "__salt" in plan          # too many bytes for the 10 MB threshold: salted, not broadcast
    narrow = wide.select("order_id", F.lit("x").alias("attr"))
    plan = lookup(items, narrow, "order_id", hot_rows=500)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "__salt" not in plan and "BroadcastHashJoin" in plan


def test_skew_thresholds_from_session_settings(spark):
    from strata.operators import add_group_total

    items = skewed(spark)                      # order 0 holds 10,000 of 30,000 rows
    confs = {"strata.skew.hotRows": "1000",
             "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        got = add_group_total(items, "order_id", F.count(F.lit(1)), "n")
        assert {r.order_id: r.n for r in got.collect()}[0] == 10000
        per_task = (got.where("order_id = 0").select(F.spark_partition_id().alias("p"))
                    .groupBy("p").count().collect())
        assert len(per_task) > 1 and max(r["count"] for r in per_task) < 5000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_broadcast_threshold_text_forms():
    from strata.operators.joins import _broadcast_bytes

    class Conf:
        def __init__(self, v):
            self.v = v

        def get(self, key, default=None):
            return self.v

    class Remote:                        # a session without a JVM object
        def __init__(self, v):
            self.conf = Conf(v)

    for text, want in [("10485760b", 10 << 20), ("20MB", 20 << 20), ("-1", -1), ("1g", 1 << 30)]:
        assert _broadcast_bytes(Remote(text)) == want


def test_a_skewed_join_is_split_at_run_time_without_a_job_before(spark):
    from strata.operators import add_group_total, join_keyed
    confs = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
             "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    rows = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 900).alias("k"), F.col("id"))
    keyed = spark.range(500).selectExpr("id as k", "id * 2 as attr").union(
        spark.createDataFrame([(None, -1)], "k long, attr long"))
    sc = spark.sparkContext
    try:
        sc.setJobGroup("skew-build", "")
        built = [join_keyed(rows, keyed, "k", "left"), join_keyed(rows, keyed, "k", "inner"),
                 add_group_total(rows, "k", F.count(F.lit(1)), "n")]
        assert list(sc.statusTracker().getJobIdsForGroup("skew-build")) == []
        sc.setLocalProperty("spark.jobGroup.id", None)
        want = [rows.join(keyed, "k", "left"), rows.join(keyed, "k", "inner"),
                rows.join(rows.where("k is not null").groupBy("k").count(), "k", "left")]
        for got, brute in zip(built, want):
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, brute.collect()), key=repr)
            final = got._jdf.queryExecution().executedPlan().toString()
            assert "skew=true" in final.partition("Initial Plan")[0], final[:3000]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
