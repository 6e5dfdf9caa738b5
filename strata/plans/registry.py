"""Registered queries over the driver's test tables, one per builder or operator.

Every query reads the given tables (through ``bindings.raw_sources``) and runs the
library's own builders on them; outputs drop the per-run audit timestamp so they
can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.bindings import EMBEDDING_BOX, raw_sources, table
from strata.plans.layers import DIMENSIONS, FACTS, MARTS, SILVER_TABLES, Layers

# Calendar used with the test tables: it covers all purchase days, so that no order drops out
# of the monthly mart by the inner join.
TEST_CALENDAR = None
AUDIT_COLUMNS = ["_ingested_at", "_ingest_date"]

Query = Callable[[SparkSession, str], DataFrame]


def layers(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = (),
           calendar: tuple[str, str] | None = TEST_CALENDAR) -> Layers:
    return Layers(spark, raw_sources(spark, sf_dir), calendar, EMBEDDING_BOX, keep)


def _silver(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = layers(spark, sf_dir).silver(name)
        return df.drop(*[c for c in AUDIT_COLUMNS if c in df.columns])
    return q


def _gold(name: str) -> Query:
    return lambda spark, sf_dir: layers(spark, sf_dir).gold(name)


def _mart(name: str) -> Query:
    return lambda spark, sf_dir: layers(spark, sf_dir).mart(name)


def dim_date_covering_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar dimension spanning every purchase day."""
    from strata.plans.dims import dim_date_covering
    return dim_date_covering(layers(spark, sf_dir).purchases(), "order_purchase_timestamp")


def dim_date_order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar dimension with the orders purchased on each day."""
    lay = layers(spark, sf_dir)
    return _with_orders(lay.gold("dim_date"), lay.gold("fact_orders"))


def _with_orders(dim_date: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Every calendar row with its number of orders (0 on days without). Per-day counts are
    combined map-side; the result has one row per calendar day whatever the number of orders."""
    per_day = (fact_orders.groupBy(F.col("purchase_date_id").alias("date_id"))
               .agg(F.count(F.lit(1)).alias("orders")))
    return (dim_date.join(per_day, "date_id", "left")
            .withColumn("orders", F.coalesce("orders", F.lit(0).cast("bigint"))))


def dq_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.plans.suites import bronze_suite
    return bronze_suite(layers(spark, sf_dir).bronze)


def dq_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.plans.suites import silver_suite
    lay = layers(spark, sf_dir)
    return silver_suite(lay.silver("orders"), lay.silver("order_items"),
                        lay.silver("order_reviews"))


def dq_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.plans.suites import gold_suite
    lay = layers(spark, sf_dir, keep=("orders", "order_items"))
    return gold_suite(lay.gold("fact_orders"), lay.gold("fact_order_items"),
                      lay.gold("dim_customer"), lay.gold("dim_product"),
                      lay.gold("dim_seller"), lay.silver("orders"))


def dq_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.plans.suites import acceptance_suite
    lay = layers(spark, sf_dir, keep=("orders", "order_items"))
    return acceptance_suite(lay.silver("orders"), lay.silver("order_items"),
                            lay.silver("order_reviews"), lay.gold("fact_orders"),
                            lay.gold("fact_order_items"), lay.gold("dim_customer"))


def padded_customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trim / blank -> NULL / upper-case on text with outer blanks: every tenth
    customer's segment is made all blanks, the others get padded."""
    from strata.operators.cleaning import clean_strings, upper_columns
    cust = table(spark, sf_dir, "customer")
    padded = cust.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 10 == 0, F.lit("   "))
         .otherwise(F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")))
         .alias("segment"))
    return upper_columns(clean_strings(padded), ["segment"])


def documents_without_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan count of a foreign key: documents with no labels row."""
    from strata.operators.joins import count_orphans
    return count_orphans(table(spark, sf_dir, "documents"), "doc_id",
                         table(spark, sf_dir, "labels"), "doc_id")


def events_with_user_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregate joined back to its detail rows: every event with its user's total."""
    from strata.functions.columns import money_total
    from strata.operators.joins import add_group_total
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return add_group_total(events, "user_id", money_total("value"), "user_total")


# a calendar that leaves out orders of the test tables at both ends
SHORT_CALENDAR = ("1996-02-01", "1998-06-30")


def orders_outside_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose purchase day has no row in a calendar of a fixed span (the monthly mart loses
    them)."""
    from strata.operators.joins import count_orphans
    lay = layers(spark, sf_dir, calendar=SHORT_CALENDAR)
    return count_orphans(lay.gold("fact_orders"), "purchase_date_id", lay.gold("dim_date"),
                         "date_id")


def months_of_a_short_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly mart over a calendar of a fixed span: orders outside it drop out."""
    return layers(spark, sf_dir, calendar=SHORT_CALENDAR).mart("mart_monthly_revenue")


def days_of_a_short_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar dimension of a fixed span, with the orders purchased on each day."""
    lay = layers(spark, sf_dir, calendar=SHORT_CALENDAR)
    return _with_orders(lay.gold("dim_date"), lay.gold("fact_orders"))


def orders_by_month_and_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders and customers of each month and, from the same bitmaps, of each year."""
    from strata.operators.bitmaps import distinct_counts
    day = F.col("purchase_date_id")
    dated = layers(spark, sf_dir).gold("fact_orders").where(day.isNotNull()).select(
        F.floor(day / 10000).cast("int").alias("year"),
        (F.floor(day / 100).cast("int") % 100).alias("month"),
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"))
    levels = [("year", "month"), ("year",)]
    return distinct_counts(dated, levels, {"orders": "order_id", "customers": "customer_id"})


def unique_line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness of keys over the order lines and texts: narrow, wide, and wide with copies."""
    from strata.operators import quality as dq
    lines, docs = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "documents")
    wide = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    return dq.combine([
        dq.run_checks(lines, [dq.unique("l_orderkey", "l_linenumber"), dq.unique(*wide),
                              dq.unique("l_partkey", "l_returnflag", "l_shipdate")], "lineitem", "raw"),
        dq.run_checks(docs, [dq.unique("text"), dq.unique("source", "text")], "documents", "raw")])


def money_sums_of_odd_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices summed per order line number and part size, with NaN, infinities, very large
    values and five decimals put in by key: nothing is dropped, rounded or thrown."""
    from strata.functions.columns import money_sum
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                                 "l_extendedprice")
    k = F.col("l_partkey") % 40
    price = (F.when((k == 1) & (F.col("l_linenumber") == 1), F.lit(float("nan")))
             .when((k == 2) & (F.col("l_linenumber") == 1), F.lit(float("inf")))
             .when(k == 3, F.lit(1e15)).when((k == 4) & (F.col("l_linenumber") == 1), F.lit(2.0**84))
             .when(k == 5, F.lit(0.00005)).otherwise(F.col("l_extendedprice")))
    return li.groupBy(k.alias("part_group")).agg(money_sum(price).alias("total"),
                                                 F.count(F.lit(1)).alias("items"))


def months_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly mart with the place of each row in its final order."""
    return _placed(layers(spark, sf_dir).mart("mart_monthly_revenue"))


def categories_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category ranking with the place of each row in its final order."""
    return _placed(layers(spark, sf_dir).mart("mart_category_ranking"))


def _placed(mart: DataFrame) -> DataFrame:
    """``place`` counts rows as the sorted mart returns them: ids grow with partitions, which a
    sort leaves in order, and within them; a mart has a few rows, so numbering them is cheap."""
    from pyspark.sql import Window
    marked = mart.withColumn("__id", F.monotonically_increasing_id())
    return marked.withColumn("place", F.row_number().over(Window.orderBy("__id")).cast("bigint")) \
        .drop("__id")


def integers_of_odd_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``to_int`` on numbers written in many ways, by order key."""
    from strata.functions.columns import to_int
    forms = ["5", "5.7", " 12 ", "-3.9", "+8", "5d", "1e3", "", "abc", "99999999999", ".5", "7."]
    text = F.array(*[F.lit(f) for f in forms])[
        (F.col("o_orderkey") % len(forms)).cast("int")]
    return table(spark, sf_dir, "orders").select("o_orderkey", to_int(text).alias("n"))


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for name in SILVER_TABLES:
        out[f"silver_{name}"] = _silver(name)
    # the calendar alone reads no table; it is registered joined with the orders
    for name in DIMENSIONS + FACTS:
        if name != "dim_date":
            out[name] = _gold(name)
    out["dim_date_order_days"] = dim_date_order_days
    out["dim_date_covering_orders"] = dim_date_covering_orders
    for name in MARTS:
        out[name] = _mart(name)
    out["dq_bronze_suite"] = dq_bronze
    out["dq_silver_suite"] = dq_silver
    out["dq_gold_suite"] = dq_gold
    out["dq_acceptance_suite"] = dq_acceptance
    out["orders_outside_calendar"] = orders_outside_calendar
    out["months_of_a_short_calendar"] = months_of_a_short_calendar
    out["days_of_a_short_calendar"] = days_of_a_short_calendar
    out["orders_by_month_and_year"] = orders_by_month_and_year
    out["unique_line_keys"] = unique_line_keys
    out["money_sums_of_odd_values"] = money_sums_of_odd_values
    out["months_in_order"] = months_in_order
    out["categories_in_order"] = categories_in_order
    out["integers_of_odd_text"] = integers_of_odd_text
    out["clean_padded_segments"] = padded_customer_segments
    out["orphan_documents_without_labels"] = documents_without_labels
    out["events_with_user_total"] = events_with_user_total
    from strata.plans import roundtrips
    out.update(roundtrips.queries())
    return out
