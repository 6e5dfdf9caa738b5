import datetime as dt

from pyspark.sql import functions as F

from strata.functions import columns as C


def one(spark, expr, value, ddl):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_blank_to_null(spark):
    df = spark.createDataFrame([("  a b ",), ("   ",), ("",), (None,), ("\tx\t",)], "s string")
    got = [r[0] for r in df.select(C.blank_to_null("s")).collect()]
    # spaces only are trimmed; tabs stay
    assert got == ["a b", None, None, None, "\tx\t"]


def test_to_int_goes_through_double(spark):
    df = spark.createDataFrame([("5",), ("5.0",), ("5.7",), ("-2.9",), ("x",), (None,),
                                ("99999999999",)], "s string")
    assert [r[0] for r in df.select(C.to_int("s")).collect()] == [5, 5, 5, -2, None, None, None]


def test_to_double_and_timestamp_bad_values_are_null(spark):
    df = spark.createDataFrame([("1.5", "2018-01-02 03:04:05"), ("abc", "not a time"),
                                (None, None)], "a string, b string")
    rows = df.select(C.to_double("a"), C.to_timestamp("b")).collect()
    assert rows[0][0] == 1.5 and rows[0][1] == dt.datetime(2018, 1, 2, 3, 4, 5)
    assert rows[1][0] is None and rows[1][1] is None
    assert rows[2][0] is None and rows[2][1] is None


def test_date_key_and_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 12, 31, 23, 59),), (None,)], "t timestamp_ntz")
    parts = C.calendar_parts("t")
    rows = df.select(C.date_key("t").alias("k"), *[c.alias(n) for n, c in parts.items()]).collect()
    assert rows[0]["k"] == 20191231
    # 2019-12-31 is a Tuesday: Spark counts 1 = Sunday
    assert (rows[0]["year"], rows[0]["quarter"], rows[0]["month"], rows[0]["day"],
            rows[0]["day_of_week"], rows[0]["is_weekend"]) == (2019, 4, 12, 31, 3, False)
    assert rows[1]["k"] is None


def test_day_diff_ignores_time_of_day(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 1, 1, 23, 59), dt.datetime(2018, 1, 2, 0, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(C.day_diff("b", "a")).first()[0] == 1


def test_pct_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 3), (None, 0)], "a long, b long")
    assert [r[0] for r in df.select(C.pct("a", "b")).collect()] == [None, 33.33, None]


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.2,)] * 10, "v double")
    assert df.select(C.money_sum("v")).first()[0] == 3.0
    assert df.agg(C.money_total("v")).first()[0] == 3.0
    # a tie rounds half up
    assert spark.createDataFrame([(1.005,)], "v double").agg(C.money_total("v")).first()[0] == 1.01


def test_round2_half_up(spark):
    assert one(spark, C.round2(F.col("v")), 2.675, "v double") == 2.68


def test_money_sum_keeps_every_value(spark):
    import math

    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(C.money_sum("v")).first()[0]
    assert math.isnan(total(1.5, float("nan")))
    assert total(1.5, float("inf")) == float("inf")
    assert total(2e14, 1e15, 0.5) == 1.2e15 + 0.5
    assert total(1e25, 1.0) == 1e25
    assert total(*[0.00005] * 3, *[0.00004] * 3) == 0.00027
    assert total(9e19, 9e19) == 1.8e20 and total(1e300, 1.0, -1e300) in (0.0, 1.0)
    assert total(None, 2.5) == 2.5 and total(None) is None


def test_to_int_takes_plain_numbers_only(spark):
    rows = [("5d",), ("1e3",), ("5.7",), ("-3",), (" 4 ",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "v string").select(C.to_int("v")).collect()]
    assert got == [None, None, 5, -3, 4, None]
    assert spark.createDataFrame([(1e7,)], "v double").select(C.to_int("v")).first()[0] == 10_000_000


def test_money_sum_is_rounded_once_in_any_order(spark):
    """The nearest double to the exact sum, whatever the sizes of the values and their order."""
    import random
    from fractions import Fraction
    rng = random.Random(11)
    groups = {}
    for g in range(600):
        n, kind = rng.randrange(1, 25), g % 6
        if kind == 0:
            v = [round(rng.uniform(-1e5, 1e5), 2) for _ in range(n)]
        elif kind == 1:
            v = [rng.uniform(-1, 1) * 2.0 ** rng.randrange(-18, 94) for _ in range(n)]
        elif kind == 2:  # large values that cancel
            v = [rng.uniform(-1, 1) * 2.0 ** rng.randrange(-18, 94) for _ in range(n)]
            v += [-x for x in v] + [rng.choice([0.01, -1e-5, 3e20])]
        elif kind == 3:  # ties, and what lies just beside them
            v = [2.0 ** 52 * 3, rng.choice([0.5, 1.5, -0.5, -1.5]), rng.choice([0.0, 2.0 ** -70, -2.0 ** -70])]
        elif kind == 4:
            v = [2.0 ** rng.randrange(0, 95), rng.choice([1, -1]) * 2.0 ** rng.randrange(-72, 40)]
        else:
            v = [1e20, -1e20, 1e20, 3.3, 1e-5, -1e19] * n
        groups[g] = v
    rows = [(g, float(x)) for g, v in groups.items() for x in v]
    want = {g: float(sum(Fraction(x) for x in v)) for g, v in groups.items()}
    for _ in range(2):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "g int, v double").repartition(rng.randrange(2, 9))
        assert {r.g: r.t for r in df.groupBy("g").agg(C.money_sum("v").alias("t")).collect()} == want
        parts = df.groupBy("g", F.spark_partition_id().alias("p")).agg(*C.money_parts("v").named("s"))
        merged = parts.groupBy("g").agg(C.merged_parts("s").total().alias("t"))
        assert {r.g: r.t for r in merged.collect()} == want


def test_money_sum_of_many_equal_large_values_does_not_depend_on_order(spark):
    up = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, 1e20).otherwise(0.1).alias("v"))
    totals = {df.agg(C.money_sum("v")).first()[0] for df in
              (up, up.orderBy("v"), up.orderBy(F.desc("v")), up.repartition(7))}
    from fractions import Fraction
    assert totals == {float(20_000 * (Fraction(1e20) + Fraction(0.1)))}
