import datetime as dt

from pyspark.sql import functions as F

from strata.operators import (add_group_total, cast_columns, clean_strings, count_orphans,
                              date_spine, date_spine_covering, dedupe, dense_surrogate_key,
                              lookup, require_keys, upper_columns, with_calendar_columns,
                              within_box)


def test_clean_strings_only_touches_strings(spark):
    df = spark.createDataFrame([(" a ", 1, "  "), (None, 2, "b")], "s string, n int, t string")
    out = clean_strings(df)
    assert out.columns == ["s", "n", "t"]
    assert [tuple(r) for r in out.collect()] == [("a", 1, None), (None, 2, "b")]
    assert [tuple(r) for r in clean_strings(df, ["t"]).collect()] == [(" a ", 1, None), (None, 2, "b")]


def test_cast_columns_and_upper(spark):
    df = spark.createDataFrame([("5.0", "1.25", "2017-05-01 10:00:00", "sp")], "a string, b string, c string, d string")
    r = upper_columns(cast_columns(df, {"a": "int", "b": "double", "c": "timestamp"}), ["d"]).first()
    assert (r.a, r.b, r.c, r.d) == (5, 1.25, dt.datetime(2017, 5, 1, 10), "SP")


def test_require_keys_and_box(spark):
    df = spark.createDataFrame([(1, -35.0, -75.0), (None, 0.0, -40.0), (3, 6.0, -34.0), (4, 6.01, -40.0),
                                (5, None, -40.0)], "k int, lat double, lng double")
    assert [r.k for r in require_keys(df, ["k"]).collect()] == [1, 3, 4, 5]
    kept = within_box(df, "lat", "lng", (-35, 6), (-75, -34))
    assert sorted(r.k or 0 for r in kept.collect()) == [0, 1, 3]


def test_dedupe_is_deterministic_and_groups_null_keys(spark):
    rows = [(1, "b", 2.0), (1, "a", 9.0), (1, "a", 3.0), (None, "z", 1.0), (None, "y", 1.0), (2, None, 1.0)]
    df = spark.createDataFrame(rows, "k int, s string, v double").repartition(3)
    got = sorted((tuple(r) for r in dedupe(df, ["k"]).collect()), key=repr)
    assert got == sorted([(1, "a", 3.0), (None, "y", 1.0), (2, None, 1.0)], key=repr)
    by_v = dedupe(df, ["k"], [F.col("v").desc()]).where("k = 1").first()
    assert by_v.v == 9.0


def test_dedupe_composite_key(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 1, "w"), (1, 2, "y"), (1, None, "a"), (1, None, "b")],
                               "a int, b int, c string")
    got = sorted((tuple(r) for r in dedupe(df, ["a", "b"]).collect()), key=repr)
    assert got == sorted([(1, 1, "w"), (1, 2, "y"), (1, None, "a")], key=repr)


def test_lookup_default_and_no_fan_out(spark):
    df = spark.createDataFrame([(1, "x"), (2, "q"), (3, None)], "id int, cat string")
    names = spark.createDataFrame([("x", "ex"), ("x", "aa"), ("y", "why")], "cat string, name string")
    out = lookup(df, names, "cat", {"name": "unknown"})
    got = sorted((r.id, r.name) for r in out.collect())
    assert got == [(1, "aa"), (2, "unknown"), (3, "unknown")]


def test_add_group_total_null_key_gets_null(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 5.0), (2, 4.0)], "k int, v double")
    out = add_group_total(df, "k", F.sum("v"), "total")
    got = sorted(((r.k, r.v, r.total) for r in out.collect()), key=repr)
    assert got == sorted([(1, 1.0, 3.0), (1, 2.0, 3.0), (None, 5.0, None), (2, 4.0, 4.0)], key=repr)


def test_count_orphans_null_and_hot_key(spark):
    child = spark.createDataFrame([(1,)] * 50 + [(2,), (None,), (7,), (7,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert count_orphans(child, "k", parent, "k").first().orphans == 3
    assert count_orphans(parent, "k", parent, "k").first().orphans == 0


def test_dense_surrogate_key_over_many_partitions(spark):
    values = [f"v{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values * 3] + [(None,)], "v string").repartition(7)
    out = dense_surrogate_key(df, "v", "id", partitions=5).collect()
    assert len(out) == 500
    assert sorted((r.id, r.v) for r in out) == [(i + 1, v) for i, v in enumerate(values)]


def test_date_spine_inclusive(spark):
    spine = with_calendar_columns(date_spine(spark, "2019-12-30", "2020-01-02")).collect()
    assert [r.date_id for r in spine] == [20191230, 20191231, 20200101, 20200102]
    assert [r.is_weekend for r in spine] == [False, False, False, False]
    df = spark.createDataFrame([(dt.datetime(2020, 2, 27, 5),), (dt.datetime(2020, 3, 1, 23),)],
                               "t timestamp_ntz")
    assert date_spine_covering(df, "t").count() == 4  # leap day included


def test_calendar_broadcast_only_when_span_is_bounded(spark):
    from strata.operators.calendar import date_spine, date_spine_covering

    facts = spark.range(1000).select(F.date_add(F.lit(dt.date(2000, 1, 1)),
                                                (F.col("id") % 300).cast("int")).alias("full_date"))

    def plan_of(spine):
        return facts.join(spine, "full_date")._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan_of(date_spine(spark, "2000-01-01", "2000-12-31"))
    long_plan = plan_of(date_spine(spark, "1500-01-01", "2100-12-31"))
    assert "BroadcastHashJoin" not in long_plan and "SortMergeJoin" in long_plan
    covering = date_spine_covering(facts, "full_date")
    assert covering.count() == 300
    assert date_spine_covering(facts.where("false"), "full_date").count() == 0
