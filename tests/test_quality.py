import pytest

from strata.operators import quality as dq


def results(df):
    return {r.check_name: (r.passed, r.value, r.threshold) for r in df.collect()}


def test_fused_checks_values(spark):
    df = spark.createDataFrame(
        [(1, 1, 5, 10.0), (1, 1, 0, -1.0), (2, None, 7, None), (None, 2, 3, 0.0)],
        "a int, b int, score int, price double")
    res = results(dq.run_checks(df, [
        dq.row_count_gt(0), dq.not_null("a"), dq.unique("a", "b"), dq.between("score", 1, 5),
        dq.positive("price"), dq.non_negative("price")], "t", "silver"))
    assert res["row_count_gt_0"] == (True, 4.0, 0.0)
    assert res["a_not_null"] == (False, 1.0, 0.0)
    assert res["unique_a_b"] == (False, 1.0, 0.0)
    assert res["score_between_1_5"] == (False, 2.0, 0.0)
    assert res["price_positive"] == (False, 2.0, 0.0)
    assert res["price_non_negative"] == (False, 1.0, 0.0)


def test_unique_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None)], "a int, b int")
    assert results(dq.run_checks(df, [dq.unique("a", "b")], "t", "l"))["unique_a_b"][1] == 1.0


def test_second_unique_check_and_orphans_and_counts(spark):
    child = spark.createDataFrame([(1, "x"), (2, "x"), (None, "y"), (9, "z")], "k int, s string")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    res = results(dq.run_checks(child, [dq.unique("k"), dq.unique("s"),
                                        dq.no_orphans("k", parent, "k"),
                                        dq.row_count_matches(parent, "rows_match")], "c", "gold"))
    assert res["unique_k"] == (True, 0.0, 0.0)
    assert res["unique_s"] == (False, 1.0, 0.0)
    assert res["fk_k_in_k"] == (False, 2.0, 0.0)
    assert res["rows_match"] == (False, 4.0, 3.0)


def test_time_window_upper_bound_is_midnight(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2019, 12, 31, 0, 0),), (dt.datetime(2019, 12, 31, 0, 1),),
                                (dt.datetime(2015, 12, 31, 23, 59),), (None,)], "t timestamp_ntz")
    chk = dq.timestamp_in_range("t", "2016-01-01 00:00:00", "2019-12-31 00:00:00", name="w")
    assert results(dq.run_checks(df, [chk], "t", "silver"))["w"] == (False, 2.0, 0.0)


def test_empty_table(spark):
    df = spark.createDataFrame([], "a int")
    res = results(dq.run_checks(df, [dq.row_count_gt(0), dq.not_null("a"), dq.unique("a")], "e", "b"))
    assert res["row_count_gt_0"] == (False, 0.0, 0.0)
    assert res["a_not_null"] == (True, 0.0, 0.0)
    assert res["unique_a"] == (True, 0.0, 0.0)


def test_gate_persists_then_raises(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gate_meta")
    df = spark.createDataFrame([(1,), (None,)], "a int")
    good = dq.run_checks(df, [dq.row_count_gt(0)], "t", "bronze")
    assert len(dq.gate(spark, "bronze", good, "gate_meta.dq")) == 1
    bad = dq.run_checks(df, [dq.not_null("a")], "t", "bronze")
    with pytest.raises(dq.DQError, match="t.a_not_null"):
        dq.gate(spark, "bronze", bad, "gate_meta.dq")
    stored = spark.table("gate_meta.dq").orderBy("run_timestamp").collect()
    assert [r.check_name for r in stored] == ["row_count_gt_0", "a_not_null"]
    assert stored[1].passed is False and stored[1].run_timestamp is not None


def test_gate_tried_again_under_one_run_leaves_its_rows_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gate_again")
    df = spark.createDataFrame([(1,), (None,)], "a int")
    checks = dq.run_checks(df, [dq.row_count_gt(0), dq.positive("a")], "t", "bronze")
    for run in ("first", "first", "second"):
        dq.gate(spark, "bronze", checks, "gate_again.dq", run_id=run)
    dq.gate(spark, "silver", checks, "gate_again.dq", run_id="first")
    stored = spark.table("gate_again.dq").groupBy("run_id").count().collect()
    assert {r.run_id: r["count"] for r in stored} == {
        "first-bronze": 2, "second-bronze": 2, "first-silver": 2}


def test_wide_keys_are_counted_by_prints(spark, monkeypatch):
    from pyspark.sql import functions as F
    rows = [(1, "a", None), (1, "a", None), (1, "b", None), (2, "a", "x"), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "a int, b string, c string")
    wide = dq.run_checks(df, [dq.unique("a", "b", "c")], "t", "l")
    assert results(wide)["unique_a_b_c"] == (False, 2.0, 0.0)
    assert results(dq.run_checks(df.distinct(), [dq.unique("b", "c", "a")], "t", "l"))["unique_b_c_a"][0]
    # keys of one print are told apart
    monkeypatch.setattr(dq.F, "xxhash64", lambda *c: F.lit(5).cast("bigint"))
    assert results(dq.run_checks(df, [dq.unique("a", "b", "c")], "t", "l"))["unique_a_b_c"][1] == 2.0
    assert results(dq.run_checks(df.limit(0), [dq.unique("a", "b", "c")], "t", "l"))["unique_a_b_c"][0]


def test_a_suite_of_related_tables_takes_one_shuffle(spark):
    child = spark.createDataFrame([(1, "x", 5), (2, "x", 6), (None, "y", 7), (9, None, 5)], "k int, s string, v int")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k bigint")
    names = spark.createDataFrame([("x",), ("z",)], "s string")
    suite = dq.run_suite([
        (child, [dq.no_orphans("k", parent, "k"), dq.no_orphans("s", names, "s"), dq.not_null("k"),
                 dq.unique("v"), dq.unique("s", "v"), dq.row_count_matches(names, "as_many"),
                 dq.row_count_gt(3)], "child", "gold"),
        (parent, [dq.unique("k"), dq.row_count_matches(child, "same")], "parent", "gold"),
        (names, [dq.not_null("s")], "names", "gold")])
    got = {(r.table_name, r.check_name): (r.passed, r.value, r.threshold) for r in suite.collect()}
    assert got == {
        ("child", "fk_k_in_k"): (False, 2.0, 0.0), ("child", "fk_s_in_s"): (False, 2.0, 0.0),
        ("child", "k_not_null"): (False, 1.0, 0.0), ("child", "unique_v"): (False, 1.0, 0.0),
        ("child", "unique_s_v"): (True, 0.0, 0.0), ("child", "as_many"): (False, 4.0, 2.0),
        ("child", "row_count_gt_3"): (True, 4.0, 3.0), ("parent", "unique_k"): (False, 1.0, 0.0),
        ("parent", "same"): (True, 4.0, 4.0), ("names", "s_not_null"): (True, 0.0, 0.0)}
    plan = suite._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[2]
    # the one by (check, key), and that of its few sums by check
    assert plan.count("Exchange hashpartitioning") == 2
    none = dq.run_suite([(child.limit(0), [dq.no_orphans("k", parent, "k"), dq.row_count_gt(0)], "c", "g")])
    assert {(r.check_name, r.passed) for r in none.collect()} == {("fk_k_in_k", True), ("row_count_gt_0", False)}


def test_integer_keys_of_a_suite_are_not_made_texts(spark):
    from strata.operators import quality as dq
    child = spark.createDataFrame([(1, 1, "1"), (1, 1, "01"), (None, 2, None), (None, 2, "x"), (7, None, "7")],
                                  "a bigint, b int, t string")
    parent = spark.createDataFrame([(1, "1"), (2, "x")], "a int, t string")
    numbers = dq.run_suite([(child, [dq.unique("a", "b"), dq.unique("a"), dq.no_orphans("a", parent, "a"),
                                     dq.row_count_matches(parent, "rows")], "c", "test")])
    found = lambda df: [(r.check_name, r.value) for r in df.collect()]
    assert [v for _, v in found(numbers)] == [2, 2, 3, 5]
    plan = numbers._jdf.queryExecution().optimizedPlan().toString()
    assert not any(f"cast({c}#" in line and " as string)" in line for c in "ab" for line in plan.splitlines())
    texts = dq.run_suite([(child, [dq.unique("a", "b", "t"), dq.unique("t"), dq.unique("a", "t"),
                                   dq.no_orphans("t", parent, "t")], "c", "test")])
    assert [v for _, v in found(texts)] == [0, 0, 0, 3]
