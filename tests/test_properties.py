"""Property tests on random inputs: salted joins equal plain joins (hot, NULL and
missing keys), de-duplication, orphan counts, fused checks, surrogate keys and date
keys equal brute force."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import add_group_total, join_keyed

keys = st.one_of(st.none(), st.integers(0, 6))
rows = st.lists(st.tuples(keys, st.integers(-5, 5)), min_size=1, max_size=60)


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(detail=rows, keyed_keys=st.sets(st.integers(0, 8), max_size=6),
       hot_rows=st.integers(1, 8))
def test_salted_joins_equal_plain_joins(spark, detail, keyed_keys, hot_rows):
    d = spark.createDataFrame(detail, "k int, v int")
    k = spark.createDataFrame([(x, x * 10) for x in sorted(keyed_keys)] or [(None, 0)],
                              "k int, attr int")
    for how in ["left", "inner"]:
        assert _sorted(join_keyed(d, k, "k", how, hot_rows=hot_rows)) == \
            _sorted(d.join(k, "k", how))
    got = add_group_total(d, "k", F.sum("v"), "t", hot_rows=hot_rows)
    plain = d.join(d.groupBy("k").agg(F.sum("v").alias("t")), "k", "left")
    assert _sorted(got) == _sorted(plain)


def _nulls_first(v):
    return (v is not None, v if v is not None else 0)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 3)),
                     min_size=1, max_size=40),
       parents=st.sets(st.integers(0, 8), max_size=5))
def test_dedupe_and_orphans_equal_brute_force(spark, data, parents):
    from strata.operators import count_orphans, dedupe

    df = spark.createDataFrame(data, "k int, a int, b int")
    survivors = {}
    for k, a, b in data:          # first row per key, other columns ascending, NULLs first
        cand = (_nulls_first(a), _nulls_first(b), a, b)
        if k not in survivors or cand < survivors[k]:
            survivors[k] = cand
    assert _sorted(dedupe(df, ["k"])) == sorted(((k, c[2], c[3]) for k, c in survivors.items()),
                                                key=repr)
    p = spark.createDataFrame([(x,) for x in sorted(parents)] or [(None,)], "k int")
    expected = sum(1 for k, _, _ in data if k is None or k not in parents)
    assert count_orphans(df, "k", p, "k").first().orphans == expected


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(-3, 8))),
                     min_size=0, max_size=40))
def test_fused_checks_equal_brute_force(spark, data):
    from strata.operators import quality as dq

    df = spark.createDataFrame(data, "k int, v int")
    res = {r.check_name: r.value for r in dq.run_checks(df, [
        dq.row_count_gt(0), dq.not_null("v"), dq.between("v", 1, 5), dq.positive("v"),
        dq.unique("k")], "t", "l").collect()}
    vs = [v for _, v in data]
    assert res["row_count_gt_0"] == len(data)
    assert res["v_not_null"] == sum(v is None for v in vs)
    assert res["v_between_1_5"] == sum(v is not None and (v < 1 or v > 5) for v in vs)
    assert res["v_positive"] == sum(v is not None and v <= 0 for v in vs)
    assert res["unique_k"] == len(data) - len({k for k, _ in data})


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.none(), st.text(alphabet="abcdef", max_size=3)),
                       min_size=0, max_size=50),
       parts=st.integers(1, 6))
def test_dense_surrogate_key_numbers_sorted_distinct_values(spark, values, parts):
    from strata.operators import dense_surrogate_key

    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = sorted((r.v, r.id) for r in dense_surrogate_key(df, "v", "id", partitions=parts).collect())
    expected = [(v, i + 1) for i, v in enumerate(sorted({v for v in values if v is not None}))]
    assert got == expected


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(stamps=st.lists(st.one_of(st.none(), st.datetimes(min_value=dt.datetime(1900, 1, 1),
                                                        max_value=dt.datetime(2100, 12, 31))),
                       min_size=1, max_size=30))
def test_date_key_equals_formatted_date(spark, stamps):
    from strata.functions.columns import date_key

    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")
    rows = df.select(date_key("ts").alias("k"),
                     F.date_format("ts", "yyyyMMdd").cast("int").alias("text_key"),
                     date_key(F.to_date("ts")).alias("day_k")).collect()
    assert all(r.k == r.text_key == r.day_k for r in rows)
