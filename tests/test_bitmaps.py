from pyspark.sql import functions as F

from strata.operators.bitmaps import counted, distinct_bitmaps, distinct_counts, merged_bitmaps


def rows(spark):
    import random
    rng = random.Random(2)
    data = [(rng.choice(["a", "b", None]), rng.randrange(4), rng.choice([rng.randrange(200_000), None]),
             rng.randrange(-5, 30)) for _ in range(3000)]
    data += [("hot", 1, 7, 7)] * 2000
    return spark.createDataFrame(data, "k string, m int, id long, other int").repartition(6)


def test_levels_equal_distinct_counts(spark):
    df = rows(spark)
    got = distinct_counts(df, [("k", "m"), ("k",), ()], {"ids": "id", "others": "other"})
    found = {(r.level, r.k, r.m): (r.ids, r.others) for r in got.collect()}
    want = {}
    for level, keys in enumerate([["k", "m"], ["k"], []]):
        for r in df.groupBy(*keys).agg(F.countDistinct("id").alias("i"), F.countDistinct("other").alias("o")).collect():
            v = r.asDict()
            want[(level, v.get("k"), v.get("m"))] = (r.i, r.o)
    assert found == want
    assert distinct_counts(df.limit(0), [("k",)], {"ids": "id"}).collect() == []


def test_two_levels_take_one_shuffle_of_ids(spark):
    df = rows(spark)
    plan = distinct_counts(df, [("k", "m"), ("k",)], {"ids": "id"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the bitmaps, and the few counts
    plain = [df.groupBy(*k).agg(F.countDistinct("id"))._jdf.queryExecution().executedPlan().toString()
             for k in (["k", "m"], ["k"])]
    assert sum(p.count("Exchange hashpartitioning") for p in plain) > 2


def test_stored_bitmaps_are_merged(spark):
    df = rows(spark)
    fine = distinct_bitmaps(df, ["k", "m"], "id")
    coarse = counted(merged_bitmaps(fine, ["k"]), ["k"], "n")
    want = df.groupBy("k").agg(F.countDistinct("id").alias("n"))
    assert sorted(map(tuple, coarse.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
