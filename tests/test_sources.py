import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.session import scratch_path
from strata.sources import (append_table, derby_memory_url, read_csv, read_jdbc, replace_table,
                            with_audit, write_jdbc, write_partitioned)
from strata.sources.jdbc import DERBY_DRIVER, seed_from_files


def test_csv_multiline_quotes_and_leading_zero(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text('id,zip,msg\n1,01234,"line one\nline two"\n2,00007,"say ""hi"""\n')
    schema = StructType([StructField(n, StringType()) for n in ["id", "zip", "msg"]])
    rows = read_csv(spark, str(p), schema).orderBy("id").collect()
    assert len(rows) == 2
    assert rows[0].zip == "01234" and rows[0].msg == "line one\nline two"
    assert rows[1].msg == 'say "hi"'
    # inferred types lose the zeros; without multiLine the file looks like 3 records
    assert read_csv(spark, str(p), infer=True).orderBy("id").first().zip == 1234
    assert read_csv(spark, str(p), schema, multiline=False).count() == 3


def test_audit_columns_constant_per_query(spark):
    df = with_audit(spark.range(1000).repartition(4), "x.csv", day_column=True)
    agg = df.agg(F.countDistinct("_ingested_at"), F.countDistinct("_source_file"),
                 F.first("_source_file"), F.countDistinct("_ingest_date")).first()
    assert tuple(agg) == (1, 1, "x.csv", 1)


def test_jdbc_roundtrip_partitioned(spark):
    url = derby_memory_url("strata_test_rt")
    props = {"driver": DERBY_DRIVER}
    src = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"))
    write_jdbc(src, url, "t", props)
    back = read_jdbc(spark, url, "t", props, partition_column="k", num_partitions=3)
    assert back.rdd.getNumPartitions() == 3
    assert back.count() == 1000 and back.agg(F.sum("k")).first()[0] == sum(range(1000))
    pushed = back.where("g = 3")
    assert pushed.count() == len([i for i in range(1000) if i % 7 == 3])


def test_seed_from_files_skips_missing(spark, tmp_path):
    (tmp_path / "product_category_name_translation.csv").write_text(
        "product_category_name,product_category_name_english\ncama,bed\n")
    url = derby_memory_url("strata_test_seed")
    status = seed_from_files(spark, str(tmp_path), url, {"driver": DERBY_DRIVER})
    assert status["category_translation"] == "loaded"
    assert status["orders"].startswith("skipped")
    back = read_jdbc(spark, url, "category_translation", {"driver": DERBY_DRIVER})
    assert [tuple(r) for r in back.collect()] == [("cama", "bed")]


def test_seed_without_files_is_an_error(spark, tmp_path):
    import pytest
    with pytest.raises(FileNotFoundError):
        seed_from_files(spark, str(tmp_path), derby_memory_url("strata_none"), {"driver": DERBY_DRIVER})


def test_replace_is_idempotent_and_may_read_itself(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS rt")
    df = spark.range(10).withColumn("d", F.lit("2024-01-01"))
    assert replace_table(df, "rt.t", partition_by=["d"]) == 10
    assert replace_table(df, "rt.t", partition_by=["d"]) == 10
    assert spark.table("rt.t").count() == 10
    # a refresh computed from the table it replaces
    assert replace_table(spark.table("rt.t").where("id < 5"), "rt.t") == 5
    assert spark.table("rt.t").count() == 5


def test_append_creates_then_appends(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS ap")
    spark.sql("DROP TABLE IF EXISTS ap.log")
    assert append_table(spark.range(3), "ap.log") == 3
    assert append_table(spark.range(2), "ap.log") == 2
    assert spark.table("ap.log").count() == 5


def test_write_partitioned_spreads_hot_day(spark):
    path = scratch_path(spark, "parts")
    hot = spark.range(0, 2000).select("id", F.when(F.col("id") < 1500, F.lit("2024-01-01"))
                                      .otherwise(F.lit("2024-01-02")).alias("day"))
    write_partitioned(hot, path, ["day"], spread_by=["id"], partitions=4)
    back = spark.read.parquet(path)
    assert {r.day.isoformat(): r["count"] for r in back.groupBy("day").count().collect()} == \
        {"2024-01-01": 1500, "2024-01-02": 500}
    files = [f for f in os.listdir(os.path.join(path.replace("file:", ""), "day=2024-01-01"))
             if f.endswith(".parquet")]
    assert len(files) > 1  # the hot day was written by several tasks


def _finished(spark, root):
    from strata.sources import fs
    return [v for v in fs.subdirectories(spark, root) if fs.exists(spark, f"{root}/{v}/_SUCCESS")]


def test_replace_moves_no_data_and_keeps_two_versions(spark):
    from strata.sources.tables import _versions_root, list_tables, published_version
    spark.sql("CREATE DATABASE IF NOT EXISTS rv")
    for n in [3, 4, 5]:
        assert replace_table(spark.range(n), "rv.t") == n
    assert spark.table("rv.t").count() == 5
    assert spark.catalog.getTable("rv.t").tableType == "VIEW"
    kept = _finished(spark, _versions_root(spark, "rv.t"))
    assert len(kept) == 2 and kept[-1] == published_version(spark, "rv.t")
    assert [r.tableName for r in list_tables(spark, "rv").collect()] == ["t"]
    assert spark.sql("SHOW TABLES IN rv").count() == 3
    # a managed table of the same name is replaced without touching the new data
    spark.sql("DROP VIEW rv.t")
    spark.range(7).write.saveAsTable("rv.t")
    assert replace_table(spark.range(2), "rv.t") == 2 and spark.table("rv.t").count() == 2
    # other columns
    assert replace_table(spark.range(2).selectExpr("'a' as x", "id"), "rv.t", ["x"]) == 2
    assert spark.table("rv.t").columns == ["id", "x"]


def test_readers_see_one_version_at_a_time(spark):
    """A reader in a loop, while partitions and columns change, finds each version whole."""
    import threading
    spark.sql("CREATE DATABASE IF NOT EXISTS ra")

    def version(k):
        df = spark.range(60).selectExpr(f"{k} as version", "id", f"id % {3 + k % 4} as day")
        return df.withColumn("extra", F.lit("x")) if k % 3 == 2 else df
    replace_table(version(0), "ra.t", ["day"])
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                rows = spark.table("ra.t").select("version", "id", "day").collect()
                seen.append(({r.version for r in rows}, len(rows), {r.day for r in rows}))
            except Exception as e:  # noqa: BLE001 - shown by the assertion below
                errors.append(e)
    readers = [threading.Thread(target=read) for _ in range(3)]
    for r in readers:
        r.start()
    for k in range(1, 9):
        replace_table(version(k), "ra.t", ["day"], keep_versions=9)
    stop.set()
    for r in readers:
        r.join()
    assert not errors and len(seen) > 3
    for versions, rows, days in seen:
        assert len(versions) == 1 and rows == 60
        assert len(days) == 3 + next(iter(versions)) % 4


def test_a_refresh_alters_the_view_and_never_drops_it(spark):
    """Readers always find the name: a property set on the view outlives refreshes."""
    from strata.sources.tables import _versions_root, published_version
    spark.sql("CREATE DATABASE IF NOT EXISTS rp")
    replace_table(spark.range(3), "rp.t")
    spark.sql("ALTER VIEW rp.t SET TBLPROPERTIES ('kept' = 'yes')")
    replace_table(spark.range(4).selectExpr("id", "'a' as x", "'b' as `View Text`"), "rp.t", ["x"])
    assert replace_table(spark.table("rp.t").where("id > 0"), "rp.t", ["x"]) == 3
    assert [r.value for r in spark.sql("SHOW TBLPROPERTIES rp.t").where("key = 'kept'").collect()] == ["yes"]
    assert spark.table("rp.t").columns == ["id", "View Text", "x"] and spark.table("rp.t").count() == 3
    assert _finished(spark, _versions_root(spark, "rp.t"))[-1] == published_version(spark, "rp.t")
    # a view of the same name that names no version is replaced
    spark.sql("DROP VIEW rp.t")
    spark.sql("CREATE VIEW rp.t AS SELECT 1 AS one")
    assert published_version(spark, "rp.t") is None
    assert replace_table(spark.range(2), "rp.t") == 2 and spark.table("rp.t").columns == ["id"]


def test_a_slower_refresh_does_not_bring_back_an_older_version(spark, monkeypatch):
    from strata.sources import tables
    spark.sql("CREATE DATABASE IF NOT EXISTS rs")
    began = tables._new_version()
    replace_table(spark.range(5), "rs.t")
    with monkeypatch.context() as m:
        m.setattr(tables, "_new_version", lambda: began)  # began before the one above, ends after
        replace_table(spark.range(9), "rs.t")
    assert spark.table("rs.t").count() == 5


def test_jdbc_text_key_split_by_predicates(spark):
    url = derby_memory_url("strata_test_pred")
    props = {"driver": DERBY_DRIVER}
    src = spark.range(0, 500).select(F.format_string("k%04d", "id").alias("key"), F.col("id").alias("v"))
    write_jdbc(src, url, "t", props)
    # ranges of the text key written in the database's SQL, together covering every row once
    k = 'CAST("key" AS VARCHAR(16))'        # Derby keeps Spark strings as CLOB
    preds = [f"{k} < 'k0100'", f"{k} >= 'k0100' AND {k} < 'k0300'", f"{k} >= 'k0300'",
             '"key" IS NULL']
    back = read_jdbc(spark, url, "t", props, predicates=preds)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == 500 and back.agg(F.sum("v")).first()[0] == sum(range(500))


def test_jdbc_text_key_split_by_quantiles(spark):
    from strata.sources.jdbc import text_key_ranges
    url = derby_memory_url("strata_test_quantiles")
    props = {"driver": DERBY_DRIVER}
    # one key holds a third of the rows, some are NULL, one has a quote
    key = F.when(F.col("id") % 3 == 0, F.lit("it's")).when(F.col("id") % 50 == 1, None) \
        .otherwise(F.format_string("k%04d", F.col("id") * 7919 % 1000))
    src = spark.range(0, 900).select(key.alias("key"), F.col("id").alias("v"))
    write_jdbc(src, url, "t", props)
    k = 'CAST("key" AS VARCHAR(16))'        # Derby keeps Spark strings as CLOB
    ranges = text_key_ranges(spark, url, "t", k, 6, props)
    assert "it''s" in " ".join(ranges) and 4 <= len(ranges) <= 7
    back = read_jdbc(spark, url, "t", props, predicates=ranges)
    assert sorted(r.v for r in back.collect()) == list(range(900))
    sizes = [r["count"] for r in back.where("key IS NOT NULL").groupBy(F.spark_partition_id()).count().collect()]
    # the hot key has the least value, so nothing lies before it
    assert len(sizes) == len(ranges) - 2 and max(sizes) <= 300 + 900 // 6
    write_jdbc(src.limit(0), url, "e", props)
    none = text_key_ranges(spark, url, "e", k, 6, props)
    assert read_jdbc(spark, url, "e", props, predicates=none).count() == 0


def test_csv_columns_follow_the_header(spark, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField(n, StringType()) for n in ("id", "name", "gone")])
    (tmp_path / "a.csv").write_text("extra,name,id\nx,ann,1\n")
    df = read_csv(spark, str(tmp_path / "a.csv"), schema, required=("id",))
    assert df.columns == ["id", "name", "gone", "extra"]
    assert tuple(df.first()) == ("1", "ann", None, "x")
    with pytest.raises(ValueError, match="no column key"):
        read_csv(spark, str(tmp_path / "a.csv"), schema, required=("key",))


def test_csv_files_with_other_headers_fail(spark, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField(n, StringType()) for n in ("id", "name")])
    (tmp_path / "a.csv").write_text("id,name\n1,ann\n")
    (tmp_path / "b.csv").write_text("name,id\nbob,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path), schema).collect()


def test_partitioned_replace_keeps_odd_partitions_and_unfinished_folders(spark):
    import time
    from strata.sources import fs
    from strata.sources.tables import _versions_root, ensure_namespaces
    ensure_namespaces(spark, ["swap_db"])
    name = "swap_db.t"
    odd = [(1, "a"), (2, "007"), (3, None), (4, "it's"), (5, "a/b=c %")]
    replace_table(spark.createDataFrame(odd, "x int, p string"), name, ["p"])
    assert sorted(tuple(r) for r in spark.table(name).collect()) == odd
    root = _versions_root(spark, name)
    # a slower refresh that is still writing (no _SUCCESS yet), and one lost long ago
    unfinished = f"{root}/v{time.time_ns():020d}_00000000"
    lost = f"{root}/v{time.time_ns() - 8 * 86_400 * 10 ** 9:020d}_00000000"
    for folder in (unfinished, lost):
        spark.createDataFrame([(9,)], "x int").write.parquet(folder)
        fs.delete(spark, f"{folder}/_SUCCESS")
    for k in range(4):
        replace_table(spark.createDataFrame([(k, "a"), (k, "c")], "x int, p string"), name, ["p"])
        rows = sorted(tuple(r) for r in spark.table(name).collect())
        assert rows == [(k, "a"), (k, "c")]
    assert fs.exists(spark, unfinished) and not fs.exists(spark, lost)
    assert len(_finished(spark, root)) == 2


def test_stream_keeps_the_session_zone(spark, tmp_path):
    import datetime as dt

    from strata.config import SOURCES
    from strata.streaming import ingest_available
    spec = SOURCES["category_translation"]
    src, out = tmp_path / "src", str(tmp_path / "out")
    src.mkdir()
    (src / "a.csv").write_text("product_category_name_english,product_category_name\ntoys,brinq\n")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
        assert ingest_available(spark, spec, str(src), out, partition_by_day=True) == 1
        assert ingest_available(spark, spec, str(src), out, partition_by_day=True) == 0
        row = spark.read.parquet(out).select("product_category_name", "_ingest_date").first()
        today = dt.datetime.now(dt.timezone(dt.timedelta(hours=14))).date()
        assert row[0] == "brinq" and row[1] == today
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def _csv_text(rows):
    quoted = lambda v: '"' + v.replace('"', '""') + '"' if set(v) & set('",\r\n') else v
    return "".join(",".join(map(quoted, r)) + "\n" for r in rows)


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


SCHEMA = StructType([StructField(n, StringType()) for n in ["id", "zip", "msg"]])


def test_one_csv_file_with_quoted_newlines_is_read_by_many_tasks(spark, tmp_path, small_splits):
    import random
    rng = random.Random(4)
    parts = ["word", " ", "\n", ",", '"', "\n\n", '""', "é", "x" * 40, "\r\n"]
    rows = [(str(i), f"{i:05d}", "".join(rng.choice(parts) for _ in range(rng.randrange(0, 30))) or "-")
            for i in range(1500)]
    rows[700] = ("700", "00700", "many\nlines\n" * 2000)  # runs over several splits
    rows[701] = ("701", "00701", "next\nto it")
    p = tmp_path / "one.csv"
    p.write_bytes(_csv_text([("id", "zip", "msg"), *rows]).encode())
    df = read_csv(spark, str(p), SCHEMA)
    assert "MapInArrow" in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, df.collect())) == sorted(rows)
    tasks = df.select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks >= 4 and p.stat().st_size > 4 * 3000
    # Spark's own reader, one task a file, finds the same records
    alone = read_csv(spark, str(p), SCHEMA, parallel=False)
    assert alone.count() == len(rows) and alone.exceptAll(df).count() == 0


def test_large_csv_file_is_reconciled_with_its_table(spark, tmp_path, small_splits):
    from strata.config import SOURCES
    from strata.plans.suites import source_reconciliation
    spec = SOURCES["category_translation"]
    rows = [(f"k{i}", f"line {i}\nand \"another\",\n") for i in range(900)]
    (tmp_path / spec.file_name).write_text(_csv_text([spec.schema.fieldNames(), *rows]))
    table = spark.createDataFrame(rows, spec.schema)
    found = source_reconciliation(spark, {"category_translation": table}, str(tmp_path)).collect()
    assert [(r.passed, r.value, r.threshold) for r in found] == [(True, 900.0, 900.0)]
    lost = source_reconciliation(spark, {"category_translation": table.limit(899)}, str(tmp_path))
    assert [r.passed for r in lost.collect()] == [False]


def test_split_csv_of_odd_files(spark, tmp_path, small_splits):
    good = _csv_text([("id", "zip", "msg"), *[(str(i), "1", "a\nb") for i in range(400)]])
    (tmp_path / "a b.csv").write_text(good)
    (tmp_path / "empty.csv").write_text("id,zip,msg\n")
    (tmp_path / "windows.csv").write_bytes(good.replace("\n", "\r\n").encode())
    got = read_csv(spark, str(tmp_path), SCHEMA, parallel=True)
    assert got.count() == 800 and {r.msg for r in got.collect()} == {"a\nb", "a\r\nb"}
    (tmp_path / "other.csv").write_text("id,name,msg\n1,2,3\n")
    with pytest.raises(Exception, match="a file has the columns"):
        read_csv(spark, str(tmp_path), SCHEMA, parallel=True).collect()
    (tmp_path / "other.csv").write_text('id,zip,msg\n1,2,"open\n')
    with pytest.raises(ValueError, match="odd number of quotes"):
        read_csv(spark, str(tmp_path), SCHEMA, parallel=True)


def _files(spark, name):
    from strata.sources.tables import _part_folders
    found = {}
    for part, folder in _part_folders(spark, name).items():
        path = folder.replace("file:", "")
        found[part] = len([f for f in os.listdir(path) if f.endswith(".parquet")])
    return found


def test_a_run_is_stored_once_and_days_become_one_file(spark):
    import datetime as dt

    from strata.sources.tables import append_run, compact_runs
    spark.sql("CREATE DATABASE IF NOT EXISTS runs_db")
    name, day = "runs_db.log", dt.datetime(2024, 3, 1, 12)
    rows = lambda k, d, n=2: spark.createDataFrame(
        [(k * 10 + i, day + dt.timedelta(days=d, hours=k)) for i in range(n)], "n int, run_timestamp timestamp")
    for k in range(6):
        append_run(rows(k, k // 3), name, f"run {k}/it's")
    assert append_run(rows(2, 0, 3), name, "run 2/it's") == 3  # tried again, with one row more
    stored = lambda: sorted(r.n for r in spark.table(name).collect())
    want = sorted([k * 10 + i for k in range(6) for i in range(2)] + [22])
    assert stored() == want
    assert compact_runs(spark, name, dt.date(2024, 3, 2)) == {"day-2024-03-01": 7}
    assert stored() == want and _files(spark, name)["day-2024-03-01"] == 1
    assert compact_runs(spark, name, dt.date(2024, 3, 2)) == {}
    # tried again after its rows were moved, then moved again
    append_run(rows(1, 0, 1), name, "run 1/it's")
    want.remove(11)
    assert stored() == want
    assert compact_runs(spark, name, dt.date(2030, 1, 1)) == {"day-2024-03-01": 6, "day-2024-03-02": 6}
    assert stored() == want and _files(spark, name) == {"day-2024-03-01": 1, "day-2024-03-02": 1}
    assert {r.run_id for r in spark.table(name).collect()} == {f"run {k}/it's" for k in range(6)}
    with pytest.raises(ValueError):
        append_run(spark.range(3), name, "other columns")


def test_packing_fills_bins_up_to_the_target():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from strata.sources.tables import pack

    @settings(max_examples=100, deadline=None)
    @given(st.lists(st.integers(0, 250), max_size=30))
    def check(sizes):
        items = {f"i{k}": s for k, s in enumerate(sizes)}
        bins = pack(items, 100)
        load = {}
        for i, (b, n) in bins.items():
            assert n == max(1, -(-items[i] // 100))
            for k in range(b, b + n):
                load.setdefault(k, []).append(items[i])
        assert bins.keys() == items.keys() and sorted(load) == list(range(len(load)))
        assert all(sum(v) <= 100 or sum(v) == max(v) for v in load.values())
    check()


def test_partitions_of_a_table_of_runs_are_written_without_a_sort(spark):
    import datetime as dt

    from strata.sources.tables import WRITERS, _dynamic_overwrite, append_run, compact_runs, pack
    spark.sql("CREATE DATABASE IF NOT EXISTS unsorted_db")
    name, day = "unsorted_db.log", dt.datetime(2024, 3, 1)
    days = WRITERS + 3  # more than one task keeps open
    for k in range(2):
        append_run(spark.createDataFrame([(k, day + dt.timedelta(days=k))], "n int, run_timestamp timestamp"),
                   name, f"run {k}")
    copied = f"EXPLAIN INSERT OVERWRITE TABLE {name} PARTITION (part) SELECT n, run_timestamp, run_id, part FROM {name}"
    with _dynamic_overwrite(spark):
        assert "Sort" not in spark.sql(copied).first()[0]
    assert compact_runs(spark, name, dt.date(2030, 1, 1)) == {"day-2024-03-01": 1, "day-2024-03-02": 1}
    bins = pack({f"d{k}": 1 for k in range(days)}, 1000, WRITERS)
    assert sorted(b for b, _ in bins.values()) == [0] * WRITERS + [1] * 3
