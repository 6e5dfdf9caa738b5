"""The materialised refresh: gates stop it, reruns give the same marts."""

import pytest

from strata.operators.quality import DQError
from strata.plans.bindings import EMBEDDING_BOX, raw_sources
from strata.plans.layers import MARTS
from strata.plans.refresh import refresh_all
from strata.plans.registry import TEST_CALENDAR

WINDOW = ("1995-01-01 00:00:00", "2001-12-31 00:00:00")


def snapshot(spark, prefix):
    out = {}
    for m in MARTS:
        rows = spark.table(f"{prefix}platinum.{m}").collect()
        out[m] = sorted((tuple(r) for r in rows), key=repr)
    return out


def test_gate_stops_on_default_purchase_window(spark, sf_small):
    # the test orders run 1995-2001, outside the default 2016-2019 window
    with pytest.raises(DQError, match="purchase_ts_in_range"):
        refresh_all(spark, raw_sources(spark, sf_small), TEST_CALENDAR, EMBEDDING_BOX,
                    namespace_prefix="t1_")
    assert not spark.catalog.tableExists("t1_gold.fact_orders")
    stored = spark.table("t1_meta.dq_results").where("layer = 'silver' AND NOT passed").collect()
    assert [r.check_name for r in stored] == ["purchase_ts_in_range"]


def test_refresh_twice_same_marts(spark, sf_small):
    c1 = refresh_all(spark, raw_sources(spark, sf_small), TEST_CALENDAR, EMBEDDING_BOX,
                     namespace_prefix="t2_", purchase_window=WINDOW)
    first = snapshot(spark, "t2_")
    c2 = refresh_all(spark, raw_sources(spark, sf_small), TEST_CALENDAR, EMBEDDING_BOX,
                     namespace_prefix="t2_", purchase_window=WINDOW)
    assert c1 == c2 and snapshot(spark, "t2_") == first
    assert c1["gold.fact_orders"] == c1["silver.orders"]
    assert spark.table("t2_meta.dq_results").where("NOT passed").count() == 0
    # the table tests ran after the marts, on the written tables
    tests = spark.table("t2_meta.dq_results").where("layer = 'tests'")
    assert tests.where("check_name = 'total_revenue_non_negative'").count() == 2
    from strata.sources.tables import list_namespaces, list_tables
    assert {r.namespace for r in list_namespaces(spark).collect()} >= {
        "t2_bronze", "t2_silver", "t2_gold", "t2_platinum", "t2_meta"}
    assert {r.tableName for r in list_tables(spark, "t2_platinum").collect()} == set(MARTS)
    assert spark.sql("SELECT count(*) FROM t2_gold.fact_orders").first()[0] == c1["gold.fact_orders"]


def test_resume_from_gold_reads_written_layers(spark, sf_small):
    full = refresh_all(spark, raw_sources(spark, sf_small), TEST_CALENDAR, EMBEDDING_BOX,
                       namespace_prefix="t3_", purchase_window=WINDOW)
    before = snapshot(spark, "t3_")
    resumed = refresh_all(spark, None, TEST_CALENDAR, EMBEDDING_BOX, namespace_prefix="t3_",
                          purchase_window=WINDOW, start_at="gold")
    # only gold and platinum are written again, with the same rows and marts
    assert {k.split(".")[0] for k in resumed} == {"gold", "platinum"}
    assert all(resumed[k] == full[k] for k in resumed)
    assert snapshot(spark, "t3_") == before
    with pytest.raises(ValueError):
        refresh_all(spark, None, namespace_prefix="t3_")


def test_resume_after_failed_gate_is_stopped(spark, sf_small):
    with pytest.raises(DQError, match="purchase_ts_in_range"):
        refresh_all(spark, raw_sources(spark, sf_small), TEST_CALENDAR, EMBEDDING_BOX,
                    namespace_prefix="t4_")
    with pytest.raises(DQError, match="purchase_ts_in_range"):
        refresh_all(spark, None, TEST_CALENDAR, EMBEDDING_BOX, namespace_prefix="t4_",
                    start_at="gold")
    assert not spark.catalog.tableExists("t4_gold.fact_orders")


def test_written_tables_are_held_against_their_files(spark, sf_small, tmp_path):
    from strata.config import SOURCES
    from strata.sources.files import write_csv
    raw = raw_sources(spark, sf_small)
    # the file has more records than the rows that are ingested
    write_csv(raw["orders"].union(raw["orders"].limit(5)),
              str(tmp_path / SOURCES["orders"].file_name))
    with pytest.raises(DQError, match="rowcount_matches_csv"):
        refresh_all(spark, raw, TEST_CALENDAR, EMBEDDING_BOX, namespace_prefix="t5_",
                    purchase_window=WINDOW, csv_dir=str(tmp_path))
    assert not spark.catalog.tableExists("t5_silver.orders")
