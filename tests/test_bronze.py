"""Source switch (CSV / JDBC) and reconciliation of Bronze with its files."""

import os

from strata.config import SOURCES
from strata.plans.bindings import raw_sources
from strata.plans.bronze import bronze, read_source
from strata.plans.suites import bronze_suite, source_reconciliation
from strata.sources.jdbc import DERBY_DRIVER, derby_memory_url, seed_from_files


def test_csv_and_jdbc_sources_agree_and_reconcile(spark, sf_small, tmp_path):
    raw = raw_sources(spark, sf_small)
    spec = SOURCES["orders"]
    pdf = raw["orders"].toPandas()
    pdf.loc[0, "order_status"] = 'say "x"\nnext line'  # quoted newline + doubled quote
    pdf.to_csv(os.path.join(tmp_path, spec.file_name), index=False)

    from_csv = read_source(spark, spec, "csv", directory=str(tmp_path))
    url = derby_memory_url("strata_bronze_switch")
    props = {"driver": DERBY_DRIVER}
    assert seed_from_files(spark, str(tmp_path), url, props)["orders"] == "loaded"
    from_jdbc = read_source(spark, spec, "jdbc", url=url, properties=props)

    def rows(df):
        return sorted((tuple(r) for r in df.select(*from_csv.columns).collect()), key=repr)

    assert rows(from_csv) == rows(from_jdbc)
    assert from_csv.count() == len(pdf)

    b = bronze({"orders": from_csv})
    assert {"_ingested_at", "_source_file", "_ingest_date"} <= set(b["orders"].columns)
    rec = source_reconciliation(spark, b, str(tmp_path)).collect()
    assert [(r.check_name, r.passed, r.value) for r in rec] == [
        ("rowcount_matches_csv", True, float(len(pdf)))]
    suite = {r.check_name: r.passed for r in bronze_suite(b).collect()}
    assert suite == {"row_count_gt_0": True, "order_id_not_null": True}


def test_reconciliation_skips_missing_files(spark, tmp_path):
    assert source_reconciliation(spark, {"orders": spark.range(1)}, str(tmp_path)) is None


def test_splittable_csv_reads_agree_without_quoted_newlines(spark, sf_small, tmp_path):
    from strata.plans.bronze import read_sources
    from strata.sources.files import write_csv

    spec = SOURCES["order_items"]
    write_csv(raw_sources(spark, sf_small)["order_items"], f"{tmp_path}/{spec.file_name}")
    whole = read_source(spark, spec, "csv", directory=str(tmp_path))
    split = read_sources(spark, "csv", directory=str(tmp_path),
                         splittable=["order_items"])["order_items"]
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, split.collect()))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(16 * 1024))
    try:
        files = len([f for f in os.listdir(f"{tmp_path}/{spec.file_name}") if f.endswith(".csv")])
        again = read_sources(spark, "csv", directory=str(tmp_path), splittable=["order_items"])
        assert again["order_items"].rdd.getNumPartitions() > files   # files split
        # so are files that may hold quoted newlines
        cut = read_source(spark, spec, "csv", directory=str(tmp_path))
        assert cut.rdd.getNumPartitions() > files
        assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
