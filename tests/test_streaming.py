"""Restartable stream ingest of a folder of source files."""

from strata.config import SOURCES
from strata.plans.bindings import raw_sources
from strata.sources.files import write_csv
from strata.streaming import ingest_available


def test_ingest_counts_every_batch_and_reruns_add_nothing(spark, sf_small, tmp_path):
    raw = raw_sources(spark, sf_small)["orders"]
    src, out = str(tmp_path / "drop"), str(tmp_path / "bronze_orders")
    write_csv(raw.repartition(104), src)
    # one file per micro-batch: more batches than a session keeps progress for
    first = ingest_available(spark, SOURCES["orders"], src, out, max_files_per_batch=1)
    again = ingest_available(spark, SOURCES["orders"], src, out, max_files_per_batch=1)
    total = raw.count()
    assert (first, again) == (total, 0)
    back = spark.read.parquet(out)
    assert back.count() == total
    assert {"_ingested_at", "_source_file", "_ingest_date"} <= set(back.columns)
    assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == "100"
