"""The job of each layer."""

from strata.config import SOURCES
from strata.plans.bindings import raw_sources
from strata.run import main
from strata.sources.files import write_csv


def test_layers_as_jobs(spark, sf_small, tmp_path):
    raw = raw_sources(spark, sf_small)
    for name in raw:
        write_csv(raw[name], str(tmp_path / SOURCES[name].file_name))
    here = ["--prefix", "job_", "--csv-dir", str(tmp_path)]
    assert main(["bronze", *here], spark) == 0
    # the default purchase window does not fit: the gate fails, and so does the next layer's job
    assert main(["silver", *here], spark) == 1
    assert main(["gold", *here], spark) == 1
    assert not spark.catalog.tableExists("job_gold.fact_orders")
    window = ["--purchase-window", "1990-01-01 00:00:00", "2010-12-31 00:00:00"]
    for layer in ("silver", "gold", "platinum"):
        assert main([layer, *here, *window], spark) == 0
    orders = spark.table("job_bronze.orders").count()
    assert spark.table("job_platinum.mart_monthly_revenue").agg({"order_count": "sum"}).first()[0] == orders
