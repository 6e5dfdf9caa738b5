"""Session sizing from the input and the shared scratch folder."""

from strata.session import GiB, MiB, input_bytes, shared_dir, size_session, sizing_conf


def test_sizing_bounds():
    small = sizing_conf(40 * MiB, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"          # two waves of cores
    big = sizing_conf(100 * 1024 * GiB, total_cores=8000)
    assert big["spark.sql.shuffle.partitions"] == "100000"        # capped
    mid = sizing_conf(300 * GiB, total_cores=64)
    assert mid["spark.sql.shuffle.partitions"] == "300"           # one per GiB of input
    assert mid["spark.sql.files.maxPartitionBytes"] == str(256 * MiB)
    assert mid["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"] == str(GiB)


def test_size_session_applies_to_running_session(spark, sf_small):
    paths = [f"{sf_small}/orders.parquet", f"{sf_small}/lineitem.parquet"]
    assert input_bytes(spark, paths) > 0
    keys = sizing_conf(1, 1).keys()
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        conf = size_session(spark, paths, total_cores=3)
        assert spark.conf.get("spark.sql.shuffle.partitions") == conf[
            "spark.sql.shuffle.partitions"] == "6"
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark).rstrip("/").endswith("checkpoints") or "checkpoints" in shared_dir(spark)
