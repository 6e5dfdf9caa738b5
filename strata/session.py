"""Session helpers: a standalone session factory and the shared scratch folder.

Library code never creates its own session; every builder takes DataFrames (or a
session handed in by the caller). ``build_session`` exists for standalone runs
(scripts, bench, tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "strata", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session. Master comes from the argument, then
    ``SPARK_MASTER_URL``, then ``local[*]``.

    AQE stays on so shuffle partitions are coalesced and skewed join partitions
    split at run time; FAIR scheduling lets jobs submitted together from separate
    pools (the refresh writes a layer's tables concurrently, one pool per table)
    share executors instead of queueing behind the first; the UI is off because
    nothing here serves pages.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .master(master or os.environ.get("SPARK_MASTER_URL", "local[*]"))
        .config("spark.ui.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


GiB = 1 << 30
MiB = 1 << 20


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (a metadata call per path; no data read)."""
    from strata.sources import fs
    return fs.total_bytes(spark, paths)


def sizing_conf(data_bytes: int, total_cores: int, bytes_per_reducer: int = GiB,
                split_bytes: int = 256 * MiB, max_partitions: int = 100_000) -> dict[str, str]:
    """Shuffle and scan settings sized from the input, for ``build_session(extra=...)``.

    * shuffle partitions: one per ``bytes_per_reducer`` of input (shuffles carry
      pruned, partially aggregated rows, so each reducer gets less), at least two
      waves of ``total_cores`` and at most ``max_partitions`` (map-output status
      grows with maps x reducers). AQE then merges small ones to the advisory size,
      so the upper end costs little when a stage shrinks;
    * scan splits of ``split_bytes``;
    * a partition is skewed past 4x the median and ``4 x split_bytes``, and is then
      split by AQE's skew join;
    * the broadcast threshold stays at its default: only sides measured (by size
      estimate or at run time by AQE) under it are broadcast.

    At 100 TB on 1,000 executors x 8 cores this gives 100,000 shuffle partitions and
    256 MiB splits; at sf0.1 on 8 cores, 16 partitions.
    """
    wanted = -(-data_bytes // bytes_per_reducer)
    partitions = max(2 * total_cores, min(max_partitions, wanted))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split_bytes),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * split_bytes),
    }


def size_session(spark: SparkSession, paths: list[str],
                 total_cores: int | None = None, **options) -> dict[str, str]:
    """Measure ``paths`` and apply ``sizing_conf`` to the running session (these are
    run-time SQL settings). ``total_cores`` defaults to the default parallelism."""
    conf = sizing_conf(input_bytes(spark, paths),
                       total_cores or spark.sparkContext.defaultParallelism, **options)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Taken from ``spark.checkpoint.dir`` (or an already set checkpoint dir). Only a
    local-mode session without one gets a fresh temporary folder, as in tests; on
    a cluster a machine-local folder would not be visible to other executors, so
    a missing setting is an error there.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or \
        spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a shared folder (HDFS/S3/...) for this cluster")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage.

    A reliable checkpoint survives the loss of executors (unlike a local one) and
    pins the result of non-deterministic steps, e.g. sampled range bounds.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
