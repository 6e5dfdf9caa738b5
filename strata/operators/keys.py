"""Dense surrogate keys 1..n over the sorted distinct values of a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import cut_lineage


def dense_surrogate_key(df: DataFrame, value: str, key: str,
                        partitions: int | None = None) -> DataFrame:
    """Columns ``key`` (1..n, by ascending ``value``) and ``value``; NULLs dropped.

    No single task sees the whole domain: the distinct values are range
    partitioned and sorted, each value's position inside its partition comes from
    ``monotonically_increasing_id``, and each partition's offset from a running
    sum over the per-partition counts (one row per partition, broadcast). The
    range-partitioned values are checkpointed first, which fixes the sampled range
    bounds for both uses and cuts the lineage.
    """
    domain = df.select(value).where(F.col(value).isNotNull()).distinct()
    ranged = (domain.repartitionByRange(*([partitions] if partitions else []), value)
                    .sortWithinPartitions(value)
                    .select(value,
                            F.spark_partition_id().alias("__pid"),
                            F.monotonically_increasing_id().alias("__pos")))
    ranged = cut_lineage(ranged)
    per_part = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"),
                                           F.min("__pos").alias("__base"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("__pid", "__base",
                              F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (ranged.join(F.broadcast(offsets), on="__pid")
                  .select((F.col("__pos") - F.col("__base") + F.col("__off") + 1)
                          .cast("int").alias(key), value))
