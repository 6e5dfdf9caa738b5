"""Two-pass external shuffle of a corpus into shards (operator 7, DataFrame functions only).

Law ``key``: a row's shard follows from its id and the number of shards alone. Each shard
draws a seeded hash for the id and the largest draw wins, so one more shard takes rows only
into itself.

Pass 1 scatters the records of each shard uniformly, by a seeded hash, into buckets of about
``bucket_bytes``; pass 2 gathers a bucket, puts it in a fixed order, shuffles it with Spark's
``shuffle`` (a Fisher-Yates shuffle with a seed) and numbers it. The slot of a record is its
place in its bucket after the rows of the shard's earlier buckets. Whatever the size of a shard, a
task holds some buckets at a time: those it gathers before Spark's aggregate falls back to sorting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise

SEED = 20240607
BUCKET_BYTES = 16 << 20


def record_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def _draw(key: Column, shard: int, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(seed), key, F.lit(shard)).alias("draw"),
                    F.lit(shard).alias("shard"))


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard with the largest draw for the key (null is a key like any other)."""
    if shards == 1:
        return F.lit(0)
    return F.greatest(*[_draw(key, s, seed) for s in range(shards)])["shard"]


def external_shuffle(docs: DataFrame, shards: int = 16, id_col: str = "doc_id",
                     text_col: str = "text", seed: int = SEED,
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Every row of ``docs`` with its place.

    Returns id, text (columns of those names as given by ``id_col`` and ``text_col``), size
    (record_bytes), law, shard, slot (gapless from 0 in each shard), grown_shard (the shard
    under one more). Null texts stay null; null ids share a shard but not a bucket; fully
    equal rows share a bucket, in which each has a slot of its own; other columns are not
    read. An empty table gives an empty one.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")) \
        .withColumn("size", record_bytes(F.col("text")))
    total = rows.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-int(total) // (shards * bucket_bytes)))
    placed = rows.select(
        "*", shard_of(F.col("id"), shards, seed).alias("shard"),
        shard_of(F.col("id"), shards + 1, seed).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "id", "text"), F.lit(buckets)).alias("bucket"))
    # rows before each bucket of a shard: a table of bucket counts, not of rows
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, "shard-buckets")
    earlier = counts.selectExpr("shard", "bucket", """coalesce(sum(n) over (partition by shard
        order by bucket rows between unbounded preceding and 1 preceding), 0) as before""")
    record = F.struct("id", "text", "size", "grown_shard")
    gathered = placed.groupBy("shard", "bucket").agg(F.collect_list(record).alias("records"))
    shuffled = gathered.join(earlier, ["shard", "bucket"]).select(
        "shard", "before", F.shuffle(F.array_sort("records"), F.lit(seed)).alias("records"))
    return shuffled.select("shard", "before", F.posexplode("records").alias("place", "r")).select(
        F.col("r.id").alias(id_col), F.col("r.text").alias(text_col), F.col("r.size").alias("size"),
        F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("before") + F.col("place")).cast("bigint").alias("slot"),
        F.col("r.grown_shard").cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the shuffled records as Parquet, a folder for each shard; a task writes the
    buckets it has shuffled, in order of their slots."""
    external_shuffle(docs, **options).write.partitionBy("shard").parquet(path)
