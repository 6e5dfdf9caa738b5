"""Distinct counts that add up: bitmaps of dense ids, counted at several levels at once.

An id sets one bit in the bitmap of its bucket (32,768 ids, 4 kB); a distinct count is the sum of
the bits over the buckets. Bitmaps of finer groups are merged into those of coarser ones, which
counts alone cannot be. They pay off where ids are dense (surrogate keys): a bucket in which a
group has few ids still takes its 4 kB.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """keys, bucket, bitmap: which ids each group has (NULL ids none). Built map-side, so a group
    that holds a third of all rows is some 4 kB a bucket and task."""
    ids = df.where(F.col(id_col).isNotNull())
    return ids.groupBy(*keys, F.bitmap_bucket_number(id_col).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("bitmap"))


def merged_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups, from stored ones of finer groups."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counted(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """keys and the number of different ids of each group."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias(name))


def distinct_counts(df: DataFrame, levels: Sequence[Sequence[str]],
                    ids: Mapping[str, str]) -> DataFrame:
    """Distinct ids (output name -> id column) of the groups of every level: one row per group,
    columns of other levels NULL, and ``level`` (its place in ``levels``).

    The rows are read once, give each id its bit at every level (grouping sets, combined map-side)
    and are shuffled once as bitmaps, whatever the number of levels and ids; the counts that are
    added up after that are some numbers a bucket."""
    keys = list(dict.fromkeys(k for level in levels for k in level))
    marked = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(c).cast("bigint").alias("id"))
        for name, c in ids.items()])).alias("__i")).select(*keys, "__i.*")
    bucket, position = F.bitmap_bucket_number("id"), F.bitmap_bit_position("id")
    marked = marked.select(*keys, "name", bucket.alias("__bucket"), position.alias("__at"))
    fixed = [F.col("name"), F.col("__bucket")]
    sets = [[*map(F.col, level), *fixed] for level in levels]
    bits = marked.groupingSets(sets, *map(F.col, keys), *fixed).agg(
        F.grouping_id().alias("__level"), F.bitmap_construct_agg("__at").alias("__bits"))
    # grouping_id has a bit for each key that the level leaves out, the last key lowest
    numbers = [sum(1 << (len(keys) + 1 - i) for i, k in enumerate(keys) if k not in level)
               for level in levels]
    place = F.array_position(F.array(*[F.lit(n).cast("bigint") for n in numbers]),
                             F.col("__level")).cast("int") - 1
    counts = [F.coalesce(F.sum(F.when(F.col("name") == name, F.bitmap_count("__bits"))),
                         F.lit(0)).cast("bigint").alias(name) for name in ids]
    return bits.groupBy(place.alias("level"), *keys).agg(*counts)
