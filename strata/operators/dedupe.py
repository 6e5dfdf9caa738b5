"""Deterministic de-duplication."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UNORDERABLE = ("map<", "variant")


def survivor_order(df: DataFrame, keys: Iterable[str]) -> list[Column]:
    """Default survivor order: every non-key column ascending, NULLs first."""
    keyset = set(keys)
    return [F.col(c).asc_nulls_first() for c, t in df.dtypes
            if c not in keyset and not t.startswith(_UNORDERABLE)]


def dedupe(df: DataFrame, keys: Sequence[str],
           order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """Keep one row per key: the first under ``order_by`` (default: all other
    columns ascending), so re-runs keep the same survivor.

    Planned as ``row_number() = 1``: Catalyst adds a partial group limit before the
    shuffle, so even a key that holds a large share of the rows arrives at its
    reducer as at most one row per map task.
    """
    keys = list(keys)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by] if order_by \
        else survivor_order(df, keys)
    if not order:
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1)
              .drop("__rn"))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct projection (partial aggregation before the shuffle)."""
    return df.select(*columns).distinct()
