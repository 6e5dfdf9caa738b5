"""Calendar spine: one row per day between two inclusive ends."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import calendar_parts, date_key
from strata.session import cut_lineage


# A calendar of up to this many days (about 550 years, a few MB) may be broadcast;
# a longer one is joined by sort-merge.
BROADCAST_DAYS = 200_000


def _as_date(d: str | dt.date | dt.datetime) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)[:10])


def _spine(frame: DataFrame, lo, hi, days: int) -> DataFrame:
    spine = frame.select(F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))).alias("full_date"))
    return spine if days <= BROADCAST_DAYS else spine.hint("merge")


def date_spine(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """``full_date`` for every day from ``start`` to ``end`` inclusive.

    The row count (days in the span) is known on the driver before any job runs.
    Catalyst cannot estimate generated rows, so the size check is made here: a
    span of at most ``BROADCAST_DAYS`` is left to the broadcast join, a longer one
    carries a sort-merge join hint.
    """
    lo, hi = _as_date(start), _as_date(end)
    return _spine(spark.range(1), F.lit(lo), F.lit(hi), (hi - lo).days + 1)


def date_spine_covering(df: DataFrame, column: str) -> DataFrame:
    """A spine from the earliest to the latest date found in ``df[column]``.

    The bounds come from one global min/max aggregate, written to the shared
    checkpoint folder; the span is read back (two values reach the driver) and
    checked as in ``date_spine``, so a stray far-off date in the data cannot turn
    into a large broadcast, and the spine is generated from the checkpointed row.
    """
    bounds = cut_lineage(df.agg(F.to_date(F.min(column)).alias("lo"),
                                F.to_date(F.max(column)).alias("hi")))
    lo, hi = bounds.first()
    days = (hi - lo).days + 1 if lo is not None else 0
    return _spine(bounds.where(F.col("lo").isNotNull()), F.col("lo"), F.col("hi"), days)


def with_calendar_columns(spine: DataFrame) -> DataFrame:
    """date_id (yyyymmdd), full_date and the calendar parts of a spine."""
    parts = calendar_parts("full_date")
    return spine.select(date_key("full_date").alias("date_id"), "full_date",
                        *[c.alias(n) for n, c in parts.items()])
