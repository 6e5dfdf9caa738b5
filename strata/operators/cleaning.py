"""Row-level cleaning operators: trim/blank handling, casts, case, key and box filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.functions.columns import blank_to_null, to_double, to_int, to_timestamp

_CASTS = {
    "timestamp": to_timestamp,
    "double": to_double,
    "int": to_int,
}


def clean_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Trim every string column (or the given ones) and turn blanks into NULL.

    Done as one projection, so the analysed plan does not grow per column.
    """
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[
        blank_to_null(F.col(c)).alias(c) if c in targets else F.col(c) for c in df.columns])


def cast_columns(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast columns by name: ``{"price": "double", "score": "int", "ts": "timestamp"}``.

    Bad values become NULL (``try_cast``), as a non-ANSI cast did before Spark 4.
    """
    unknown = set(casts.values()) - set(_CASTS)
    if unknown:
        raise ValueError(f"unsupported cast target(s): {sorted(unknown)}")
    return df.select(*[
        _CASTS[casts[c]](F.col(c)).alias(c) if c in casts else F.col(c) for c in df.columns])


def upper_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    cols = set(columns)
    return df.select(*[F.upper(F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def require_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Drop rows whose key columns hold a NULL."""
    cond = None
    for k in keys:
        part = F.col(k).isNotNull()
        cond = part if cond is None else cond & part
    return df if cond is None else df.where(cond)


def within_box(df: DataFrame, lat: str, lng: str,
               lat_range: tuple[float, float], lng_range: tuple[float, float]) -> DataFrame:
    """Keep rows inside an inclusive latitude/longitude box; NULL coordinates drop out."""
    return df.where(F.col(lat).between(*lat_range) & F.col(lng).between(*lng_range))
