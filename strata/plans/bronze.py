"""Raw sources -> Bronze: source switch (files or JDBC) and audit columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.config import SOURCES, SourceSpec
from strata.plans.lazy import LazyFrames
from strata.sources.files import read_csv, with_audit
from strata.sources.jdbc import read_jdbc


def read_source(spark: SparkSession, spec: SourceSpec, kind: str = "csv",
                directory: str | None = None, url: str | None = None,
                properties: Mapping[str, str] | None = None, schema_prefix: str = "",
                infer: bool = False, partition_column: str | None = None,
                num_partitions: int | None = None, splittable: bool = False,
                predicates: Sequence[str] | None = None) -> DataFrame:
    """Read one raw source from CSV files (explicit schema unless ``infer``) or
    from a JDBC table of the same name.

    CSV records may hold quoted newlines, so by default the splits of a large file are
    cut into records by their quotes first (one more reading of the file);
    ``splittable=True`` (for files known to hold none) lets Spark split it at any
    line. A JDBC read is split into
    ``num_partitions`` ranges of a numeric/date ``partition_column`` when one is
    given, or into one task per condition of ``predicates`` (one connection and one
    task otherwise, as the reference reads)."""
    if kind == "csv":
        path = f"{(directory or '.').rstrip('/')}/{spec.file_name}"
        return read_csv(spark, path, None if infer else spec.schema,
                        multiline=not splittable, infer=infer, required=spec.keys)
    if kind == "jdbc":
        return read_jdbc(spark, url, f"{schema_prefix}{spec.table}", properties,
                         partition_column=partition_column, num_partitions=num_partitions,
                         predicates=predicates)
    raise ValueError(f"unknown source kind {kind!r} (use 'csv' or 'jdbc')")


def bronze(raw: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    """Audit columns on every raw table; the partitioned ones also get
    ``_ingest_date`` to partition the write by ingest day. Each table is built
    when first asked for, so an unused source is never opened."""
    def audited(name: str) -> DataFrame:
        spec = SOURCES.get(name)
        return with_audit(raw[name], spec.file_name if spec else name,
                          day_column=spec.partitioned if spec else False)
    return LazyFrames({name: (lambda name=name: audited(name)) for name in raw})


def read_sources(spark: SparkSession, kind: str = "csv",
                 partition_columns: Mapping[str, str] | None = None,
                 predicates: Mapping[str, Sequence[str]] | None = None,
                 splittable: Iterable[str] = (), **options) -> Mapping[str, DataFrame]:
    """All nine sources. Per table, ``partition_columns`` names the numeric column a
    JDBC read is split on and ``predicates`` the conditions splitting it otherwise;
    ``splittable`` names the CSV sources without quoted newlines whose large files
    may be split. Each source is opened when first used."""
    split, where, plain = dict(partition_columns or {}), dict(predicates or {}), set(splittable)
    return LazyFrames({
        name: (lambda name=name, spec=spec: read_source(
            spark, spec, kind, partition_column=split.get(name), predicates=where.get(name),
            splittable=name in plain, **options))
        for name, spec in SOURCES.items()})
