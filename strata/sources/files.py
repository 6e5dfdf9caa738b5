"""File sources: CSV reads with an explicit schema, CSV export, audit columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.config import AUDIT_FILE, AUDIT_TIME
from strata.sources import fs
from strata.sources.csv_records import read_records


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of its own file system (local, HDFS, S3, ...),
    not of the driver's local disk."""
    return fs.exists(spark, path)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             multiline: bool = True, infer: bool = False,
             required: Sequence[str] = (), parallel: bool | None = None) -> DataFrame:
    """Read CSV with a header row; columns are found by their names in it.

    With ``schema`` there is no inference pass and text such as ZIP prefixes keeps
    its leading zeros: columns it names get its types (NULL where the file lacks them,
    an error if they are ``required``) and come first, all others follow as text. The
    header is taken from one file, and every other file's must agree with it, else
    reading fails. ``infer=True`` asks Spark to guess types instead (one extra
    pass over the files). ``multiline`` honours quoted newlines, so a record count
    matches a CSV parser's. Files that are larger than a split are then cut into records by
    several tasks (``csv_records``; ``parallel`` decides otherwise), smaller ones are each read
    by one.
    """
    reader = (spark.read.option("header", True)
              .option("multiLine", multiline)
              .option("escape", '"')
              .option("mode", "PERMISSIVE"))
    if schema is None:
        return (reader.option("inferSchema", True) if infer else reader).csv(path)
    names = reader.csv(path).columns  # reads one header, not the data
    check_header(names, required, path)
    types = file_schema(names, schema)
    if parallel is None:
        parallel = multiline and not infer and fs.largest_file(spark, path) > split_bytes(spark)
    if parallel:
        # quotes are paired over lines, as with multiLine
        options = {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
        row = F.from_csv("record", types.toDDL(), options)
        read = read_records(spark, path, names).select(row.alias("row")).select("row.*")
    else:
        read = reader.schema(types).option("enforceSchema", False).csv(path)
    return by_name(read, schema)


def split_bytes(spark: SparkSession) -> int:
    """The session's split size for files, in bytes."""
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def check_header(names: Sequence[str], required: Sequence[str], path: str) -> None:
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")


def file_schema(names: Sequence[str], schema: StructType) -> StructType:
    """The columns of a file in its order: declared types for known names, text for others."""
    types = {f.name: f.dataType for f in schema.fields}
    return StructType([StructField(n, types.get(n, StringType()), True) for n in names])


def by_name(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` (NULL if absent), then all others of ``df``."""
    known = [F.col(f"`{f.name}`") if f.name in df.columns
             else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*known, *[F.col(f"`{c}`") for c in df.columns
                               if c not in schema.fieldNames()])


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV with a header (quoted fields, doubled inner quotes)."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("quoteAll", False).csv(path))


def with_audit(df: DataFrame, source_name: str, day_column: bool = False) -> DataFrame:
    """Add ``_ingested_at`` (one timestamp per query) and ``_source_file``.

    ``day_column`` also adds ``_ingest_date`` (the date of ``_ingested_at``) to
    partition the write by ingest day.
    """
    out = df.withColumns({AUDIT_TIME: F.current_timestamp(), AUDIT_FILE: F.lit(source_name)})
    if day_column:
        out = out.withColumn("_ingest_date", F.to_date(AUDIT_TIME))
    return out


def source_file_column(df: DataFrame) -> DataFrame:
    """``_source_file`` taken from the file each row was read from."""
    return df.withColumn(AUDIT_FILE, F.col("_metadata.file_name"))
