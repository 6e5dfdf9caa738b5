"""Restartable Bronze ingest of a folder of source files.

The same step as the batch ingest (explicit schema, audit columns), run as a
Structured Streaming query with the ``availableNow`` trigger: every file present
when it starts is read once, in bounded micro-batches, and written to a Parquet
folder with an exactly-once file sink. The checkpoint records which files are
done, so after an executor or driver failure a rerun continues where it stopped
and a rerun with no new files writes nothing.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.config import AUDIT_FILE, AUDIT_TIME, SourceSpec
from strata.sources import fs
from strata.sources.files import by_name, check_header, file_schema


def ingest_available(spark: SparkSession, spec: SourceSpec, directory: str, output_path: str,
                     checkpoint: str | None = None, max_files_per_batch: int = 1000,
                     partition_by_day: bool | None = None) -> int:
    """Ingest the files in ``directory`` not yet ingested; returns rows written now.

    ``checkpoint`` defaults to a folder next to ``output_path`` (it must stay with
    the output for exactly-once to hold).
    """
    checkpoint = checkpoint or output_path.rstrip("/") + "__checkpoint"
    before = _rows(spark, output_path)
    schema = spec.schema
    if fs.has_files(spark, directory):
        names = spark.read.option("header", True).option("multiLine", True) \
            .option("escape", '"').csv(directory).columns
        check_header(names, spec.keys, directory)
        schema = file_schema(names, spec.schema)
    stream = (spark.readStream.schema(schema).option("enforceSchema", False)
              .option("header", True).option("multiLine", True).option("escape", '"')
              .option("maxFilesPerTrigger", max_files_per_batch)
              .csv(directory).withColumn("__file", F.col("_metadata.file_name")))
    df = by_name(stream, spec.schema).withColumns({AUDIT_TIME: F.current_timestamp(),
                             AUDIT_FILE: F.col("__file")}).drop("__file")
    by_day = spec.partitioned if partition_by_day is None else partition_by_day
    if by_day:
        df = df.withColumn("_ingest_date", F.to_date(AUDIT_TIME))
    writer = (df.writeStream.format("parquet").option("path", output_path)
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if by_day:
        writer = writer.partitionBy("_ingest_date")
    query = writer.start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return _rows(spark, output_path) - before


def _rows(spark: SparkSession, path: str) -> int:
    """Rows of the ingested folder (from the files' footers); 0 before the first run."""
    return spark.read.parquet(path).count() if fs.has_files(spark, path) else 0
