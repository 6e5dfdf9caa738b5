"""Catalog tables: namespaces, full-refresh replace, append, listing.

A refreshed table is a view that names one version: an external table over the folder that one
refresh has written. Altering the view is one catalog call, so a reader sees the old version
whole or the new one, whatever its partitions and columns; what it has begun to read stays, as
the newest versions are kept. Appended tables (quality results, logs) hold each run once.
"""

from __future__ import annotations

import datetime as dt
import logging
import re
import time
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.config import NAMESPACES
from strata.session import cut_lineage
from strata.sources import fs


VERSION_NAME = "__v[0-9]{20}_[0-9a-f]{8}$"
# a folder without a finished write is taken for lost after this many days
STALE_DAYS = 7

_log = logging.getLogger(__name__)


def ensure_namespaces(spark: SparkSession, names: Iterable[str] = NAMESPACES) -> None:
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {n}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _split(spark: SparkSession, name: str) -> tuple[str, str]:
    db, _, table = name.rpartition(".")
    return db or spark.catalog.currentDatabase(), table


def _versions_root(spark: SparkSession, name: str) -> str:
    """Folder holding the table's data versions, next to (never inside) the path a
    managed table of that name would own."""
    db, table = _split(spark, name)
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{table}__versions"


def _new_version() -> str:
    """Versions sort by the time at which their refresh began."""
    return f"v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"


def _version_table(spark: SparkSession, name: str, version: str) -> str:
    db, table = _split(spark, name)
    return f"{db}.{table}__{version}"


def _declare(spark: SparkSession, table: str, location: str, fmt: str, schema: StructType,
             partition_by: Sequence[str]) -> None:
    """An external table over a written version (metadata only: no file is opened)."""
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    columns = ", ".join(f"`{n}` {t}" for n, t in types.items())
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt}{parts} LOCATION '{location}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def published_version(spark: SparkSession, name: str) -> str | None:
    """The version that readers of ``name`` see, as the text of its view names it; None if it is
    no refreshed table."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType != "VIEW":
        return None
    texts = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").collect()
    found = re.search(VERSION_NAME, texts[-1].data_type) if texts else None
    return found.group().removeprefix("__") if found else None


def _publish(spark: SparkSession, name: str, version: str) -> bool:
    """Point the view to the version, unless it already names one of a refresh that began later.
    A table of that name from outside is dropped first. A refreshed one is altered: to replace a
    view, Spark drops it and creates another, and readers in between find none."""
    current = published_version(spark, name)
    if current and current > version:
        _log.warning("%s was refreshed meanwhile by a later run; version %s is not published", name, version)
        return False
    if current is None and spark.catalog.tableExists(name):
        spark.sql(f"DROP {'VIEW' if spark.catalog.getTable(name).tableType == 'VIEW' else 'TABLE'} {name}")
    spark.sql(f"{'ALTER' if current else 'CREATE OR REPLACE'} VIEW {name} "
              f"AS SELECT * FROM {_version_table(spark, name, version)}")
    return True


def _drop_old_versions(spark: SparkSession, name: str, root: str, keep: int,
                       stale_days: float) -> None:
    """Delete finished versions older than the published one, but for the newest ``keep - 1``. A
    folder without a finished write may belong to a refresh that is still running: it stays until
    it is ``stale_days`` old."""
    current = published_version(spark, name) or ""
    older = [v for v in fs.subdirectories(spark, root) if v < current]
    finished = [v for v in older if fs.exists(spark, f"{root}/{v}/_SUCCESS")]
    lost = f"v{time.time_ns() - int(stale_days * 86_400 * 10**9):020d}"
    gone = finished[:len(finished) - (keep - 1)] + \
        [v for v in older if v not in finished and v < lost]
    for version in gone:
        spark.sql(f"DROP TABLE IF EXISTS {_version_table(spark, name, version.replace('-', '_'))}")
        fs.delete(spark, f"{root}/{version}")


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] | None = None,
                  fmt: str = "parquet", keep_versions: int = 2,
                  stale_days: float = STALE_DAYS) -> int:
    """Full refresh of ``name`` with ``df``; returns the number of rows written.

    The rows go to a new version folder (one write job; rows are counted by an
    ``Observation`` inside it, so the plan runs once), which is declared with its columns and
    partitions before the view is pointed at it, in one call. No data file is moved or copied -
    on an object store a rename is a copy of the whole table - and ``df`` may read the table it
    replaces. The newest ``keep_versions`` finished folders are kept (queries still reading the
    previous version finish); older ones, and unfinished ones older than ``stale_days``, are
    deleted. Of two refreshes at once, readers end up with the one that began later.
    """
    spark = df.sparkSession
    root, version = _versions_root(spark, name), _new_version()
    obs = Observation()
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists") \
        .format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{root}/{version}")
    _declare(spark, _version_table(spark, name, version), f"{root}/{version}", fmt, df.schema,
             list(partition_by or []))
    _publish(spark, name, version)
    _drop_old_versions(spark, name, root, max(1, keep_versions), stale_days)
    return int(obs.get["rows"])


# columns of a table of runs: the run that a row is of, and the partition it lies in, which is the
# run's own until ``compact_runs`` moves it to that of its day
RUN, PART = "run_id", "part"
DAY_PART = "day-"


# partitions that a write task has open at once: within them its rows need no sort
WRITERS = 32


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrites replace the partitions that have rows, and no others. A task writes up to
    ``WRITERS`` of them side by side as its rows come, and so holds none of its rows in a sort."""
    conf = {"spark.sql.sources.partitionOverwriteMode": "dynamic",
            "spark.sql.maxConcurrentOutputFileWriters": str(WRITERS)}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _put(rows: DataFrame, name: str) -> None:
    spark = rows.sparkSession
    columns = spark.table(name).columns
    if sorted(columns) != sorted(rows.columns):
        raise ValueError(f"{name} has the columns {columns}, not {rows.columns}")
    with _dynamic_overwrite(spark):
        rows.select(*columns).write.insertInto(name, overwrite=True)


def append_run(df: DataFrame, name: str, run_id: str, fmt: str = "parquet") -> int:
    """Put the rows of one run into ``name``, a table of runs (created if missing); returns how
    many. The run's own partition is overwritten, so a run that is tried again leaves its rows
    once, without those of an attempt that failed half-way, also if its rows were moved to their
    day meanwhile."""
    if run_id.startswith(DAY_PART):
        raise ValueError(f"the name of a run must not begin with {DAY_PART}")
    spark = df.sparkSession
    obs = Observation()
    rows = df.observe(obs, F.count(F.lit(1)).alias("rows")) \
        .withColumns({RUN: F.lit(run_id), PART: F.lit(run_id)})
    if not spark.catalog.tableExists(name):
        rows.write.format(fmt).partitionBy(PART).saveAsTable(name)
        return int(obs.get["rows"])
    days = spark.table(name).where(F.col(PART).startswith(DAY_PART))
    moved = [r[0] for r in days.where(F.col(RUN) == run_id).select(PART).distinct().collect()]
    for part in moved:  # the day (or two) that the run's earlier rows were moved to
        others = days.where((F.col(PART) == part) & (F.col(RUN) != run_id))
        if others.isEmpty():
            _drop_parts(spark, name, [part])
        else:
            _put(others, name)
    _put(rows, name)
    return int(obs.get["rows"])


def _drop_parts(spark: SparkSession, name: str, parts: Sequence[str]) -> None:
    """Drop partitions of a table of runs, in one catalog call."""
    texts = [p.replace("\\", "\\\\").replace("'", "\\'") for p in parts]
    specs = ", ".join(f"PARTITION ({PART}='{p}')" for p in texts)
    if specs:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")


def pack(sizes: Mapping[str, int], target: int, most: int | None = None) -> dict[str, tuple[int, int]]:
    """Bins of at most ``target`` (and ``most`` items), the largest item first, each into the fullest
    bin with room: the first bin of every item and its number of bins, which is above 1 for items
    over ``target``."""
    bins: dict[str, tuple[int, int]] = {}
    room: list[int] = []
    held: Counter[int] = Counter()
    for item in sorted(sizes, key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        if size > target:
            parts = -(-size // target)
            bins[item] = (len(room), parts)
            held.update(range(len(room), len(room) + parts))
            room += [0] * parts
            continue
        fitting = [(left, b) for b, left in enumerate(room)
                   if left >= size and (most is None or held[b] < most)]
        if fitting:
            b = min(fitting)[1]
        else:
            b = len(room)
            room.append(target)
        room[b] -= size
        held[b] += 1
        bins[item] = (b, 1)
    return bins


def compact_runs(spark: SparkSession, name: str, before: dt.date, stamp: str = "run_timestamp",
                 target_bytes: int = 128 << 20) -> dict[str, int]:
    """Move the runs of ``name`` that ended before the day ``before`` (by the column ``stamp``) to
    one partition for the day they began on; returns the rows of each such partition.

    A day is one file, or as many as ``target_bytes`` go into it; small days share a write task
    (``pack``), up to ``WRITERS`` of them. The days are written whole, then the runs' own partitions are dropped: a failure in
    between leaves runs twice, until they are moved again, which replaces the day's rows of these
    runs. The driver holds a row for each run that is moved and for each day.
    """
    table = spark.table(name)
    runs = table.where(~F.col(PART).startswith(DAY_PART)).groupBy(PART).agg(
        F.min(stamp).alias("began"), F.max(stamp).alias("ended")) \
        .where(F.to_date("ended") < F.lit(before)) \
        .select(PART, F.concat(F.lit(DAY_PART), F.to_date("began").cast("string")).alias("day"))
    runs = cut_lineage(runs)
    days = sorted(r.day for r in runs.select("day").distinct().collect())
    if not days:
        return {}
    fresh = table.join(F.broadcast(runs), PART).withColumn(PART, F.col("day")).drop("day")
    moved = runs.select(F.col(PART).alias(RUN))
    earlier = table.where(F.col(PART).isin(days)).join(F.broadcast(moved), RUN, "left_anti")
    rows = fresh.unionByName(earlier)
    folders = _part_folders(spark, name)
    sizes = dict.fromkeys(days, 0)
    for r in runs.collect():
        sizes[r.day] += fs.total_bytes(spark, [folders[r[PART]]])
    for day in days:
        sizes[day] += fs.total_bytes(spark, [folders[day]]) if day in folders else 0
    bins = pack(sizes, target_bytes, WRITERS)
    place = spark.createDataFrame([(d, b, n) for d, (b, n) in bins.items()],
                                  f"{PART} string, first int, bins int")
    task = F.col("first") + F.pmod(F.xxhash64(RUN, stamp), F.col("bins")).cast("int")
    spread = rows.join(F.broadcast(place), PART) \
        .repartitionById(max(b + n for b, n in bins.values()), task).drop("first", "bins")
    _put(spread, name)
    _drop_parts(spark, name, [r[0] for r in moved.collect()])
    done = spark.table(name).where(F.col(PART).isin(days)).groupBy(PART).count()
    return {r[0]: r[1] for r in done.collect()}


def _part_folders(spark: SparkSession, name: str) -> dict[str, str]:
    """The folder of each partition of a table of runs, by its value."""
    root = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()[1]
    return {unquote(f.partition("=")[2]): f"{root}/{f}" for f in fs.subdirectories(spark, root) if "=" in f}


def append_table(df: DataFrame, name: str, fmt: str = "parquet") -> int:
    """Append ``df`` to ``name``, creating the table if it does not exist."""
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").format(fmt) \
        .saveAsTable(name)
    return int(obs.get["rows"])


def list_namespaces(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """The tables of a namespace by name; the versions behind refreshed tables are not listed."""
    return spark.sql(f"SHOW TABLES IN {namespace}").where(~F.col("tableName").rlike(VERSION_NAME))


def write_partitioned(df: DataFrame, path: str, by: Sequence[str],
                      spread_by: Sequence[str] | None = None, fmt: str = "parquet",
                      partitions: int | None = None) -> None:
    """Write ``df`` partitioned into folders by ``by``.

    Rows are first range-partitioned on ``by`` plus ``spread_by``: each task then
    writes a contiguous slice (few files per task), and a day holding a large share
    of the rows is split over several tasks by the ``spread_by`` columns. Without
    ``partitions`` AQE sizes the ranges from the data.
    """
    keys = list(by) + list(spread_by or [])
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *keys)
    ranged.write.mode("overwrite").format(fmt).partitionBy(*by).save(path)
