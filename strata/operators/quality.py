"""Declarative data-quality checks, evaluated in as few passes as possible.

A suite for one table is a list of checks. ``run_checks`` turns it into a small
DataFrame with one row per check (table_name, layer, check_name, passed, value,
threshold), computed lazily:

* all single-pass checks (row count, NULLs, ranges, signs, time windows) and the
  first uniqueness check share ONE scan: rows are grouped by the unique key with
  per-group counters (combined map-side), then the counters are summed;
* uniqueness of a wide key counts 64-bit prints first and compares the keys themselves
  only where a print was seen twice;
* the checks of a suite that relate tables (foreign keys, row counts) share ONE shuffle:
  ``run_suite`` reads each table once and gives every key of every check as a row
  (check, key), combined map-side, for a single aggregate.

``gate`` collects that small frame (bounded by the number of checks), prints the
report, stores it with a run timestamp in a results table, once a run, and raises
``DQError`` if any check failed - persisting first, as the reference does.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, StringType, StructField, StructType,
                               TimestampType)

from strata.config import CHECK_NAMES, DQ_RESULTS_TABLE

_log = logging.getLogger(__name__)

RESULT_SCHEMA = StructType([
    StructField("table_name", StringType(), False),
    StructField("layer", StringType(), False),
    StructField("check_name", StringType(), False),
    StructField("passed", BooleanType(), False),
    StructField("value", DoubleType(), False),
    StructField("threshold", DoubleType(), False),
])

PERSISTED_SCHEMA = StructType(RESULT_SCHEMA.fields + [
    StructField("run_timestamp", TimestampType(), False)])


class DQError(Exception):
    """Raised by ``gate`` when at least one check failed."""


@dataclass(frozen=True)
class RowCheck:
    """A check computed by one aggregate over the table's rows.

    ``bad`` is a boolean row condition counted over the table (``None`` counts every
    row). The check passes when ``count > threshold`` (``rule="gt"``) or when
    ``count == threshold`` (``rule="eq"``).
    """

    name: str
    bad: Column | None
    threshold: float = 0.0
    rule: str = "eq"


@dataclass(frozen=True)
class UniqueCheck:
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return CHECK_NAMES["unique"].format(columns="_".join(self.columns))


@dataclass(frozen=True)
class OrphanCheck:
    child_key: str
    parent: DataFrame
    parent_key: str

    @property
    def name(self) -> str:
        return CHECK_NAMES["no_orphans"].format(child_key=self.child_key,
                                                parent_key=self.parent_key)


@dataclass(frozen=True)
class CountMatchCheck:
    other: DataFrame
    name: str


Check = RowCheck | UniqueCheck | OrphanCheck | CountMatchCheck


# ---- expectations ------------------------------------------------------------------

def row_count_gt(n: int = 0) -> RowCheck:
    return RowCheck(CHECK_NAMES["row_count_gt"].format(n=n), None, float(n), "gt")


def not_null(column: str) -> RowCheck:
    return RowCheck(CHECK_NAMES["not_null"].format(column=column), F.col(column).isNull())


def unique(*columns: str) -> UniqueCheck:
    """Rows minus distinct key combinations must be 0; NULLs count as equal."""
    return UniqueCheck(tuple(columns))


def between(column: str, low, high) -> RowCheck:
    """Inclusive range; NULL passes."""
    c = F.col(column)
    return RowCheck(CHECK_NAMES["between"].format(column=column, low=low, high=high),
                    (c < F.lit(low)) | (c > F.lit(high)))


def positive(column: str) -> RowCheck:
    """``<= 0`` fails; NULL passes."""
    return RowCheck(CHECK_NAMES["positive"].format(column=column), F.col(column) <= F.lit(0))


def non_negative(column: str) -> RowCheck:
    """``< 0`` fails; NULL passes."""
    return RowCheck(f"{column}_non_negative", F.col(column) < F.lit(0))


def timestamp_in_range(column: str, low: str, high: str, name: str | None = None) -> RowCheck:
    """Outside ``[low, high]`` fails; bounds are timestamps, so a date-only upper
    bound means midnight at the start of that day. NULL passes."""
    c = F.col(column)
    lo = F.lit(low).cast("timestamp_ntz")
    hi = F.lit(high).cast("timestamp_ntz")
    return RowCheck(name or f"{column}_in_range", (c < lo) | (c > hi))


def no_orphans(child_key: str, parent: DataFrame, parent_key: str) -> OrphanCheck:
    return OrphanCheck(child_key, parent, parent_key)


def row_count_matches(other: DataFrame, name: str) -> CountMatchCheck:
    """value = this table's row count, threshold = ``other``'s; equal passes."""
    return CountMatchCheck(other, name)


# ---- evaluation --------------------------------------------------------------------

def _result_row(table: str, layer: str, name: str, value: Column, threshold: Column,
                rule: str) -> Column:
    value = value.cast(DoubleType())
    threshold = threshold.cast(DoubleType())
    passed = (value > threshold) if rule == "gt" else (value == threshold)
    return F.struct(F.lit(table).alias("table_name"), F.lit(layer).alias("layer"),
                    F.lit(name).alias("check_name"),
                    F.coalesce(passed, F.lit(False)).alias("passed"),
                    value.alias("value"), threshold.alias("threshold"))


def _explode_results(one_row: DataFrame, structs: list[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _fused(df: DataFrame, table: str, layer: str, row_checks: list[RowCheck],
           uniq: UniqueCheck | None) -> DataFrame:
    def counter(chk: RowCheck) -> Column:
        return F.count(F.lit(1)) if chk.bad is None else F.count_if(chk.bad)

    if uniq is None:
        totals = df.agg(*[counter(c).alias(f"__c{i}") for i, c in enumerate(row_checks)])
    else:
        groups = df.groupBy(*uniq.columns).agg(
            F.count(F.lit(1)).alias("__rows"),
            *[counter(c).alias(f"__c{i}") for i, c in enumerate(row_checks)])
        totals = groups.agg(F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)).alias("__dup"),
                            *[F.coalesce(F.sum(f"__c{i}"), F.lit(0)).alias(f"__c{i}")
                              for i in range(len(row_checks))])
    structs = [_result_row(table, layer, c.name, F.col(f"__c{i}"), F.lit(c.threshold), c.rule)
               for i, c in enumerate(row_checks)]
    if uniq is not None:
        structs.append(_result_row(table, layer, uniq.name, F.col("__dup"), F.lit(0.0), "eq"))
    return _explode_results(totals, structs)


# fixed-width types: a key of up to two such columns is not worth a print
_NARROW = ("tinyint", "smallint", "int", "bigint", "date", "boolean", "float", "double")


def _is_wide(df: DataFrame, columns: Sequence[str]) -> bool:
    types = dict(df.dtypes)
    return len(columns) > 2 or any(types[c] not in _NARROW for c in columns)


def _unique_by_prints(df: DataFrame, table: str, layer: str, uniq: UniqueCheck) -> DataFrame:
    """Rows of a key beyond its first, from the keys whose 64-bit print occurs twice or more.

    Only prints are shuffled (8 bytes, without their counts: most occur once). Without a print
    that repeats the second reading of the table falls away at run time, as it is joined with
    nothing; different keys of one print are told apart by their columns."""
    columns = list(uniq.columns)
    marked = df.select(*columns).withColumn("__print", F.xxhash64(*columns))
    twice = marked.select("__print").repartition("__print").groupBy("__print") \
        .agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__print")
    groups = marked.join(twice, "__print", "left_semi").groupBy(*columns) \
        .agg(F.count(F.lit(1)).alias("__n"))
    dup = groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("__dup"))
    return _explode_results(dup, [_result_row(table, layer, uniq.name, F.col("__dup"), F.lit(0.0), "eq")])


def run_checks(df: DataFrame, checks: Sequence[Check], table: str, layer: str) -> DataFrame:
    """One result row per check of a table (see module doc)."""
    related = [c for c in checks if isinstance(c, (OrphanCheck, CountMatchCheck))]
    row_checks = [c for c in checks if isinstance(c, RowCheck)]
    uniques = [c for c in checks if isinstance(c, UniqueCheck)]
    wide = [u for u in uniques if _is_wide(df, u.columns)]
    narrow = [u for u in uniques if u not in wide]
    parts: list[DataFrame] = []
    if row_checks or narrow:
        parts.append(_fused(df, table, layer, row_checks, narrow[0] if narrow else None))
    parts += [_fused(df, table, layer, [], u) for u in narrow[1:]]
    parts += [_unique_by_prints(df, table, layer, u) for u in wide]
    if related:
        parts.append(run_suite([(df, related, table, layer)]))
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return combine(parts)


Part = tuple[DataFrame, Sequence[Check], str, str]


@dataclass(frozen=True)
class _Measure:
    """A check as rows (check number, key columns, left, right): its value and threshold follow from
    the sums of left and right over the keys."""

    table: str
    layer: str
    check: Check

    @property
    def sums(self) -> tuple[str, str, str]:
        """(value, threshold, rule) over the sums of the check's rows."""
        if isinstance(self.check, RowCheck):
            return "left", repr(float(self.check.threshold)), self.check.rule
        if isinstance(self.check, UniqueCheck):
            return "left - keys", "0.0", "eq"
        if isinstance(self.check, OrphanCheck):
            return "orphans", "0.0", "eq"
        return "left", "right", "eq"


def _text_key(columns: Sequence[Column], types: Sequence[str]) -> Column:
    """One text for a key, different for different keys; NULL if its only column is."""
    texts = [F.hex(c) if t == "binary" else c.cast("string") for c, t in zip(columns, types, strict=True)]
    if len(texts) == 1:
        return texts[0]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                      for t in texts])


# key columns of a suite's rows: up to two integers as they are, any other key as one text
_KEY = ("first", "second", "text")
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def _key(columns: Sequence[Column], types: Sequence[str]) -> list[Column]:
    """A key in the columns ``_KEY``, different for different keys; all NULL for a key whose columns are."""
    number, text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    if len(columns) <= 2 and all(t in _INTEGERS for t in types):
        numbers = [c.cast("bigint") for c in columns] + [number] * (2 - len(columns))
        return [*numbers, text]
    return [number, number, _text_key(columns, types)]


def _common_type(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> str:
    """The type in which the two keys are compared."""
    both = child.select(F.col(child_key).alias("k")).union(parent.select(F.col(parent_key).alias("k")))
    return both.dtypes[0][1]


def run_suite(parts: Sequence[Part]) -> DataFrame:
    """One result row per check of several tables (df, checks, table, layer), from one aggregate.

    Every table is read once, whatever the number of checks it takes part in (as a parent or a
    compared table too; a table is known by its DataFrame). For each of its rows it gives the keys
    that the checks compare: child and parent keys of a foreign key, the key that must be unique,
    no key for what is only counted, and nothing for a row that a row check has no fault with.
    Equal (check, key) rows are combined before the one shuffle, so a key that a third of all rows
    hold is one row a task. Keys of integers stay integers, which are cheaper to hash and to send
    than their texts."""
    measures: list[_Measure] = []
    reads: dict[int, tuple[DataFrame, list[Column]]] = {}

    def give(df: DataFrame, number: int, key: list[Column], left: int, right: int,
             where: Column | None = None) -> None:
        row = F.struct(F.lit(number).alias("check"),
                       *[k.alias(n) for k, n in zip(key, _KEY, strict=True)], F.lit(left).cast("bigint").alias("left"),
                       F.lit(right).cast("bigint").alias("right"))
        reads.setdefault(id(df), (df, []))[1].append(row if where is None else F.when(where, row))

    none = _key([], [])
    for df, checks, table, layer in parts:
        for check in checks:
            number = len(measures)
            measures.append(_Measure(table, layer, check))
            if isinstance(check, RowCheck):
                give(df, number, none, 1, 0, check.bad)
            elif isinstance(check, UniqueCheck):
                types = dict(df.dtypes)
                give(df, number, _key([F.col(c) for c in check.columns],
                                      [types[c] for c in check.columns]), 1, 0)
            elif isinstance(check, OrphanCheck):
                kind = _common_type(df, check.child_key, check.parent, check.parent_key)
                give(df, number, _key([F.col(check.child_key).cast(kind)], [kind]), 1, 0)
                give(check.parent, number, _key([F.col(check.parent_key).cast(kind)], [kind]), 0, 1)
            else:
                give(df, number, none, 1, 0)
                give(check.other, number, none, 0, 1)
    rows = None
    for df, given in reads.values():
        # outer: a plain explode lets Spark filter by the array below the projection that builds it
        one = df.select(F.explode_outer(F.array(*given)).alias("r")).select("r.*").where("check IS NOT NULL")
        rows = one if rows is None else rows.union(one)
    by_key = rows.groupBy("check", *_KEY).agg(F.sum("left").alias("left"), F.sum("right").alias("right"))
    lost = F.when((F.col("first").isNull() & F.col("text").isNull()) | (F.col("right") == 0),
                  F.col("left")).otherwise(F.lit(0))
    sums = by_key.groupBy("check").agg(
        F.sum("left").alias("left"), F.sum("right").alias("right"), F.count(F.lit(1)).alias("keys"),
        F.sum(lost).alias("orphans"))
    # a column for each check's sum (a row a check becomes one row); 0 for a check without any row
    names = ("left", "right", "keys", "orphans")
    sums = sums.agg(*[F.coalesce(F.max(F.when(F.col("check") == i, F.col(n))), F.lit(0)).alias(f"{n}{i}")
                      for i in range(len(measures)) for n in names])
    results = []
    for i, m in enumerate(measures):
        parts_of = {n: F.col(f"{n}{i}") for n in names}
        value, threshold, rule = m.sums
        value = parts_of["left"] - parts_of["keys"] if value == "left - keys" else parts_of[value]
        threshold = parts_of[threshold] if threshold in parts_of else F.lit(float(threshold))
        results.append(_result_row(m.table, m.layer, m.check.name, value, threshold, rule))
    return _explode_results(sums, results)


def combine(results: Iterable[DataFrame]) -> DataFrame:
    """Union of several ``run_checks`` results."""
    results = list(results)
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def _report(layer: str, rows: list) -> None:
    """Failed checks first, then per table; one aligned line per check."""
    failed = sum(not r["passed"] for r in rows)
    print(f"quality gate {layer}: {len(rows)} checks, {failed} failed")
    width = max((len(f"{r['table_name']} {r['check_name']}") for r in rows), default=0)
    for r in sorted(rows, key=lambda r: (r["passed"], r["table_name"])):
        label = f"{r['table_name']} {r['check_name']}".ljust(width)
        status = "ok  " if r["passed"] else "FAIL"
        print(f"  {status} {label}  {r['value']:g} vs {r['threshold']:g}")


def gate(spark: SparkSession, layer: str, results: DataFrame,
         persist_to: str | None = f"meta.{DQ_RESULTS_TABLE}", run_id: str | None = None) -> list[dict]:
    """Evaluate, report, persist (table created if missing), then raise ``DQError`` listing the
    failed checks. A persist error is only warned about.

    The results are stored once for each run and layer: a gate that is tried again under the same
    ``run_id`` replaces what it stored before. Without one, every call is a run of its own."""
    from strata.sources.tables import append_run
    rows = [r.asDict() for r in results.collect()]
    _report(layer, rows)
    if persist_to:
        stamp = dt.datetime.now(dt.timezone.utc)
        try:
            frame = spark.createDataFrame([{**r, "run_timestamp": stamp} for r in rows],
                                          PERSISTED_SCHEMA)
            # a few rows: one file per gate run, not one per core
            append_run(frame.coalesce(1), persist_to, f"{run_id or uuid.uuid4().hex}-{layer}")
        except Exception as exc:  # noqa: BLE001 - the gate decision must not depend on it
            _log.warning("quality results of %s not stored in %s: %s", layer, persist_to, exc)
    failed = [f"{r['table_name']}.{r['check_name']}" for r in rows if not r["passed"]]
    if failed:
        raise DQError(f"quality gate {layer} stopped the run; failed: {', '.join(failed)}")
    return rows
