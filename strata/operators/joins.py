"""Join operators: lookups with defaults, aggregates joined back, orphan keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from strata.operators.dedupe import dedupe
from strata.session import cut_lineage


# Session settings that override the defaults below (e.g. set per cluster)
HOT_ROWS, LOOKUP_ROWS = "strata.skew.hotRows", "strata.lookup.broadcastRows"
_DEFAULTS = {HOT_ROWS: 1_000_000, LOOKUP_ROWS: 100_000}
# hot keys that are broadcast at most (counted before); more of them are joined by a shuffle
BROADCAST_KEYS = 1_000_000


def _setting(df: DataFrame, key: str, given: int | None) -> int:
    """``given`` if set, else the session setting ``key``, else its default."""
    if given is not None:
        return given
    value = df.sparkSession.conf.get(key, None)
    return int(value) if value else _DEFAULTS[key]


def _hot_keys(counts: DataFrame, keys: list[str], count: str, hot_rows: int) -> DataFrame | None:
    """All keys (a NULL key included) with more than ``hot_rows`` rows and their salt count
    ceil(rows / hot_rows); None if there are none. ``counts`` is a written table, one row per key.
    There are at most rows / hot_rows hot keys; they are counted before they are broadcast."""
    hot = counts.where(F.col(count) > F.lit(hot_rows)).select(
        *keys, F.ceil(F.col(count) / F.lit(hot_rows)).cast("int").alias("__parts"))
    found = hot.count()
    if not found:
        return None
    return F.broadcast(hot) if found <= BROADCAST_KEYS else hot


def _salted_join(detail: DataFrame, keyed: DataFrame, keys: list[str], hot: DataFrame | None,
                 how: str) -> DataFrame:
    """A plain join without hot keys; else ``detail`` joined to ``keyed`` (at most one row per key) with hot keys split:
    each detail row of a hot key takes one of its salts by a hash of the row (the
    same when a task is retried), and the keyed row is repeated once per salt.

    Hot keys are matched null-safely, so many detail rows with a NULL key (kept by
    a left join, matched by nothing) are spread the same way instead of all going
    to the one task that NULL hashes to."""
    if hot is None:
        return detail.join(keyed, keys, how)
    hashable = [c for c, t in detail.dtypes if not t.startswith(("map<", "variant"))]
    marks = hot.select(*[F.col(k).alias(f"__hot{i}") for i, k in enumerate(keys)], "__parts")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__hot{i}"))
                                       for i, k in enumerate(keys)])
    salted = (detail.join(marks, same, "left")
              .withColumn("__salt", F.when(F.col("__parts").isNull(), F.lit(0))
                          .otherwise(F.pmod(F.xxhash64(*hashable), F.col("__parts")).cast("int")))
              .drop("__parts", *[f"__hot{i}" for i in range(len(keys))]))
    repeated = (keyed.join(hot, keys, "left")
                .withColumn("__salt", F.explode(F.sequence(
                    F.lit(0), F.coalesce(F.col("__parts"), F.lit(1)) - F.lit(1))))
                .drop("__parts"))
    return salted.join(repeated, keys + ["__salt"], how).drop("__salt")


def _salts(df: DataFrame, hot_rows: int | None) -> bool:
    """Whether hot keys are salted: if the rows of a hot key are given, here or by the session, or
    the session does not split skewed join partitions at run time (Spark's defaults do)."""
    conf = df.sparkSession.conf
    split = all(conf.get(f"spark.sql.adaptive.{k}", "true").lower() == "true"
                for k in ("enabled", "skewJoin.enabled"))
    return hot_rows is not None or bool(conf.get(HOT_ROWS, None)) or not split


def _split_join(detail: DataFrame, keyed: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``detail`` joined to ``keyed`` (at most one row per key) by two plain shuffles, of which AQE
    splits the partitions of hot keys once it has seen their sizes; no job runs before.

    AQE leaves a side alone that is already partitioned by the key, as the output of an aggregate
    or a de-duplication is. So both sides are joined on the keys put into one struct, which no
    partitioning is known for. Rows with a NULL key match nothing: they are left out of ``keyed``,
    and those of ``detail`` are a hot key like any other."""
    packed = F.struct(*[F.col(k) for k in keys]).alias("__key")
    rest = [c for c in keyed.columns if c not in keys]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    others = [c for c in detail.columns if c not in keys]
    return detail.select("*", packed).join(keyed.where(known).select(packed, *rest), "__key", how) \
        .select(*keys, *others, *rest)


# bytes per value of fixed-width types (others count 16)
_WIDTH = {"BooleanType": 1, "ByteType": 1, "ShortType": 2, "IntegerType": 4, "FloatType": 4,
          "DateType": 4, "LongType": 8, "DoubleType": 8, "TimestampType": 8,
          "TimestampNTZType": 8, "DecimalType": 16}


def _fits(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows taking at most ``max_bytes``
    (text and binary by their length, other values by their type's width; nested
    values by the length of their JSON form). Reads ``max_rows + 1`` rows at most."""
    if max_rows <= 0 or max_bytes <= 0:
        return False
    widths = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (StringType, BinaryType)):
            widths.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(t, (ArrayType, MapType, StructType)):
            widths.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
        else:
            widths.append(F.lit(_WIDTH.get(type(t).__name__, 16)))
    row_bytes = reduce(lambda a, b: a + b, widths, F.lit(0)).cast("long")
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)),
                                            F.coalesce(F.sum(row_bytes), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def _broadcast_bytes(spark) -> int:
    """The session's broadcast threshold in bytes (-1: broadcasting disabled)."""
    try:
        return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    except AttributeError:  # no JVM session object (e.g. a remote session): parse the text
        text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m").strip().lower()
        number = text.rstrip("kmgtb")
        return int(number) * _UNITS[text[len(number):]] if number != "-1" else -1


def join_keyed(detail: DataFrame, keyed: DataFrame, on: str | Sequence[str], how: str = "left",
               hot_rows: int | None = None, broadcast_rows: int = 0) -> DataFrame:
    """Join many ``detail`` rows to at most one ``keyed`` row per key (``left`` or
    ``inner``), with keys holding more than ``hot_rows`` detail rows split over
    several tasks.

    With ``broadcast_rows`` > 0, ``keyed`` is first measured (reading at most
    ``broadcast_rows + 1`` rows): if it has no more rows than that and its bytes are
    within the session's broadcast threshold, it is broadcast, the detail is not
    shuffled at all and hot keys do not matter. Use it for code tables, not for a
    side that grows with the data (the measurement is a job of its own).

    Otherwise AQE splits the partitions of hot keys (``_split_join``), where the
    session has it on and no ``hot_rows`` are given (here or by the session), and nothing
    runs before the query does. Otherwise hot keys are salted: detail rows are
    counted per key (combined map-side; the counts are written to the shared folder,
    so ``detail`` is read once for them and once for the join) and every key over
    ``hot_rows`` is salted.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if broadcast_rows > 0 and _fits(keyed, broadcast_rows, _broadcast_bytes(keyed.sparkSession)):
        return detail.join(F.broadcast(keyed), keys, how)
    if not _salts(detail, hot_rows):
        return _split_join(detail, keyed, keys, how)
    limit = _setting(detail, HOT_ROWS, hot_rows)
    counts = detail.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = _hot_keys(cut_lineage(counts.where(F.col("__n") > F.lit(limit))), keys, "__n", limit)
    return _salted_join(detail, keyed, keys, hot, how)


def lookup(df: DataFrame, table: DataFrame, on: str | Sequence[str],
           defaults: Mapping[str, object] | None = None, broadcast_rows: int | None = None,
           **skew_options) -> DataFrame:
    """Left lookup enrichment; a miss takes ``defaults[column]``.

    The lookup table is first reduced to one row per key (lowest other columns
    win), so a duplicated key in the lookup cannot multiply the detail rows. The
    same row would survive a join followed by a keyed de-duplication. A lookup of
    at most ``broadcast_rows`` rows (counted first) is broadcast; a larger one is
    joined with hot detail keys salted (``join_keyed``).
    """
    keys = [on] if isinstance(on, str) else list(on)
    out = join_keyed(df, dedupe(table, keys), keys, "left",
                     broadcast_rows=_setting(df, LOOKUP_ROWS, broadcast_rows), **skew_options)
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def attach_group_total(detail: DataFrame, source: DataFrame, key: str, total: Column,
                       name: str, hot_rows: int | None = None) -> DataFrame:
    """Attach to every ``detail`` row the aggregate ``total`` of its key over
    ``source`` (a left join: a NULL or unmatched key gets NULL).

    The totals are one row per key (combined map-side), but joining them back
    moves every detail row to its key's reducer. AQE splits the hot keys there, as in
    ``join_keyed``; otherwise they are salted, and their row counts
    come with the totals (``source`` rows), which are then written once to the shared
    folder, and both the hot keys and the join read them there.
    """
    if not _salts(detail, hot_rows):
        return _split_join(detail, source.groupBy(key).agg(total.alias(name)), [key], "left")
    totals = cut_lineage(source.groupBy(key).agg(total.alias(name),
                                                 F.count(F.lit(1)).alias("__n")))
    hot = _hot_keys(totals, [key], "__n", _setting(detail, HOT_ROWS, hot_rows))
    return _salted_join(detail, totals.drop("__n"), [key], hot, "left")


def add_group_total(df: DataFrame, key: str, total: Column, name: str,
                    **skew_options) -> DataFrame:
    """Attach a per-key aggregate to every row of ``df`` (aggregate joined back);
    a NULL key gets a NULL total, as a join gives. Hot keys are salted, see
    ``attach_group_total``."""
    return attach_group_total(df, df, key, total, name, **skew_options)


def count_orphans(child: DataFrame, child_key: str, parent: DataFrame,
                  parent_key: str) -> DataFrame:
    """One row, column ``orphans``: child rows whose key is not a parent key.

    A NULL child key counts as an orphan. Both sides are reduced to distinct keys
    (child keys with their row counts) before the anti join, so a hot key costs one
    row in the shuffle, not a third of the table.
    """
    child_keys = child.groupBy(F.col(child_key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    parent_keys = parent.select(F.col(parent_key).alias("__k")).distinct()
    missing = child_keys.join(parent_keys, on="__k", how="left_anti")
    return missing.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("orphans"))
