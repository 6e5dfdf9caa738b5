"""Column expressions shared by the layer builders.

All of them are built-in Catalyst expressions, so they stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, TimestampNTZType, TimestampType

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnOrName) -> Column:
    """Trim spaces at both ends; an empty result becomes NULL."""
    trimmed = F.trim(_col(c))
    return F.when(trimmed == F.lit(""), F.lit(None)).otherwise(trimmed)


def to_timestamp(c: ColumnOrName, zone_free: bool = True) -> Column:
    """Text (or any timestamp) to timestamp; unparsable input gives NULL.

    ``zone_free`` (default) yields TIMESTAMP_NTZ: source text carries no zone, and
    wall-clock values then do not move with the session time zone.
    """
    return _col(c).try_cast(TimestampNTZType() if zone_free else TimestampType())


def to_double(c: ColumnOrName) -> Column:
    """Text or number to double; unparsable input gives NULL."""
    return _col(c).try_cast(DoubleType())


def to_int(c: ColumnOrName) -> Column:
    """Text or number to int; ``'5.0'`` and ``'5.7'`` give 5 (fraction dropped). Text other than
    digits with an optional sign and fraction (``'5d'``, ``'1e3'``) and out-of-range input give
    NULL."""
    c = _col(c)
    plain = c.cast("string").rlike(r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)\s*$")
    return F.when((F.typeof(c) != "string") | plain, c.try_cast(DoubleType()).try_cast(IntegerType()))


def day_diff(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Calendar days from ``start`` to ``end`` (time of day ignored)."""
    return F.datediff(_col(end), _col(start))


def date_key(c: ColumnOrName) -> Column:
    """Integer yyyymmdd key of a date or timestamp (NULL stays NULL).

    Arithmetic on the calendar fields gives the same number as formatting the
    date as text and casting it back, without building a string per row.
    """
    c = _col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast(IntegerType())


def calendar_parts(c: ColumnOrName) -> dict[str, Column]:
    """year, quarter, month, day, day_of_week (1 = Sunday .. 7 = Saturday), is_weekend."""
    c = _col(c)
    dow = F.dayofweek(c)
    return {
        "year": F.year(c),
        "quarter": F.quarter(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "day_of_week": dow,
        "is_weekend": dow.isin(1, 7),
    }


def round2(c: ColumnOrName) -> Column:
    return F.round(_col(c), 2)


def pct(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``numerator / denominator * 100`` rounded to 2 places; NULL for a zero or NULL
    denominator instead of an ANSI division error."""
    return F.round(F.try_divide(_col(numerator), _col(denominator)) * F.lit(100), 2)


# --- exact sums of doubles ---------------------------------------------------------------
#
# A double is cut into LIMBS whole numbers of LIMB_BITS bits, limb k in units of
# 2**(LOW + k * LIMB_BITS). Limbs are summed as longs, so the total is exact and does not depend
# on the order or the partitions of the rows. 2**39 rows a group (5 * 10**11) fit a long; more
# raise an overflow error under ANSI, never a wrong total.
LIMB_BITS, LIMBS, LOW = 24, 7, -72
LIMB = float(2 ** LIMB_BITS)
# values of this size and more, NaN and infinities are outside
LIMIT = float(2 ** (LOW + LIMBS * LIMB_BITS))


@dataclass(frozen=True)
class MoneyParts:
    """The partial sums that a total of doubles is made of: the limbs, and the plain sum of what
    lies outside them (values of 2**96 and more, NaN, infinities, and the bits of a value below
    2**-72, which only values under 2**-19 can have); NULL if nothing does."""

    limbs: tuple[Column, ...]
    outside: Column

    def named(self, prefix: str) -> list[Column]:
        return [*[c.alias(f"{prefix}_limb{k}") for k, c in enumerate(self.limbs)],
                self.outside.alias(f"{prefix}_outside")]

    def total(self) -> Column:
        """The total, rounded once to a double; NULL without values."""
        inside = _rounded_once(self.limbs)
        return F.when(self.outside.isNull(), inside).otherwise(
            F.coalesce(inside, F.lit(0.0)) + self.outside)

    def rounded(self) -> Column:
        return F.round(self.total(), 2)


def money_parts(c: ColumnOrName) -> MoneyParts:
    value = _col(c).cast(DoubleType())
    # the remainder of a division of doubles is exact; the cast drops the bits below the limb
    inner = F.when(F.abs(value) < F.lit(LIMIT), value)
    limbs = [F.sum(((inner * F.lit(2.0 ** -(LOW + k * LIMB_BITS))) % F.lit(LIMB)).cast("bigint"))
             for k in range(LIMBS)]
    below = value % F.lit(2.0 ** LOW)
    outer = F.when(F.abs(value) < F.lit(LIMIT), F.when(below != F.lit(0.0), below)).otherwise(value)
    return MoneyParts(tuple(limbs), F.sum(outer))


def merged_parts(prefix: str) -> MoneyParts:
    """The parts of larger groups from those stored under ``prefix`` by ``MoneyParts.named``."""
    return MoneyParts(tuple(F.sum(f"{prefix}_limb{k}") for k in range(LIMBS)),
                      F.sum(f"{prefix}_outside"))


def _rounded_once(limbs: tuple[Column, ...]) -> Column:
    """The double nearest to the sum of the limbs in their units; NULL if they are."""
    low, high = limbs[:4], limbs[4:]
    # four low limbs that make two doubles without rounding: their sum rounds once
    pairs = [low[i + 1] * F.lit(2 ** LIMB_BITS) + low[i] for i in (0, 2)]
    fits = [F.abs(low[i]) < F.lit(2 ** (52 if i % 2 == 0 else 52 - LIMB_BITS)) for i in range(4)]
    simple = reduce(lambda a, b: a & b, [*fits, *[c == 0 for c in high]])
    short = pairs[1].cast("double") * F.lit(2.0 ** (LOW + 2 * LIMB_BITS)) + \
        pairs[0].cast("double") * F.lit(2.0 ** LOW)
    return F.when(limbs[0].isNotNull(), F.when(simple, short).otherwise(_rounded_digits(limbs)))


def _rounded_digits(limbs: tuple[Column, ...]) -> Column:
    """The same for sums of any size: carries make digits between -2**23 and 2**23, the first four
    from the first that is not 0 make two doubles, and the sign of those after them decides ties."""
    base, half = F.lit(2 ** LIMB_BITS), F.lit(2 ** (LIMB_BITS - 1))
    none = F.lit(0).cast("bigint")
    empty = F.array().cast("array<bigint>")

    def carried(state: Column, limb: Column) -> Column:
        # digits so far, the carry last
        number = F.element_at(state, -1) + limb
        carry = F.shiftright(number + half, LIMB_BITS)
        return F.concat(F.slice(state, F.lit(1), F.size(state) - 1),
                        F.array(number - carry * base, carry))

    # two limbs more take the carry of the highest; zeros below let four digits always follow
    digits = F.aggregate(F.array(*limbs, none, none), F.concat(empty, F.array(none)), carried)
    digits = F.reverse(F.concat(F.array(none, none, none), digits))
    count = 3 + LIMBS + 2 + 1
    start = F.struct(none.alias("high"), none.alias("low"), none.alias("after"),
                     F.lit(0).alias("taken"), F.lit(count).alias("left"))

    def taken(s: Column, d: Column) -> Column:
        n, begun = s["taken"], (s["taken"] > 0) | (d != 0)
        return F.struct(
            F.when(begun & (n < 2), s["high"] * base + d).otherwise(s["high"]).alias("high"),
            F.when((n >= 2) & (n < 4), s["low"] * base + d).otherwise(s["low"]).alias("low"),
            F.when((n >= 4) & (s["after"] == 0), F.signum(d).cast("bigint")).otherwise(s["after"]).alias("after"),
            F.when(begun & (n < 4), n + 1).otherwise(n).alias("taken"),
            F.when(n < 4, s["left"] - 1).otherwise(s["left"]).alias("left"))

    units = F.array(*[F.lit(2.0 ** (LOW + (k - 3) * LIMB_BITS - 1)) for k in range(count)])

    def finished(s: Column) -> Column:
        high = s["high"].cast("double") * F.lit(2.0 ** (2 * LIMB_BITS + 1))
        low = (s["low"] * 2 + s["after"]).cast("double")
        return (high + low) * F.get(units, s["left"])

    return F.aggregate(digits, start, taken, finished)


def money_sum(c: ColumnOrName) -> Column:
    """Sum of a double money column: the exact total, rounded once to a double, whatever the order
    of the rows, of all values below 2**96 (7.9e28) down to their bits at 2**-72.

    What lies outside (larger values, smaller bits, NaN, infinities) is summed as plain doubles
    and added, so no value is dropped; only that part can depend on the order of rows."""
    return money_parts(c).total()


def money_total(c: ColumnOrName) -> Column:
    """``money_sum`` rounded to 2 places (the mart form)."""
    return money_parts(c).rounded()
