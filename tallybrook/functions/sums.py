"""Sums of floating-point numbers that lose nothing and do not depend on the order of the rows.

A double is cut into bins of some bits at fixed exponents. What it has in a bin is a
whole number, and whole numbers add up to the same in any order. So each bin is
summed as a LONG, in plain generated code, and the bins are put together once at the
end. How many bins there are follows from the largest and the smallest magnitude of the
column and from the number of rows, for which a LONG has to leave room: two or three for
amounts of money, over a hundred for the whole range of a double and a trillion rows. NaN
and infinity have a sum of their own, as IEEE 754 has it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType
from pyspark.sql.window import WindowSpec

#: Least and most bits of a bin, and bits of a LONG that a sum leaves free.
_NARROW, _BROAD, _FREE = 16, 44, 6
#: Bits below the leading one of a double, and the exponent of the least one.
_MANTISSA, _LEAST = 52, -1074
#: From this many bits on, a number times the finest bin's scale may not be a double.
_WIDE = 900


def is_floating(df: DataFrame, value: Column | str) -> bool:
    kind = df.select(value).schema[0].dataType
    return isinstance(kind, (DoubleType, FloatType))


@dataclass(frozen=True)
class Span:
    """All numbers are multiples of 2 to the ``low`` and less than 2 to the ``high``.

    ``rows`` is about how many there are, within a factor of 30; ``special`` says that
    some may be NaN or infinite. Numbers beyond these are an error in ANSI mode.
    """

    low: int = 0
    high: int = 0
    rows: int = 1 << 40
    special: bool = True
    #: No number other than 0 is less than 2 to this.
    least: int = _LEAST

    @classmethod
    def of(cls, smallest: float | None, largest: float | None, whole: bool, rows: int, special: bool) -> Span:
        """The span of numbers whose magnitudes, 0 apart, lie between the two."""
        if not smallest or not largest:
            return cls(0, 0, rows, special, 0)
        least = math.frexp(smallest)[1] - 1
        low = max(0 if whole else _LEAST, least - _MANTISSA)
        return cls(low, math.frexp(largest)[1], rows, special, least)

    def times(self, other: Span) -> Span:
        """The span of products, from those of the factors."""
        low, high = self.low + other.low, self.high + other.high
        # A product that is rounded has its own mantissa, from the smallest one on.
        least = self.least + other.least
        return Span(max(_LEAST, low, least - _MANTISSA), high, max(self.rows, other.rows), self.special or other.special or high > 1023, least)

    @property
    def width(self) -> int:
        return max(_NARROW, min(_BROAD, 63 - _FREE - self.rows.bit_length()))

    def units(self) -> list[int]:
        """Exponents of the bins; a number is less than half of what would be the next one."""
        return list(range(self.low, max(self.low + 1, self.high + 1), self.width))


def spans(df: DataFrame, values: Mapping[str, Column | str]) -> dict[str, Span | None]:
    """The span of each value, by one job that reads these columns only; None where it isn't a double.

    ``df`` may be the scan that the values come from rather than what is made of it.
    """
    floating = {name: value for name, value in values.items() if is_floating(df, value)}
    found: dict[str, Span | None] = dict.fromkeys(values)
    if floating:
        columns = {name: F.col(value) if isinstance(value, str) else value for name, value in floating.items()}
        size = {name: F.abs(column.cast("double")) for name, column in columns.items()}
        limits = []
        for name, column in size.items():
            finite = F.when((column > 0) & (column < float("inf")), column)
            limits += [
                F.min(finite), F.max(finite), F.coalesce(F.bool_and(F.rint(finite) == finite), F.lit(True)),
                F.count(column), F.coalesce(F.bool_or(~(column < float("inf"))), F.lit(False)),
            ]
        row = tuple(df.agg(*limits).first())
        found |= {name: Span.of(*row[5 * place : 5 * place + 5]) for place, name in enumerate(size)}
    return found


def _scaled(value: Column, exponent: int) -> Column:
    """``value`` by 2 to the ``-exponent``, a power that may be no double itself."""
    half = -exponent // 2
    if abs(exponent) < 1000:
        return value * math.ldexp(1.0, -exponent)
    return value * math.ldexp(1.0, half) * math.ldexp(1.0, -exponent - half)


def _bin(value: Column, unit: int, span: Span) -> Column:
    """What a finite ``value`` has in the bin of ``unit``, a whole number of at most half the next unit."""
    fine, coarse = F.rint(_scaled(value, unit)), F.rint(_scaled(value, unit + span.width))
    part = fine if unit == span.units()[-1] else fine - coarse * float(1 << span.width)
    if span.high - span.low > _WIDE:
        # Larger numbers are multiples of the next bin's unit.
        edge = unit + span.width + _MANTISSA + 1
        part = F.when(F.abs(value) < math.ldexp(1.0, edge), part).otherwise(0.0) if edge < 1024 else part
    return part.cast("long")


def _put_together(sums: Mapping[int, Column]) -> Column:
    """The double of sums per bin, from the finest bin up.

    Each bin hands what is beyond its width to the next one, so that those left over are
    less than half of the next bin's unit and never take away what it has.
    """
    units = sorted(sums)
    width = units[1] - units[0] if len(units) > 1 else _BROAD
    half, whole = 1 << (width - 1), 1 << width
    bins = F.array(*[F.struct(total.alias("sum"), F.lit(math.ldexp(1.0, unit)).alias("unit")) for unit, total in sums.items()])

    def up(known: Column, item: Column) -> Column:
        here = item["sum"] + known["carry"]
        rest = F.pmod(here + half, F.lit(whole)) - half
        return F.struct(
            F.shiftright(here - rest, width).alias("carry"), (known["total"] + rest * item["unit"]).alias("total")
        )

    def done(known: Column) -> Column:
        top = units[-1] + width
        weight = math.ldexp(1.0, top) if top < 1024 else math.inf
        return F.when(known["carry"] == 0, known["total"]).otherwise(known["total"] + known["carry"] * weight)

    return F.aggregate(bins, F.struct(F.lit(0).cast("long").alias("carry"), F.lit(0.0).alias("total")), up, done)


class Addend:
    """A column of doubles to be added up, as its parts; others are added up as they are."""

    def __init__(self, parts: Mapping[str, Column]) -> None:
        self.parts = dict(parts)

    @classmethod
    def of(cls, value: Column | str, span: Span | None) -> Addend:
        column = F.col(value) if isinstance(value, str) else value
        if span is None:
            return cls({"": column})
        column = column.cast("double")
        bins = {str(unit): _bin(column, unit, span) for unit in span.units()}
        if not span.special:
            return cls(bins)
        finite = F.abs(column) < float("inf")
        bins = {unit: F.when(finite, part) for unit, part in bins.items()}
        return cls({**bins, "special": F.when(column.isNotNull() & ~finite, column)})

    @classmethod
    def again(cls, df: DataFrame, name: str) -> Addend:
        """What :meth:`partial` gave, to be added up once more."""
        kind = df.schema[name].dataType
        if not isinstance(kind, StructType):
            return cls({"": F.col(name)})
        return cls({field: F.col(name)[field] for field in kind.fieldNames()})

    def partial(self) -> Column:
        """The sum as far as it goes, as one column."""
        sums = {name: F.sum(part) for name, part in self.parts.items()}
        return sums[""] if "" in sums else F.struct(*[total.alias(name) for name, total in sums.items()])

    def total(self) -> Column:
        """The sum of a group. It is NULL if there is nothing to add up."""
        return self.joined({name: F.sum(part) for name, part in self.parts.items()})

    def over(self, window: WindowSpec, names: Mapping[str, str]) -> Column:
        """The running sum, where the column ``names[part]`` has each part."""
        return self.joined({name: F.sum(names[name]).over(window) for name in self.parts})

    @staticmethod
    def value(df: DataFrame, name: str) -> Column:
        """The number that one column of :meth:`partial` stands for."""
        return Addend.joined(Addend.again(df, name).parts)

    @staticmethod
    def joined(sums: Mapping[str, Column]) -> Column:
        if "" in sums:
            return sums[""]
        bins = {int(name): total for name, total in sums.items() if name != "special"}
        total = F.when(bins[min(bins)].isNotNull(), _put_together(bins))
        return F.coalesce(sums["special"], total) if "special" in sums else total


def exact_sum(df: DataFrame, value: Column | str, digits: int = 2, span: Span | None = None) -> Column:
    """The sum, rounded once at the end; a double where the values are.

    Without ``span`` the column is read for it first.
    """
    span = span or spans(df, {"value": value})["value"]
    return F.round(Addend.of(value, span).total(), digits)


def exact_mean(value: Column | str, span: Span | None) -> Column:
    """The sum over the number of values that took part."""
    column = F.col(value) if isinstance(value, str) else value
    return F.avg(column) if span is None else F.try_divide(Addend.of(column, span).total(), F.count(column))
