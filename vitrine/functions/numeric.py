"""Numeric column expressions with pandas / numpy value semantics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

_NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType,
            T.ByteType, T.DecimalType, T.BooleanType)


def half_even(value: Column, digits: int) -> Column:
    """Round half to even on the scaled double, as numpy does."""
    scale = float(10 ** digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def parse_number(text: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL.

    The pattern guards ``try_cast``, which on its own accepts ``'12.5d'``.
    """
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))


def numeric_column(df: DataFrame, name: str) -> Column:
    """Column ``name`` as double with NULL for malformed values and NaN."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, _NUMERIC):
        value = column.cast("double")
        return F.when(~F.isnan(value), value)
    return parse_number(column.cast("string"))


def clip(value: Column, low=None, high=None) -> Column:
    """Clamp into [low, high]; NULL stays NULL (``greatest`` alone would drop it)."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        bounded = F.least(bounded, high if isinstance(high, Column) else F.lit(high))
    return F.when(value.isNotNull(), bounded)


def truncate_int(value: Column) -> Column:
    """Missing and out of range to 0, then truncate towards zero."""
    return F.coalesce(value.try_cast("int"), F.lit(0))


def steady_mean(value: Column) -> Column:
    """Mean that is the same for any partitioning.

    A floating-point sum depends on the order of its terms, which flips means that sit on a rounding edge. Values are
    summed as decimals of 12 places; where one is too large or too small for that, the plain average is taken.
    """
    fixed = F.when(F.abs(value) < 1e15, value).try_cast("decimal(28,12)")
    exact = F.count(value) == F.count(F.when((F.abs(value) < 1e15) & ((value == 0) | (F.abs(value) >= 1e-6)), 1))
    return F.when(exact, F.try_divide(F.try_sum(fixed).cast("double"), F.count(value))).otherwise(F.avg(value.cast("double")))
