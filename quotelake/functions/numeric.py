"""Column expressions for numbers: coercion, rounding and ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.functions.names import column

# The spellings of a number that count as numeric text.
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def to_number(value: Column, dtype: T.DataType) -> Column:
    """Number or NULL. Text must look like a number; NaN counts as missing, infinities stay."""
    if isinstance(dtype, T.StringType):
        return F.when(value.rlike(NUMBER_TEXT), value.try_cast("double"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return nan_to_null(value.cast("double"))
    if isinstance(dtype, T.NumericType):
        return value.cast("double")
    return value.try_cast("double")


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Scale, round to the even neighbour, scale back (numpy's rule). Adding 0.0 turns -0.0 into 0.0."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def growth(value: Column, previous: Column) -> Column:
    """Relative change; NULL without a previous value or when it is zero."""
    return F.try_divide(value, previous) - F.lit(1.0)


def fractional_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def blank_non_finite(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NaN and +-infinity become NULL in every floating column (or the named ones)."""
    names = fractional_fields(df) if columns is None else columns
    limit = F.lit(float("inf"))
    return df.withColumns({c: F.when(~F.isnan(column(c)) & (F.abs(column(c)) < limit), column(c)) for c in names})


def round_fractions(df: DataFrame, digits: int = 2, columns: list[str] | None = None) -> DataFrame:
    names = fractional_fields(df) if columns is None else columns
    return df.withColumns({c: round_half_even(column(c), digits) for c in names})
