"""Column expressions that format values for reports and exports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column, pattern: str) -> Column:
    """printf for one number that keeps NULL (the plain function would print the word null)."""
    return F.when(value.isNotNull(), F.format_string(pattern, value))


def magnitude(value: Column) -> Column:
    """1234567890 -> 1.2B, 5600000 -> 6M, 7800 -> 8K, 12 -> 12."""
    size = F.abs(value)
    return (
        F.when(size >= 1e9, fixed(value / 1e9, "%.1fB"))
        .when(size >= 1e6, fixed(value / 1e6, "%.0fM"))
        .when(size >= 1e3, fixed(value / 1e3, "%.0fK"))
        .otherwise(fixed(value, "%.0f"))
    )


def percent(value: Column, digits: int = 1) -> Column:
    return fixed(value * 100, f"%.{digits}f%%")


def grouped(value: Column, digits: int = 0) -> Column:
    """Thousands separators."""
    return F.format_number(value, digits)
