"""Column expressions for dates and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_utc(value: Column, exchange_tz: str | None = None) -> Column:
    """Timestamp or NULL, on the UTC clock.

    ``exchange_tz`` keeps the wall clock of that zone instead, so that sessions east of UTC do not
    slip to the previous day.
    """
    stamp = value.try_cast("timestamp")
    return F.from_utc_timestamp(stamp, exchange_tz) if exchange_tz else stamp


def date_key(day: Column) -> Column:
    """The integer yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date or NULL when the parts make none."""
    text = F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int"))
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull(), text.try_cast("date"))


def calendar_parts(day: Column) -> dict[str, Column]:
    """The attributes of a calendar member; the week is the ISO week."""
    return {
        "DateId": date_key(day),
        "Year": F.year(day),
        "Quarter": F.quarter(day),
        "Month": F.month(day),
        "Week": F.weekofyear(day),
        "Day": F.dayofmonth(day),
    }


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")
