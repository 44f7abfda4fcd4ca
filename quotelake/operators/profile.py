"""Quick looks at stored data: counts, profiles, previews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column names taken as the date of a table, best first.
DATE_NAMES = ("date", "Date", "datetime", "Datetime", "timestamp", "Timestamp")


def date_column(columns: Sequence[str]) -> str | None:
    """The date column by name, else the first whose name contains "date"."""
    for name in DATE_NAMES:
        if name in columns:
            return name
    return next((c for c in columns if "date" in c.lower()), None)


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows and files per stage. Each frame must come straight from files."""
    tagged = [
        df.select(F.lit(stage).alias("stage"), F.col("_metadata.file_path").alias("file"))
        for stage, df in stages.items()
    ]
    per_file = reduce(DataFrame.unionByName, tagged).groupBy("stage", "file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("stage").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("files"))


def profile(df: DataFrame, date: str | None = None) -> DataFrame:
    """One row: row count, first and last date, NULLs per column. One pass, whatever the width."""
    day = date or date_column(df.columns)
    span = [F.min(day).alias("first_date"), F.max(day).alias("last_date")] if day else []
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}_nulls") for c in df.columns]
    return df.agg(F.count(F.lit(1)).alias("rows"), *span, *nulls)


def columns_of(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def preview(df: DataFrame, rows: int = 5, order: Sequence[str] = ()) -> DataFrame:
    return (df.orderBy(*order) if order else df).limit(rows)
