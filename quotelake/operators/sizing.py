"""Stored intermediate results, and broadcasts behind a check of the counted size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.session import work_folder

# Rows of a dimension that fit an executor comfortably (about 100 bytes each).
BROADCAST_ROWS = 1_000_000
# Rows of numbers that make a file worth its cost: about 1 MB.
FILE_ROWS = 16384


def materialised(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write a frame to the shared work folder and read it back.

    Cuts the lineage, so a frame that feeds several steps is computed once and survives lost executors.
    What is read back has a known size, by which Spark chooses broadcast or shuffle joins when it plans.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialised_numbers(df: DataFrame, rows: int, purpose: str = "stage") -> DataFrame:
    """The same for narrow rows of which a bound on the number is known: a task writes FILE_ROWS or so, and not a file per shuffle partition."""
    return materialised(df.coalesce(max(1, -(-rows // FILE_ROWS))), purpose)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when a count proves the frame small; otherwise leave the join to Spark.

    Meant for dimensions. The count stops after ``rows`` + 1 rows, so checking a large frame is cheap.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
