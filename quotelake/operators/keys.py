"""Stable surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators.series import BLOCK, with_earlier, within_block

# New members are numbered by (first digits of the md5 of the name, name): the 4096 buckets fill evenly
# whatever the names look like, and only their counts are ever put in one global order.
_BUCKET_DIGITS = 3


def assign_keys(known: DataFrame | None, members: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name) for all members: known ones keep their key, new ones continue after the largest.

    ``members`` needs the column ``name``; NULLs are skipped. The result does not depend on row order.
    """
    fresh = members.select(name).where(F.col(name).isNotNull()).distinct()
    offset = F.lit(0)
    if known is not None:
        known = known.select(key, name)
        fresh = fresh.join(known.select(name), name, "left_anti")
        offset = known.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    bucketed = fresh.withColumn(BLOCK, F.substring(F.md5(name), 1, _BUCKET_DIGITS))
    counted = with_earlier(bucketed, [], {"_before": (F.count(F.lit(1)), F.sum)})
    number = offset + F.coalesce("_before", F.lit(0)) + F.row_number().over(within_block([], [name]))
    numbered = counted.select(number.cast("int").alias(key), name)
    return numbered if known is None else known.unionByName(numbered)
