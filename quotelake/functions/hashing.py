"""Content digests that combine on the map side and ignore row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotelake.functions.names import column

_HEX_PER_PART = 8


def row_digest(columns: Sequence[str]) -> Column:
    """md5 of one row. JSON with explicit nulls keeps NULL apart from an empty text."""
    return F.md5(F.to_json(F.struct(*map(column, columns)), {"ignoreNullFields": "false"}))


def digest_parts(digest: Column) -> list[Column]:
    """The four 32-bit numbers of an md5, wide enough to be summed over any number of rows."""
    return [
        F.conv(F.substring(digest, 1 + _HEX_PER_PART * i, _HEX_PER_PART), 16, 10).cast("decimal(18,0)")
        for i in range(4)
    ]


def multiset_digest(digest: Column) -> Column:
    """Aggregate: one md5 for a bag of row digests.

    The row count and the sums of the four digest parts describe the bag independently of its order,
    take constant state per key and merge in partial aggregation, so a key with a third of all rows
    costs no more memory than a key with one.
    """
    sums = [F.sum(part).cast("string") for part in digest_parts(digest)]
    return F.md5(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums))
