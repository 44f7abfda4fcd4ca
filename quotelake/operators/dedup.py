"""One row per key, chosen by an explicit order.

All forms are aggregates, so copies collapse before the shuffle and a key that holds a third of all rows
never meets in one task, as it would behind a row-number window. Where hardly any key has copies, as in fact tables, ``keep_first_stored``
counts keys by hash and puts in order only the rows of keys met more than once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.operators.sizing import broadcast_if_small, materialised


def _pick(choose: Callable[[Column], Column], df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The extreme row per key. The other columns follow the order in the comparison, so ties are repeatable."""
    if not order:
        raise ValueError("name the columns that decide which copy is kept")
    placed = {c.lower() for c in (*keys, *order)}
    keyed = {k.lower() for k in keys}
    leading = [c for c in order if c.lower() not in keyed]
    row = F.struct(*leading, *[c for c in df.columns if c.lower() not in placed])
    return df.groupBy(*keys).agg(choose(row).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row that comes first in ``order``; NULLs come before values."""
    return _pick(F.min, df, keys, order)


def keep_first_stored(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The same for a stored frame, which is read twice: only keys are shuffled, and whole rows of repeated keys only."""
    count = F.count(F.lit(1)).alias("_n")
    names = [f"_k{k}" for k in range(len(keys))]
    repeated = rows.groupBy(*[F.col(key).alias(name) for key, name in zip(keys, names, strict=True)]).agg(count).where("_n > 1").select(*names)
    repeated = materialised(repeated, "repeated")
    if repeated.isEmpty():
        return rows
    known = broadcast_if_small(repeated)
    same = [F.col(key).eqNullSafe(F.col(name)) for key, name in zip(keys, names, strict=True)]
    once = rows.join(known, same, "left_anti")
    return once.unionByName(keep_first(rows.join(known, same, "left_semi"), keys, order))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row that comes last in ``order``."""
    return _pick(F.max, df, keys, order)


def duplicate_counts(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows a keep-one-per-key pass removes, per group ``by`` (a subset of the keys)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy(*by).agg((F.sum("_n") - F.count(F.lit(1))).alias("removed"))


def same_columns(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames cut to the columns they share, in the order of ``right``."""
    have = {c.lower() for c in left.columns}
    shared = [c for c in right.columns if c.lower() in have]
    return left.select(*shared), right.select(*shared)
