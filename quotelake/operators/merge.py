"""Merging a batch into a stored table, as functions from (table, batch) to the new table.

The batch is the small side in daily runs. Every operator joins the table against keys of the batch only,
so Spark can broadcast them when they are small and the table itself need not move.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.operators.dedup import keep_first, keep_last
from quotelake.operators.sizing import broadcast_if_small


def _without(table: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of ``table`` whose key does not occur in ``keys``; a NULL key equals a NULL key."""
    marked = keys.select(*[F.col(k).alias(f"_k_{k}") for k in names])
    same = reduce(Column.__and__, [table[k].eqNullSafe(marked[f"_k_{k}"]) for k in names])
    return table.join(marked, same, "left_anti")


def upsert(table: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of the batch replace rows with the same key; copies inside the batch keep the last in ``order``."""
    latest = keep_last(batch, keys, order)
    return _without(table, latest, keys).unionByName(latest, allowMissingColumns=True)


def replace_slices(table: DataFrame, batch: DataFrame, slices: Sequence[str] = ("DateId",)) -> DataFrame:
    """Delete every row whose slice occurs in the batch, then add the batch.

    With only the date as slice, rows of *other* tickers on a touched date go too; pass the full key
    for batches that hold some tickers only.
    """
    return _without(table, batch.select(*slices).distinct(), slices).unionByName(batch)


def merge_dimension(
    table: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    update: Sequence[str] | None = None,
) -> DataFrame:
    """Update matched members and insert the others.

    ``update`` defaults to every non-key column of the batch; an empty list only inserts. Columns the batch
    lacks keep their stored value.
    """
    source = keep_last(batch, keys, order)
    given = set(source.columns)
    replaced = set(given - set(keys) if update is None else update)
    t, s = table.withColumn("_t", F.lit(True)).alias("t"), source.withColumn("_s", F.lit(True)).alias("s")
    same = reduce(Column.__and__, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])

    def chosen(name: str) -> Column:
        old = F.col(f"t.{name}")
        if name not in given:
            return old
        new = F.col(f"s.{name}")
        if name in replaced:
            return F.when(F.col("s._s"), new).otherwise(old)
        return F.when(F.col("t._t"), old).otherwise(new)

    return t.join(s, same, "full_outer").select(*[chosen(c).alias(c) for c in table.columns])


def split_valid(
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    required: Sequence[str] = (),
    lengths: dict[str, int] | None = None,
    table: DataFrame | None = None,
    store: Callable[[DataFrame, str], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows a keyed insert takes, and the rows it refuses with a reason and their number of copies.

    Refused are rows without a required value, with too long a text, with a key the table already holds,
    and all but the first row (in ``order``, then by the remaining columns) of a key. With ``store`` (``materialised``) rows are judged once, keys
    are counted by hash, and only rows of keys met more than once are put in order.
    """
    columns = batch.columns
    reason = F.lit(None).cast("string")
    for name, limit in (lengths or {}).items():
        reason = F.when(F.length(name) > limit, F.lit(f"too long: {name}")).otherwise(reason)
    for name in dict.fromkeys([*keys, *required]):
        reason = F.when(F.col(name).isNull(), F.lit(f"missing: {name}")).otherwise(reason)

    judged = batch.withColumn("reason", reason)
    if table is not None:
        held = table.select(*keys).distinct().withColumn("_held", F.lit(True))
        judged = (
            judged.join(held, list(keys), "left")
            .withColumn("reason", F.coalesce("reason", F.when(F.col("_held"), F.lit("key exists"))))
            .select(*columns, "reason")
        )
    rest = [c for c in columns if c not in order]
    judged = judged if store is None else store(judged, "judged")
    valid = judged.where(F.col("reason").isNull()).select(*columns)
    several = valid
    if store is not None:
        repeated = valid.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)
        known = broadcast_if_small(store(repeated, "repeated"))
        several = valid.join(known, list(keys), "left_semi").select(*columns)
    first_rows = keep_first(several, keys, [*order, *rest])
    accepted = first_rows if store is None else valid.join(known, list(keys), "left_anti").select(*columns).unionByName(first_rows)

    # Identical rows collapse to one with a count, so copies of a hot key never travel row by row.
    copies = F.count(F.lit(1)).alias("copies")
    first = first_rows.select(*keys, F.struct(*columns).alias("_first"))
    spare = several.groupBy(*columns).agg(copies).join(first, list(keys)).withColumn(
        "copies", F.col("copies") - F.when(F.struct(*columns).eqNullSafe(F.col("_first")), 1).otherwise(0)
    )
    duplicates = spare.where(F.col("copies") > 0).select(*columns, F.lit("duplicate key").alias("reason"), "copies")
    refused = judged.where(F.col("reason").isNotNull()).groupBy(*columns, "reason").agg(copies)
    return accepted, refused.unionByName(duplicates)


def insert_counts(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: inserted, skipped, total."""
    each = accepted.select(F.lit(1).alias("i"), F.lit(0).cast("bigint").alias("s")).unionAll(
        rejected.select(F.lit(0).alias("i"), F.col("copies").cast("bigint").alias("s"))
    )
    return each.agg(
        F.coalesce(F.sum("i"), F.lit(0)).alias("inserted"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("skipped"),
        F.coalesce(F.sum(F.col("i") + F.col("s")), F.lit(0)).alias("total"),
    )


def key_violations(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are NULL or occur more than once; empty for a sound primary key."""
    has_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where((F.col("rows") > 1) | has_null)
