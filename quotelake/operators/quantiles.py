"""Exact interpolated quantiles by radix selection, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.operators.sizing import materialised, materialised_numbers

# Bits of the key that a round tells apart; four rounds tell all values apart.
ROUND_BITS = 16
_KEY_BITS = 64
_UNIT = 1 << 52
_LEAST_EXPONENT = -1022


def order_key(value: Column) -> Column:
    """A whole number per double, in the same order: sign, exponent and fraction as IEEE 754 lays them out. NaN comes last."""
    size = F.abs(value)
    guess = F.floor(F.log2(size)).cast("double")
    # the logarithm may be off by one next to a power of two
    exponent = guess + F.when(size >= F.pow(F.lit(2.0), guess + 1), 1).when(size < F.pow(F.lit(2.0), guess), -1).otherwise(0)
    whole = F.when(
        exponent >= _LEAST_EXPONENT,
        (exponent - _LEAST_EXPONENT + 1).cast("long") * _UNIT + ((size / F.pow(F.lit(2.0), exponent) - 1) * _UNIT).cast("long"),
    ).otherwise((size / F.lit(2.0**-1074)).cast("long"))
    infinite = F.lit(2047 * _UNIT)
    key = F.when(F.isnan(value), infinite + 1).when(size == 0, F.lit(0)).when(size == float("inf"), infinite).otherwise(whole)
    return F.when(value < 0, -key).otherwise(key).cast("long")


def _inside(ranks: Column, start: Column, size: Column) -> Column:
    return F.filter(ranks, lambda r: (r["rank"] >= start) & (r["rank"] < start + size))


def exact_quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = (), groups: int | None = None
) -> DataFrame:
    """One row per group with a column per named probability, linear between neighbouring ranks.

    Each round counts rows by the next 16 bits of their key within the cells that hold the ranks asked for, which combines before the
    shuffle, and keeps the cells that hold them now. It ends when each of these holds one value, after four rounds at most whatever the values are.
    Only cells are put in order, at most 65536 of a group and prefix. NULLs are left out. Give a stored frame where it is costly to compute
    more than once. groups: how many there are, where that is known; cells then go to as many tasks as they are worth.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull()).withColumn("_key", order_key(F.col("_v")))
    before = Window.unboundedPreceding
    sizes = (F.count(F.lit(1)).alias("_size"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))

    shift = _KEY_BITS - ROUND_BITS
    cells = rows.groupBy(*by, F.shiftright("_key", shift).alias("_cell")).agg(*sizes)
    in_group = Window.partitionBy(*by)
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), rank(F.col("_last") * p).alias("rank"))
        for name, p in probabilities.items()
        for side, rank in (("low", F.floor), ("high", F.ceil))
    ])
    cells = (
        cells.withColumn("_last", F.sum("_size").over(in_group) - 1)
        .withColumn("_start", F.sum("_size").over(in_group.orderBy("_cell").rowsBetween(before, 0)) - F.col("_size"))
        .withColumn("_ranks", wanted)
    )

    while True:
        # At most two cells per group and probability. Stored, they are known to be small and the next round joins them
        # without moving the column.
        holding = cells.withColumn("_ranks", _inside(F.col("_ranks"), F.col("_start"), F.col("_size"))).where(F.size("_ranks") > 0)
        hits = materialised(holding, "cells") if groups is None else materialised_numbers(holding, groups << ROUND_BITS, "cells")
        if shift == 0 or hits.where("_low < _high").isEmpty():
            break
        prefix = F.shiftright("_key", shift).alias("_prefix")
        shift -= ROUND_BITS
        open_cells = hits.select(
            *[F.col(c).alias(f"_by_{k}") for k, c in enumerate(by)], F.col("_cell").alias("_prefix"), F.col("_start").alias("_base"), "_last", "_ranks"
        )
        same = [F.col(c).eqNullSafe(F.col(f"_by_{k}")) for k, c in enumerate(by)]
        keyed = rows.select(*by, "_v", F.shiftright("_key", shift).alias("_cell"), prefix.alias("_p"))
        held = [*same, F.col("_p") == F.col("_prefix")]
        # numbers only, so that cells are counted by hash; what the cell before them asks for comes back by a second join
        counted = keyed.join(open_cells.drop("_base", "_last", "_ranks"), held).groupBy(*by, "_p", "_cell").agg(*sizes).join(open_cells, held)
        in_prefix = Window.partitionBy(*by, "_prefix").orderBy("_cell").rowsBetween(before, 0)
        cells = counted.withColumn("_start", F.col("_base") + F.sum("_size").over(in_prefix) - F.col("_size"))

    found = hits.select(*by, F.col("_low").alias("_v"), "_last", F.explode("_ranks").alias("_r"))

    def side_value(name: str, side: str) -> Column:
        return F.max(F.when((F.col("_r.name") == name) & (F.col("_r.side") == side), F.col("_v")))

    def interpolated(name: str, p: float) -> Column:
        low, high = side_value(name, "low"), side_value(name, "high")
        place = F.max("_last") * p
        return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place))).alias(name)

    return found.groupBy(*by).agg(*[interpolated(n, p) for n, p in probabilities.items()])
