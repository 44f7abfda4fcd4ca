"""Window expressions for technical indicators.

Every function takes the window of a series and returns a Column, so Spark plans all of them over one
shuffle and one sort. ``n`` rows of history are required: fewer non-null values give NULL.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def rolling(aggregate: Callable[[Column], Column], value: Column, n: int, window: WindowSpec) -> Column:
    frame = window.rowsBetween(-(n - 1), Window.currentRow)
    return F.when(F.count(value).over(frame) == n, aggregate(value).over(frame))


def rolling_mean(value: Column, n: int, window: WindowSpec) -> Column:
    return rolling(F.avg, value, n, window)


def rolling_sum(value: Column, n: int, window: WindowSpec) -> Column:
    return rolling(F.sum, value, n, window)


def rolling_deviation(value: Column, n: int, window: WindowSpec) -> Column:
    """The sum of squared deviations from the mean of the window."""
    return rolling(F.var_pop, value, n, window) * n


def sum_of_blocks(sums: Column, n: int, blocks: int, window: WindowSpec) -> Column:
    """The rolling sum over ``blocks * n`` rows from that over ``n`` rows, a stored column: each block ends where the next begins."""
    return reduce(Column.__add__, [sums, *[F.lag(sums, n * k).over(window) for k in range(1, blocks)]])


def std_of_two_blocks(sums: Column, deviations: Column, n: int, window: WindowSpec) -> Column:
    """The rolling sample standard deviation over ``2 * n`` rows from sums and squared deviations over ``n`` rows, both stored columns."""
    apart = sums - F.lag(sums, n).over(window)
    return F.sqrt((deviations + F.lag(deviations, n).over(window) + apart * apart / (2 * n)) / (2 * n - 1))


def rolling_std(value: Column, n: int, window: WindowSpec) -> Column:
    """Sample standard deviation."""
    return rolling(F.stddev_samp, value, n, window)


def step(value: Column, window: WindowSpec) -> Column:
    """Difference to the previous row."""
    return value - F.lag(value).over(window)


def gain(change: Column) -> Column:
    return F.when(change > 0, change).when(change.isNotNull(), F.lit(0.0))


def loss(change: Column) -> Column:
    return F.when(change < 0, -change).when(change.isNotNull(), F.lit(0.0))


def relative_strength(mean_gain: Column, mean_loss: Column) -> Column:
    """RSI from the simple means of gains and losses.

    Without losses, and while the window warms up, the index is the neutral 50.
    """
    ratio = mean_gain / F.nullif(mean_loss, F.lit(0.0))
    return F.coalesce(100.0 - 100.0 / (1.0 + ratio), F.lit(50.0))


def decay(span: int) -> float:
    """What a weight is multiplied by from one row to the next."""
    return 1.0 - 2.0 / (span + 1.0)


def ewm_mean(
    value: Column, span: int, window: WindowSpec, position: Column, before: tuple[Column, Column] | None = None, place: Column | None = None
) -> Column:
    """Exponentially weighted mean whose weights are normalised over the rows seen (adjusted form).

    A weight (1-a)^(t-i) is (1-a)^t times (1-a)^(-i), so the mean is a ratio of two *running* sums and
    costs O(1) per row. ``position`` must count rows from the start of the window partition and stay
    below ``ewm_row_limit(span)``; chunked series do. A NULL takes its place in the row count but adds
    nothing, so the last mean carries over it.

    ``before`` = decayed sums of the values and of the weights of earlier rows, as of the last of them; ``place`` then counts
    rows from the first one after them. They fade by the same factor per row, so the mean is that of the whole series.
    """
    growth = 1.0 / decay(span)
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weight = F.pow(F.lit(growth), position.cast("double"))
    total = F.sum(value * weight).over(running)
    weights = F.sum(F.when(value.isNotNull(), weight)).over(running)
    if before is None:
        return total / weights
    faded = F.pow(F.lit(decay(span)), (place + 1).cast("double"))
    sums = [F.coalesce(new / weight, F.lit(0.0)) + old * faded for new, old in zip((total, weights), before, strict=True)]
    return F.when(sums[1] > 0, sums[0] / sums[1])


def ewm_row_limit(span: int) -> int:
    """Rows after which the growing weight, times any price, would leave the double range."""
    growth = 1.0 / decay(span)
    return int(math.log(1e250) / math.log(growth))
