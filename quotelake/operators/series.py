"""Ordered computations over keyed time series that survive a hot key.

A plain window partitioned by the series key sends a whole series to one task. The helpers here cut a
series into calendar blocks or into chunks of a fixed number of rows, so that the largest task depends
on the block or chunk and not on the key:

* ``with_earlier`` gives every row the running summary of all *earlier blocks* of its series. Block
  summaries are ordinary aggregates (combined before the shuffle); the ordered part runs on one row per
  block only.
* ``with_position`` numbers the rows of a series.
* ``with_sized_block`` makes blocks by the count of rows, whatever the grain of the feed.
* ``chunked`` cuts a series into equal chunks and repeats the rows a rolling window looks back on at the
  start of the next chunk, so any row-based window of bounded length is exact inside its chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quotelake.operators.sizing import materialised

BLOCK = "_block"
POSITION = "_pos"
CHUNK = "_chunk"
REPEATED = "_repeated"

# Rows per chunk and rows repeated at its start. The look-back covers the longest rolling window (50) and
# leaves an exponential average with span 26 a restart error below 1e-17.
CHUNK_ROWS = 2048
LOOKBACK_ROWS = 512

# Grains of blocks, and the rows that a block may have before it is cut at the next one.
GRAINS = ("year", "month", "day", "hour", "minute", "second", "millisecond", "microsecond")
BLOCK_ROWS = 1 << 16

Summary = tuple[Column, Callable[[Column], Column]]


def with_block(df: DataFrame, time: str = "date", grain: str = "year") -> DataFrame:
    """Tag the calendar block. ``grain`` must bound the rows of one key: a year does for daily bars (366);
    pass ``day`` or ``hour`` for feeds that are finer than a day."""
    return df.withColumn(BLOCK, F.date_trunc(grain, F.col(time).cast("timestamp")))


def with_sized_block(df: DataFrame, by: Sequence[str] = ("ticker",), time: str = "date", rows: int = BLOCK_ROWS) -> DataFrame:
    """Tag calendar blocks of at most ``rows`` rows each: years, and where a series has more in one, its months, days and so on down.

    Counts combine before the shuffle, and each finer count only covers the blocks that are too full; daily bars need one. Rows of
    one microsecond have no order among them and stay together. A block is its first moment, so blocks of a series never overlap.
    """
    moment = F.col(time).cast("timestamp")
    tagged = df.withColumn(BLOCK, F.date_trunc(GRAINS[0], moment))
    suspects, keys = tagged, [*by, BLOCK]
    for finer in GRAINS[1:]:
        counted = suspects.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > rows)
        full = materialised(counted.select(*keys, F.lit(True).alias("_full")), "full-blocks")
        if full.isEmpty():
            break
        cut = tagged.join(full, keys, "left").withColumn(BLOCK, F.when(F.col("_full"), F.date_trunc(finer, moment)).otherwise(F.col(BLOCK)))
        tagged, suspects = cut.drop("_full"), cut.where("_full")
    return tagged


def within_block(by: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by, BLOCK).orderBy(*order)


def with_earlier(blocked: DataFrame, by: Sequence[str], summaries: dict[str, Summary]) -> DataFrame:
    """Add ``name`` = combine(summary of each earlier block of the same series), NULL in the first block.

    ``summaries`` maps a name to (aggregate over a block, aggregate that combines blocks).
    """
    per_block = blocked.groupBy(*by, BLOCK).agg(*[agg.alias(name) for name, (agg, _) in summaries.items()])
    earlier = Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    prefix = per_block.select(
        *by, BLOCK, *[combine(F.col(name)).over(earlier).alias(name) for name, (_, combine) in summaries.items()]
    )
    return blocked.join(prefix, [*by, BLOCK], "left")


def last_known(column: Column) -> Column:
    """Combiner for ``with_earlier``: the value of the nearest earlier block."""
    return F.last(column, ignorenulls=True)


def with_position(
    df: DataFrame, by: Sequence[str] = ("ticker",), order: Sequence[str] = ("date",), grain: str = "year"
) -> DataFrame:
    """Number the rows of each series from 0 in ``order``, without one task seeing a whole series."""
    blocked = with_block(df, order[0], grain)
    counted = with_earlier(blocked, by, {"_before": (F.count(F.lit(1)), F.sum)})
    in_block = F.row_number().over(within_block(by, order))
    position = (F.coalesce("_before", F.lit(0)) + in_block - 1).cast("long")
    return counted.withColumn(POSITION, position).drop("_before", BLOCK)


def chunked(
    df: DataFrame,
    by: Sequence[str] = ("ticker",),
    order: Sequence[str] = ("date",),
    lookback: int = LOOKBACK_ROWS,
    rows: int = CHUNK_ROWS,
    grain: str = "year",
) -> DataFrame:
    """Cut every series into chunks of ``rows`` rows, each preceded by ``lookback`` repeated rows."""
    if lookback > rows:
        raise ValueError("a chunk must be at least as long as the look-back")
    own = F.floor(F.col(POSITION) / rows)
    needed_next = (F.col(POSITION) % rows) >= rows - lookback
    copies = F.when(needed_next, F.array(own, own + 1)).otherwise(F.array(own))
    return (
        with_position(df, by, order, grain)
        .withColumn(CHUNK, F.explode(copies))
        .withColumn(REPEATED, F.col(CHUNK) > own)
    )


def in_chunk(by: Sequence[str] = ("ticker",)) -> WindowSpec:
    return Window.partitionBy(*by, CHUNK).orderBy(POSITION)


def unchunked(df: DataFrame) -> DataFrame:
    """Drop the repeated rows and the helper columns again."""
    return df.where(~F.col(REPEATED)).drop(CHUNK, POSITION, REPEATED)
