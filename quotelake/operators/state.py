"""Indicators that go on from a stored state, so a batch needs no history.

The state of a series is what its next rows need of all rows so far: its last TAIL_ROWS bars, for the rolling windows, and for each exponential
average the decayed sums of the closes and of the weights of the rows before them. Sums of successive stretches combine as
(sum, rows) + (sum', rows') = (sum * decay^rows' + sum', rows + rows'), which is associative, so rows that leave the tail are folded in as sums of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.functions.rolling import decay
from quotelake.operators.indicators import FAST_SPAN, LONG_AVERAGE, SLOW_SPAN, carried, compute_indicators
from quotelake.operators.series import POSITION, with_position
from quotelake.operators.sizing import broadcast_if_small, materialised

# The longest window needs one row less; the gain of the first row of a window needs its predecessor.
TAIL_ROWS = LONG_AVERAGE
SPANS = (FAST_SPAN, SLOW_SPAN)
STATE_BUCKETS = 256

BAR = T.StructType(
    [T.StructField("date", T.TimestampType()), *[T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close")], T.StructField("volume", T.LongType())]
)
SUMS = [name for span in SPANS for name in carried(span)]
STATE = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("last_date", T.TimestampType()),
        *[T.StructField(name, T.DoubleType()) for name in SUMS],
        T.StructField("tail", T.ArrayType(BAR)),
        T.StructField("bucket", T.IntegerType()),
    ]
)


def bucket_of(ticker: str = "ticker") -> Column:
    """The folder a ticker's state is in."""
    return F.pmod(F.xxhash64(ticker), F.lit(STATE_BUCKETS)).cast("int")


def late_tickers(batch: DataFrame, states: DataFrame) -> DataFrame:
    """Tickers with a bar at or before the last date of their state."""
    first = batch.groupBy("ticker").agg(F.min(F.col("date").cast("timestamp")).alias("_first"))
    return first.join(states.select("ticker", "last_date"), "ticker").where(F.col("_first") <= F.col("last_date")).select("ticker")


def tail_bars(states: DataFrame) -> DataFrame:
    """The bars that states keep."""
    return states.select("ticker", F.explode("tail").alias("_bar")).select("ticker", "_bar.*")


def _bars(batch: DataFrame) -> DataFrame:
    return batch.select("ticker", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in BAR])


def indicators_behind_state(batch: DataFrame, states: DataFrame, digits: int | None = 2) -> DataFrame:
    """Indicators of the batch rows; each series goes on from its state, one without a state starts here."""
    kept = tail_bars(states).withColumn("_in_batch", F.lit(False))
    rows = kept.unionByName(_bars(batch).withColumn("_in_batch", F.lit(True)))
    done = compute_indicators(rows, digits=digits, carry=states)
    return done.where("_in_batch").drop("_in_batch")


def states_after(batch: DataFrame, states: DataFrame) -> DataFrame:
    """The state of every series of the batch once its rows have followed; columns of STATE but the bucket.

    One row per series and sum leaves the map side; a tail is TAIL_ROWS rows.
    """
    rows = materialised(with_position(tail_bars(states).unionByName(_bars(batch))), "rows")
    counts = rows.groupBy("ticker").agg((F.count(F.lit(1)) - TAIL_ROWS).alias("_leave"), F.max("date").alias("last_date"))
    placed = rows.join(broadcast_if_small(counts.select("ticker", "_leave")), "ticker")
    leaves = F.col(POSITION) < F.col("_leave")
    faded = {span: F.pow(F.lit(decay(span)), (F.col("_leave") - 1 - F.col(POSITION)).cast("double")) for span in SPANS}
    folded = placed.where(leaves & F.col("close").isNotNull()).groupBy("ticker").agg(*[
        F.sum(value).alias(f"_{name}")
        for span in SPANS
        for name, value in zip(carried(span), (F.col("close") * faded[span], faded[span]), strict=True)
    ])
    tails = placed.where(~leaves).groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct(*BAR.fieldNames()))).alias("tail"))
    both = counts.join(tails, "ticker").join(folded, "ticker", "left").join(states.select("ticker", *SUMS), "ticker", "left")
    shift = F.greatest(F.col("_leave"), F.lit(0)).cast("double")

    def combined(span: int, name: str) -> Column:
        old, new = F.coalesce(F.col(name), F.lit(0.0)), F.coalesce(F.col(f"_{name}"), F.lit(0.0))
        return (old * F.pow(F.lit(decay(span)), shift) + new).alias(name)

    return both.select("ticker", "last_date", *[combined(span, name) for span in SPANS for name in carried(span)], "tail")
