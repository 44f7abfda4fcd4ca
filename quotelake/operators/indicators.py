"""Technical indicators of daily bars, all planned over one chunked window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.numeric import round_fractions
from quotelake.functions.rolling import (
    ewm_mean,
    ewm_row_limit,
    gain,
    loss,
    relative_strength,
    rolling_deviation,
    rolling_sum,
    std_of_two_blocks,
    step,
    sum_of_blocks,
)
from quotelake.operators.series import CHUNK, CHUNK_ROWS, LOOKBACK_ROWS, POSITION, chunked, in_chunk, unchunked
from quotelake.operators.sizing import broadcast_if_small

# Window lengths in rows.
SHORT_AVERAGE, LONG_AVERAGE = 20, 50
STRENGTH_ROWS = 14
RANGE_ROWS = 14
FAST_SPAN, SLOW_SPAN = 12, 26
BAND_WIDTH = 2.0
# Rows of the frames that the windows are put together from: the averages' and half of the others'.
_BLOCK, _HALF = SHORT_AVERAGE // 2, STRENGTH_ROWS // 2
OVERBOUGHT, OVERSOLD = 70.0, 30.0

INDICATORS = ("sma_20", "sma_50", "atr", "rsi", "macd", "bb_upper", "bb_lower")


def carried(span: int) -> tuple[str, str]:
    """The columns that hold the decayed sums of closes and of weights for a span."""
    return f"closes_{span}", f"weights_{span}"


def compute_indicators(
    bars: DataFrame,
    by: Sequence[str] = ("ticker",),
    order: Sequence[str] = ("date",),
    digits: int | None = 2,
    grain: str = "year",
    details: bool = False,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Add the indicator columns. ``digits`` rounds every fractional column, as the silver tables store
    them; None keeps full precision. ``details`` keeps the intermediate columns. ``carry`` has a row per series (``by``) with
    the decayed sums of the rows before the given ones, as ``carried`` names them; the exponential averages go on from there."""
    if max(CHUNK_ROWS + LOOKBACK_ROWS, LONG_AVERAGE) > ewm_row_limit(FAST_SPAN):
        raise ValueError("chunks are too long for the running exponential sums")
    window = in_chunk(by)
    close = F.col("close")
    row_in_chunk = F.col(POSITION) - F.col(CHUNK) * CHUNK_ROWS + LOOKBACK_ROWS

    if carry is not None:
        sums = [name for span in (FAST_SPAN, SLOW_SPAN) for name in carried(span)]
        bars = bars.join(broadcast_if_small(carry.select(*by, *sums)), list(by), "left").na.fill(0.0, sums)
    before = {span: tuple(F.col(name) for name in carried(span)) if carry is not None else None for span in (FAST_SPAN, SLOW_SPAN)}
    place = F.col(POSITION)

    out = chunked(bars, by, order, grain=grain)
    out = out.withColumns({
        "diff": step(close, window),
        "tr": F.col("high") - F.col("low"),
    })
    out = out.withColumns({"gain": gain(F.col("diff")), "loss": loss(F.col("diff"))})
    # A rolling frame is gone through for each row, so the long windows are put together from frames of a few rows.
    out = out.withColumns({
        "_closes": rolling_sum(close, _BLOCK, window),
        "_deviations": rolling_deviation(close, _BLOCK, window),
        "_gains": rolling_sum(F.col("gain"), _HALF, window),
        "_losses": rolling_sum(F.col("loss"), _HALF, window),
        "_ranges": rolling_sum(F.col("tr"), _HALF, window),
        "ema_12": ewm_mean(close, FAST_SPAN, window, row_in_chunk, before[FAST_SPAN], place),
        "ema_26": ewm_mean(close, SLOW_SPAN, window, row_in_chunk, before[SLOW_SPAN], place),
    })
    out = out.withColumns({
        "sma_20": sum_of_blocks(F.col("_closes"), _BLOCK, SHORT_AVERAGE // _BLOCK, window) / SHORT_AVERAGE,
        "sma_50": sum_of_blocks(F.col("_closes"), _BLOCK, LONG_AVERAGE // _BLOCK, window) / LONG_AVERAGE,
        "std_20": std_of_two_blocks(F.col("_closes"), F.col("_deviations"), _BLOCK, window),
        "avg_gain": sum_of_blocks(F.col("_gains"), _HALF, 2, window) / STRENGTH_ROWS,
        "avg_loss": sum_of_blocks(F.col("_losses"), _HALF, 2, window) / STRENGTH_ROWS,
        "atr": sum_of_blocks(F.col("_ranges"), _HALF, 2, window) / RANGE_ROWS,
    }).drop("_closes", "_deviations", "_gains", "_losses", "_ranges")
    if carry is not None:
        out = out.drop(*sums)
    out = unchunked(out).withColumns({
        "rsi": relative_strength(F.col("avg_gain"), F.col("avg_loss")),
        "macd": F.col("ema_12") - F.col("ema_26"),
        "bb_upper": F.col("sma_20") + BAND_WIDTH * F.col("std_20"),
        "bb_lower": F.col("sma_20") - BAND_WIDTH * F.col("std_20"),
    })
    if not details:
        out = out.drop("diff", "gain", "loss", "std_20", "avg_gain", "avg_loss", "ema_12", "ema_26")
    return out if digits is None else round_fractions(out, digits)


def with_signals(technical: DataFrame) -> DataFrame:
    """The zone of the RSI and the sign of the MACD, as the indicator panels colour them."""
    return technical.withColumns({
        "rsi_zone": F.when(F.col("rsi") >= OVERBOUGHT, "overbought")
        .when(F.col("rsi") <= OVERSOLD, "oversold")
        .when(F.col("rsi").isNotNull(), "neutral"),
        "macd_sign": F.when(F.col("macd") >= 0, "positive").when(F.col("macd").isNotNull(), "negative"),
    })
