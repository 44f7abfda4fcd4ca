"""Projections of cleaned bars and company facts onto the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.numeric import round_half_even


def price_history(bars: DataFrame) -> DataFrame:
    """Prices at two decimals; the adjusted close is the close."""
    prices = {c: round_half_even(F.col(c)) for c in ("open", "high", "low", "close")}
    return bars.select(
        "ticker",
        F.col("date").alias("date"),
        F.year("date").alias("year"),
        *[prices[c].alias(c) for c in prices],
        F.col("volume").cast("bigint").alias("volume"),
        prices["close"].alias("adj_close"),
    )


def technical_indicators(with_indicators: DataFrame) -> DataFrame:
    return with_indicators.select(
        "ticker",
        F.col("date").alias("date"),
        F.year("date").alias("year"),
        "sma_20",
        "sma_50",
        "atr",
        "rsi",
        "macd",
        "bb_upper",
        "bb_lower",
    )


def stocks_master(info: DataFrame) -> DataFrame:
    return info.select("ticker", F.col("longName").alias("company_name"), "sector", "industry").distinct()
