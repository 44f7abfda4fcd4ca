"""The data behind the portfolio report, and who may see which section."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.dates import month_start
from quotelake.functions.names import column
from quotelake.functions.text import fixed, grouped, percent
from quotelake.operators.analytics import TRADING_DAYS, series_names, with_returns
from quotelake.operators.indicators import with_signals
from quotelake.operators.series import BLOCK, BLOCK_ROWS, with_earlier, with_sized_block, within_block

# The report sections and the roles that see them.
BASIC_SECTIONS = (
    "summary_table",
    "price_timeseries",
    "normalized_performance",
    "volume",
    "volatility",
    "price_correlation",
)
ADVANCED_SECTIONS = (*BASIC_SECTIONS, "indicator_correlation", "technical_indicators")
ROLES = {"basic": BASIC_SECTIONS, "advanced": ADVANCED_SECTIONS}


def closing_series(prices: DataFrame) -> DataFrame:
    return prices.select("ticker", "date", "close")


def normalised_performance(prices: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """The close relative to the first close of the ticker, which counts as 100."""
    first_bar = F.min_by(F.struct("close"), "date")
    blocked = with_earlier(with_sized_block(prices, rows=rows), ["ticker"], {"_first": (first_bar, F.first)})
    own = F.first(F.struct("close")).over(within_block(["ticker"], ["date"]))
    base = F.coalesce("_first", own)["close"]
    return blocked.withColumn("indexed", F.try_divide(F.col("close"), base) * 100.0).select("ticker", "date", "indexed")


def monthly_volume(prices: DataFrame, tickers: list[str] | None = None) -> DataFrame:
    """Mean volume with months in rows and tickers in columns; months without trades count 0."""
    names = tickers if tickers is not None else series_names(prices)
    by_month = prices.groupBy(month_start(F.col("date")).alias("month")).pivot("ticker", names).agg(F.avg("volume"))
    return by_month.select("month", *[F.coalesce(column(n), F.lit(0.0)).alias(n) for n in names])


def monthly_volume_long(prices: DataFrame) -> DataFrame:
    """The same as rows: every month with every ticker, for any number of tickers."""
    dated = prices.select(month_start(F.col("date")).alias("month"), "ticker", "volume")
    means = dated.groupBy("month", "ticker").agg(F.avg("volume").alias("_mean"))
    # the result holds each month with each ticker, so this is its size
    cells = means.select("month").distinct().crossJoin(means.select("ticker").distinct())
    return cells.join(means, ["month", "ticker"], "left").select("month", "ticker", F.coalesce("_mean", F.lit(0.0)).alias("avg_volume"))


def portfolio_summary(prices: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """Range, returns, risk and volume per ticker.

    Returns and running peaks come from the same blocks, and one combining aggregate per ticker
    finishes the job.
    """
    blocked = with_earlier(
        with_sized_block(prices, rows=rows),
        ["ticker"],
        {"_last": (F.max_by("close", "date"), F.last), "_peak": (F.max("close"), F.max)},
    )
    window = within_block(["ticker"], ["date"])
    previous = F.when(F.row_number().over(window) == 1, F.col("_last")).otherwise(F.lag("close").over(window))
    peak = F.greatest("_peak", F.max("close").over(window))
    bars = blocked.withColumns({
        "_ret": F.try_divide(F.col("close"), previous) - 1.0,
        "_fall": F.try_divide(F.col("close"), peak) - 1.0,
    }).drop(BLOCK)
    start, end = F.min_by("close", "date"), F.max_by("close", "date")
    return bars.groupBy("ticker").agg(
        F.min("date").cast("date").alias("first_date"),
        F.max("date").cast("date").alias("last_date"),
        F.count(F.lit(1)).alias("days"),
        start.alias("start_close"),
        end.alias("end_close"),
        (F.try_divide(end, start) - 1.0).alias("total_return"),
        (F.stddev_samp("_ret") * F.sqrt(F.lit(float(TRADING_DAYS)))).alias("annual_volatility"),
        F.min("_fall").alias("max_drawdown"),
        F.avg("volume").alias("avg_volume"),
    )


def summary_texts(summary: DataFrame) -> DataFrame:
    """The summary as the report prints it."""
    return summary.select(
        F.col("ticker").alias("Ticker"),
        F.date_format("first_date", "yyyy-MM-dd").alias("From"),
        F.date_format("last_date", "yyyy-MM-dd").alias("To"),
        F.col("days").alias("Days"),
        fixed(F.col("start_close"), "%.2f").alias("Start ($)"),
        fixed(F.col("end_close"), "%.2f").alias("End ($)"),
        percent(F.col("total_return")).alias("Total Return"),
        percent(F.col("annual_volatility")).alias("Ann. Vol."),
        percent(F.col("max_drawdown")).alias("Max Drawdown"),
        grouped(F.col("avg_volume")).alias("Avg Volume"),
    )


def indicator_panel(prices: DataFrame, technical: DataFrame) -> DataFrame:
    """Close, averages, bands, RSI zone and MACD sign per bar; bars without indicators stay."""
    shown = technical.select("ticker", "date", "sma_20", "sma_50", "bb_upper", "bb_lower", "rsi", "macd")
    return with_signals(closing_series(prices).join(shown, ["ticker", "date"], "left"))


def permissions(prices: DataFrame) -> DataFrame:
    """(role, section) rows of the fixed table above."""
    rows = [(role, section) for role, sections in ROLES.items() for section in sections]
    return prices.sparkSession.createDataFrame(rows, "role string, section string")


def section_access(sections: DataFrame, allowed: DataFrame) -> DataFrame:
    """Every role against every section present, marked visible or locked.

    ``allowed`` holds a dozen (role, section) rows; each section row is paired with the set of roles that
    may see it.
    """
    viewers = allowed.groupBy("section").agg(F.collect_set("role").alias("_viewers"))
    roles = F.array(*[F.lit(r) for r in ROLES])
    seen = F.array_contains(F.coalesce("_viewers", F.array().cast("array<string>")), F.col("role"))
    return (
        sections.join(viewers, "section", "left")
        .withColumn("role", F.explode(roles))
        .withColumn("access", F.when(seen, "visible").otherwise("locked"))
        .drop("_viewers")
    )


def visible_rows(report: DataFrame, allowed: DataFrame, role: str) -> DataFrame:
    """Rows of a long report (with a ``section`` column) that the role may see."""
    if role not in ROLES:
        raise ValueError(f"unknown role {role!r}")
    mine = allowed.where(F.col("role") == role).select("section")
    return report.join(mine, "section", "left_semi")
