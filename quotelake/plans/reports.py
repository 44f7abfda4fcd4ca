"""Report job: every section's rows as a table, and who may read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotelake.operators import analytics
from quotelake.operators import reports as rp
from quotelake.operators.sizing import materialised
from quotelake.schemas import DATE, DOUBLE, LONG, PRICE_HISTORY, TECHNICAL, TEXT, TIME, _columns
from quotelake.sources import commits
from quotelake.sources.files import read_table
from quotelake.sources.sinks import conform

# The columns of each section.
SECTIONS = {
    "summary_table": _columns(
        ticker=TEXT, first_date=DATE, last_date=DATE, days=LONG, start_close=DOUBLE, end_close=DOUBLE,
        total_return=DOUBLE, annual_volatility=DOUBLE, max_drawdown=DOUBLE, avg_volume=DOUBLE,
    ),
    "price_timeseries": _columns(ticker=TEXT, date=TIME, close=DOUBLE),
    "normalized_performance": _columns(ticker=TEXT, date=TIME, indexed=DOUBLE),
    "volume": _columns(month=DATE, ticker=TEXT, avg_volume=DOUBLE),
    "volatility": _columns(ticker=TEXT, date=TIME, volatility=DOUBLE),
    "price_correlation": _columns(ticker_a=TEXT, ticker_b=TEXT, corr=DOUBLE),
    "indicator_correlation": _columns(indicator_a=TEXT, indicator_b=TEXT, corr=DOUBLE),
    "technical_indicators": _columns(
        ticker=TEXT, date=TIME, close=DOUBLE, sma_20=DOUBLE, sma_50=DOUBLE, bb_upper=DOUBLE, bb_lower=DOUBLE,
        rsi=DOUBLE, macd=DOUBLE, rsi_zone=TEXT, macd_sign=TEXT,
    ),
}
ENTITLEMENTS = _columns(role=TEXT, section=TEXT)


def section_rows(prices: DataFrame, technical: DataFrame, section: str) -> DataFrame:
    """The rows behind one section. ``prices`` and ``technical``: bars and indicators by ticker and date, stored."""
    made = {
        "summary_table": lambda: rp.portfolio_summary(prices),
        "price_timeseries": lambda: rp.closing_series(prices),
        "normalized_performance": lambda: rp.normalised_performance(prices),
        "volume": lambda: rp.monthly_volume_long(prices),
        "volatility": lambda: analytics.rolling_volatility(prices),
        "price_correlation": lambda: analytics.returns_correlation(prices),
        "indicator_correlation": lambda: analytics.indicator_correlation(technical),
        "technical_indicators": lambda: rp.indicator_panel(prices, technical),
    }
    return conform(made[section](), SECTIONS[section])


def write_report(prices: DataFrame, technical: DataFrame, root: str) -> None:
    """Commit each section as a table below ``root``; the entitlements come last, so a first report is readable once it is whole."""
    for section in SECTIONS:
        commits.replace(section_rows(prices, technical, section), f"{root}/{section}")
    commits.replace(conform(rp.permissions(prices), ENTITLEMENTS), f"{root}/entitlements")


def report_from_silver(spark: SparkSession, silver: str, root: str) -> bool:
    """The report of what silver holds; False when it holds no prices."""
    prices = materialised(read_table(spark, f"{silver}/price_history", PRICE_HISTORY).select("ticker", "date", "close", "volume"), "report-prices")
    if prices.isEmpty():
        return False
    technical = materialised(read_table(spark, f"{silver}/technical_indicators", TECHNICAL), "report-indicators")
    write_report(prices, technical, root)
    return True


def sections_of(spark: SparkSession, root: str, role: str) -> list[str]:
    """The sections that the stored entitlements give a role, in the report's order."""
    if role not in rp.ROLES:
        raise ValueError(f"unknown role {role!r}")
    allowed = commits.read(spark, f"{root}/entitlements", ENTITLEMENTS)
    # a fixed table of a dozen rows
    given = {r["section"] for r in allowed.where(allowed["role"] == role).collect()}
    return [section for section in SECTIONS if section in given]


def read_section(spark: SparkSession, root: str, section: str, role: str) -> DataFrame:
    """The rows of a section, for a role that may see them."""
    if section not in sections_of(spark, root, role):
        raise PermissionError(f"the role {role} does not see {section}")
    return commits.read(spark, f"{root}/{section}", SECTIONS[section])
