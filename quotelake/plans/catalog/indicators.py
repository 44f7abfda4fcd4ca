"""Technical indicators."""

from __future__ import annotations

from quotelake.operators import cleaning
from quotelake.operators.indicators import compute_indicators, with_signals
from quotelake.operators.sizing import materialised
from quotelake.plans import testbed as tb
from quotelake.plans.catalog.registry import query, rounded_as

_W = "OVER (PARTITION BY ticker ORDER BY date)"


def _frame(n: int) -> str:
    return f"OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def rolling_sql(function: str, value: str, n: int) -> str:
    return f"CASE WHEN count({value}) {_frame(n)} = {n} THEN {function}({value}) {_frame(n)} END"


def ewm_sql(source: str) -> str:
    """Weighted sums over the last 500 rows; older weights are below 1e-16."""
    decay = {12: 1 - 2 / 13, 26: 1 - 2 / 27}
    means = ", ".join(
        f"sum(b.close * power({d!r}, a.i - b.i)) / sum(power({d!r}, a.i - b.i)) AS ema_{s}" for s, d in decay.items()
    )
    return f"""SELECT a.ticker, a.date, {means}
        FROM (SELECT ticker, date, close, row_number() {_W} AS i FROM ({source})) a
        JOIN (SELECT ticker, close, row_number() {_W} AS i FROM ({source})) b
          ON a.ticker = b.ticker AND b.i BETWEEN a.i - 500 AND a.i
        GROUP BY 1, 2"""


def INDICATORS_SQL(source: str) -> str:
    """Every indicator at full precision."""
    return f"""
    WITH bars AS ({source}),
    d AS (SELECT *, high - low AS tr, close - lag(close) {_W} AS diff FROM bars),
    g AS (SELECT *, CASE WHEN diff > 0 THEN diff WHEN diff IS NOT NULL THEN 0.0 END AS gain,
                 CASE WHEN diff < 0 THEN -diff WHEN diff IS NOT NULL THEN 0.0 END AS loss FROM d),
    r AS (SELECT *, {rolling_sql('avg', 'close', 20)} AS sma_20, {rolling_sql('avg', 'close', 50)} AS sma_50,
                 {rolling_sql('stddev_samp', 'close', 20)} AS std_20, {rolling_sql('avg', 'tr', 14)} AS atr,
                 {rolling_sql('avg', 'gain', 14)} AS avg_gain, {rolling_sql('avg', 'loss', 14)} AS avg_loss FROM g),
    e AS ({ewm_sql('SELECT * FROM bars')})
    SELECT r.*, e.ema_12, e.ema_26, e.ema_12 - e.ema_26 AS macd,
           coalesce(100 - 100 / (1 + avg_gain / nullif(avg_loss, 0)), 50) AS rsi,
           sma_20 + 2 * std_20 AS bb_upper, sma_20 - 2 * std_20 AS bb_lower
    FROM r JOIN e ON r.ticker = e.ticker AND r.date = e.date"""


def fenced_bars(source: str = tb.BARS_TYPE) -> str:
    return f"""WITH p AS ({source}),
    q AS (SELECT quantile_cont(close, 0.25) AS q1, quantile_cont(close, 0.75) AS q3 FROM p)
    SELECT p.* FROM p, q WHERE close BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1)"""


ALL = INDICATORS_SQL(fenced_bars())


def _pick(*names: str) -> str:
    return f"SELECT ticker, date, {rounded_as(4, **{n: n for n in names})} FROM ({ALL})"


def clean_bars(spark, folder):
    """Bars inside the fences. The bars are written once, as both steps pass over them repeatedly."""
    return cleaning.within_fences(materialised(tb.bars_by_type(spark, folder), "bars"))


def indicators(spark, folder, *names):
    return compute_indicators(clean_bars(spark, folder), digits=None, details=True).select("ticker", "date", *names)


@query(_pick("sma_20", "sma_50"), digits=4)
def sma(spark, folder):
    return indicators(spark, folder, "sma_20", "sma_50")


@query(_pick("diff", "gain", "loss"), digits=4)
def diff_gain_loss(spark, folder):
    return indicators(spark, folder, "diff", "gain", "loss")


@query(_pick("rsi"), digits=4)
def rsi(spark, folder):
    return indicators(spark, folder, "rsi")


@query(_pick("ema_12", "ema_26"), digits=4)
def ema(spark, folder):
    return indicators(spark, folder, "ema_12", "ema_26")


@query(_pick("macd"), digits=4)
def macd(spark, folder):
    return indicators(spark, folder, "macd")


@query(_pick("bb_upper", "bb_lower"), digits=4)
def bollinger(spark, folder):
    return indicators(spark, folder, "bb_upper", "bb_lower")


@query(_pick("tr", "atr"), digits=4)
def atr(spark, folder):
    return indicators(spark, folder, "tr", "atr")


_ROUNDED = {
    c: c
    for c in ("open", "high", "low", "close", "tr", "sma_20", "sma_50", "atr", "rsi", "macd", "bb_upper", "bb_lower")
}


@query(f"SELECT ticker, date, volume, {rounded_as(2, **_ROUNDED)} FROM ({ALL})")
def indicators_full(spark, folder):
    """The whole set at two decimals, as the silver table stores it."""
    return compute_indicators(clean_bars(spark, folder))


@query(f"""SELECT ticker, date,
           CASE WHEN rsi >= 70 THEN 'overbought' WHEN rsi <= 30 THEN 'oversold' ELSE 'neutral' END AS rsi_zone,
           CASE WHEN macd >= 0 THEN 'positive' ELSE 'negative' END AS macd_sign
           FROM (SELECT ticker, date, {rounded_as(2, rsi='rsi', macd='macd')} FROM ({ALL}))""")
def rsi_zone_macd_sign(spark, folder):
    return with_signals(compute_indicators(clean_bars(spark, folder))).select("ticker", "date", "rsi_zone", "macd_sign")
