"""The data behind the report, statistics and clusters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.functions.names import column
from quotelake.functions.text import magnitude
from quotelake.operators import analytics, cleaning
from quotelake.operators import reports as rp
from quotelake.operators.indicators import compute_indicators
from quotelake.operators.sizing import materialised
from quotelake.operators.tables import technical_indicators
from quotelake.plans import reports as report_plan
from quotelake.plans import testbed as tb
from quotelake.plans.catalog.indicators import ALL, INDICATORS_SQL
from quotelake.plans.catalog.registry import query, rounded, rounded_as
from quotelake.session import work_folder

_W = "OVER (PARTITION BY ticker ORDER BY date)"
RETURNS = f"SELECT *, close / lag(close) {_W} - 1 AS ret FROM ({tb.BARS_TYPE})"
PEAKS = f"SELECT *, max(close) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak FROM ({RETURNS})"


def bars(spark, folder):
    """Bars written once, as most reports pass over them more than once."""
    return materialised(tb.bars_by_type(spark, folder), "bars")


@query(f"""SELECT ticker, count(close) AS count, {rounded_as(4, mean='avg(close)', std='stddev_samp(close)',
    min='min(close)', max='max(close)', p25='quantile_cont(close, 0.25)', p50='quantile_cont(close, 0.5)',
    p75='quantile_cont(close, 0.75)')} FROM ({tb.BARS_TYPE}) GROUP BY 1""", digits=4)
def describe_close(spark, folder):
    return analytics.describe_close(bars(spark, folder))


@query(f"SELECT ticker, date, close, {rounded('ret', 6)} AS ret FROM ({RETURNS})")
def daily_returns(spark, folder):
    out = analytics.with_returns(bars(spark, folder))
    return out.select("ticker", "date", "close", (F.rint(F.col("ret") * 1e6) / 1e6 + 0.0).alias("ret"))


@query(f"SELECT ticker, {rounded_as(6, volatility='stddev_samp(ret)')} FROM ({RETURNS}) GROUP BY 1", digits=6)
def return_volatility(spark, folder):
    return analytics.return_volatility(bars(spark, folder))


@query(f"SELECT ticker, {rounded_as(4, close='avg(close)', volume='avg(volume)')} FROM ({tb.BARS_TYPE}) GROUP BY 1", digits=4)
def feature_means(spark, folder):
    return analytics.feature_means(tb.bars_by_type(spark, folder))


_30 = "OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"


@query(f"""SELECT ticker, date, {rounded(f"CASE WHEN count(ret) {_30} = 30 THEN stddev_samp(ret) {_30} * sqrt(252) END")}
    AS volatility FROM ({RETURNS})""", digits=4)
def rolling_vol_30(spark, folder):
    return analytics.rolling_volatility(bars(spark, folder))


@query(f"SELECT ticker, date, {rounded(f'close / first(close) {_W} * 100')} AS indexed FROM ({tb.BARS_TYPE})", digits=4)
def normalised_performance(spark, folder):
    return rp.normalised_performance(bars(spark, folder))


_MONTHLY = f"""WITH b AS ({tb.BARS_TYPE}), m AS (SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS month FROM b),
    t AS (SELECT DISTINCT ticker FROM b),
    v AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, ticker, avg(volume) AS v FROM b GROUP BY 1, 2)
    SELECT m.month, t.ticker, {rounded('coalesce(v, 0)')} AS avg_volume
    FROM m CROSS JOIN t LEFT JOIN v ON v.month = m.month AND v.ticker = t.ticker"""


@query(_MONTHLY, digits=4)
def monthly_volume_pivot(spark, folder):
    """Months by tickers with zeros where a ticker did not trade, in long form."""
    return rp.monthly_volume_long(bars(spark, folder))


@query(_MONTHLY.replace("t.ticker,", "replace(t.ticker, ' ', '.') AS ticker,", 1), digits=4)
def monthly_volume_dotted(spark, folder):
    """The same for symbols with dots, as columns and back as rows."""
    dotted = bars(spark, folder).withColumn("ticker", F.replace("ticker", F.lit(" "), F.lit(".")))
    wide = rp.monthly_volume(dotted)
    cells = F.array(*[F.struct(F.lit(c).alias("ticker"), column(c).alias("avg_volume")) for c in wide.columns[1:]])
    return wide.select("month", F.inline(cells))


_SUMMARY = f"""SELECT ticker, min(date) AS first_date, max(date) AS last_date, count(*) AS days,
    arg_min(close, date) AS start_close, arg_max(close, date) AS end_close,
    arg_max(close, date) / arg_min(close, date) - 1 AS total_return, stddev_samp(ret) * sqrt(252) AS annual_volatility,
    min(close / peak - 1) AS max_drawdown, avg(volume) AS avg_volume FROM ({PEAKS}) GROUP BY 1"""
_NUMBERS = ("start_close", "end_close", "total_return", "annual_volatility", "max_drawdown", "avg_volume")


@query(f"SELECT ticker, first_date, last_date, days, {rounded_as(4, **{c: c for c in _NUMBERS})} FROM ({_SUMMARY})", digits=4)
def portfolio_summary(spark, folder):
    return rp.portfolio_summary(bars(spark, folder))


@query(f"""SELECT ticker AS "Ticker", strftime(first_date, '%Y-%m-%d') AS "From", strftime(last_date, '%Y-%m-%d') AS "To",
    days AS "Days", printf('%.2f', start_close) AS "Start ($)", printf('%.2f', end_close) AS "End ($)",
    printf('%.1f%%', total_return * 100) AS "Total Return", printf('%.1f%%', annual_volatility * 100) AS "Ann. Vol.",
    printf('%.1f%%', max_drawdown * 100) AS "Max Drawdown",
    format('{{:,}}', CAST(round_even(avg_volume, 0) AS BIGINT)) AS "Avg Volume" FROM ({_SUMMARY})""")
def summary_texts(spark, folder):
    return rp.summary_texts(rp.portfolio_summary(bars(spark, folder)))


@query(f"SELECT ticker, {rounded_as(6, max_drawdown='min(close / peak - 1)')} FROM ({PEAKS}) GROUP BY 1", digits=6)
def max_drawdown(spark, folder):
    return analytics.drawdowns(bars(spark, folder))


@query(f"SELECT ticker, date, close, peak FROM ({PEAKS})")
def running_peak(spark, folder):
    return analytics.with_running_peak(bars(spark, folder)).select("ticker", "date", "close", "peak")


@query(f"SELECT ticker, arg_min(close, date) AS first_close, arg_max(close, date) AS last_close FROM ({tb.BARS_TYPE}) GROUP BY 1")
def first_last_close(spark, folder):
    return tb.bars_by_type(spark, folder).groupBy("ticker").agg(
        F.min_by("close", "date").alias("first_close"), F.max_by("close", "date").alias("last_close")
    )


def _returns_sql(source: str) -> str:
    return f"""WITH b AS ({source}),
    d AS (SELECT date, lag(date) OVER (ORDER BY date) AS prior FROM (SELECT DISTINCT date FROM b)),
    r AS (SELECT b.ticker, b.date, b.close / p.close - 1 AS ret FROM b JOIN d ON b.date = d.date
          JOIN b p ON p.ticker = b.ticker AND p.date = d.prior),
    full_days AS (SELECT date FROM r GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT ticker) FROM b)),
    k AS (SELECT r.* FROM r JOIN full_days USING (date)),
    c AS (SELECT x.ticker AS a, y.ticker AS b, corr(x.ret, y.ret) AS corr FROM k x JOIN k y ON x.date = y.date GROUP BY 1, 2),
    t AS (SELECT DISTINCT ticker FROM b)
    SELECT x.ticker AS ticker_a, y.ticker AS ticker_b, {rounded('corr')} AS corr
    FROM t x CROSS JOIN t y LEFT JOIN c ON a = x.ticker AND c.b = y.ticker"""


@query(_returns_sql(tb.BARS_TYPE), digits=4)
def returns_correlation(spark, folder):
    return analytics.returns_correlation(bars(spark, folder))


@query(_returns_sql(tb.BARS_EVENT), digits=4)
def returns_correlation_events(spark, folder):
    return analytics.returns_correlation(materialised(tb.bars_by_event(spark, folder), "bars"))


_COLUMNS = analytics.INDICATOR_COLUMNS


@query(f"""WITH t AS (SELECT {', '.join(_COLUMNS)} FROM ({ALL}) WHERE {' AND '.join(c + ' IS NOT NULL' for c in _COLUMNS)})
    """ + " UNION ALL ".join(
        f"SELECT '{a}' AS indicator_a, '{b}' AS indicator_b, {rounded(f'corr({a}, {b})')} AS corr FROM t"
        for a in _COLUMNS for b in _COLUMNS), digits=4)
def indicator_correlation(spark, folder):
    clean = cleaning.within_fences(bars(spark, folder))
    return analytics.indicator_correlation(compute_indicators(clean, digits=None))


@query(f"SELECT ticker, date, close FROM ({tb.BARS_SUPPLIER})")
def closing_series(spark, folder):
    return rp.closing_series(tb.bars_by_supplier(spark, folder))


_SHOWN = {c: c for c in ("sma_20", "sma_50", "bb_upper", "bb_lower", "rsi", "macd")}


@query(f"""SELECT b.ticker, b.date, b.close, t.* EXCLUDE (ticker, date),
    CASE WHEN rsi >= 70 THEN 'overbought' WHEN rsi <= 30 THEN 'oversold' WHEN rsi IS NOT NULL THEN 'neutral' END AS rsi_zone,
    CASE WHEN macd >= 0 THEN 'positive' WHEN macd IS NOT NULL THEN 'negative' END AS macd_sign
    FROM ({tb.BARS_TYPE}) b LEFT JOIN (SELECT ticker, date, {rounded_as(2, **_SHOWN)} FROM ({ALL})) t
    ON b.ticker = t.ticker AND b.date = t.date""")
def indicator_panel(spark, folder):
    """All bars; those the fences removed have no indicators."""
    everything = bars(spark, folder)
    return rp.indicator_panel(everything, technical_indicators(compute_indicators(cleaning.within_fences(everything))))


def _sections(spark, folder):
    """A long report: the section and one value per row."""
    b = bars(spark, folder)
    tech = compute_indicators(b)
    price = b.select(F.lit("price_timeseries").alias("section"), "ticker", F.col("close").alias("value"))
    volume = b.select(F.lit("volume"), "ticker", F.col("volume").cast("double"))
    panel = tech.select(F.lit("technical_indicators"), "ticker", F.col("rsi"))
    return price.unionAll(volume).unionAll(panel)


_SECTIONS = f"""SELECT 'price_timeseries' AS section, ticker, close AS value FROM ({tb.BARS_TYPE})
    UNION ALL SELECT 'volume', ticker, CAST(volume AS DOUBLE) FROM ({tb.BARS_TYPE})
    UNION ALL SELECT 'technical_indicators', ticker, {rounded('rsi', 2)} FROM ({INDICATORS_SQL(tb.BARS_TYPE)})"""


@query(f"""SELECT section, ticker, role, CASE WHEN role = 'advanced' OR section <> 'technical_indicators'
    THEN 'visible' ELSE 'locked' END AS access, n AS rows
    FROM (SELECT section, ticker, count(*) AS n FROM ({_SECTIONS}) GROUP BY 1, 2), (VALUES ('basic'), ('advanced')) r(role)""")
def entitled_sections(spark, folder):
    """Rows per section and ticker, and whether each role sees them."""
    report = _sections(spark, folder)
    counts = report.groupBy("section", "ticker").agg(F.count(F.lit(1)).alias("rows"))
    return rp.section_access(counts, rp.permissions(report))


@query(f"SELECT section, ticker, {rounded('value')} AS value FROM ({_SECTIONS}) WHERE section <> 'technical_indicators'", digits=4)
def rows_a_basic_reader_sees(spark, folder):
    report = _sections(spark, folder)
    return rp.visible_rows(report, rp.permissions(report), "basic")


_BARS = f"(SELECT count(*) FROM ({tb.BARS_TYPE}))"
_NAMES = f"(SELECT count(DISTINCT ticker) FROM ({tb.BARS_TYPE}))"
_VIEW_ROWS = {
    "summary_table": _NAMES,
    "price_timeseries": _BARS,
    "normalized_performance": _BARS,
    "volume": f"(SELECT count(DISTINCT ticker) * count(DISTINCT date_trunc('month', date)) FROM ({tb.BARS_TYPE}))",
    "volatility": _BARS,
    "price_correlation": f"{_NAMES} * {_NAMES}",
    "indicator_correlation": str(len(_COLUMNS) ** 2),
    "technical_indicators": _BARS,
}


@query(" UNION ALL ".join(
    f"SELECT '{role}' AS role, '{section}' AS section, CAST({_VIEW_ROWS[section]} AS BIGINT) AS rows" for role, sections in rp.ROLES.items() for section in sections))
def report_written(spark, folder):
    """The report job: all sections as tables, counted through what each role may read."""
    root = work_folder(spark, "report")
    b = bars(spark, folder)
    report_plan.write_report(b, materialised(technical_indicators(compute_indicators(b)), "technical"), root)
    counts = [
        report_plan.read_section(spark, root, section, role).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(role).alias("role"), F.lit(section).alias("section"), "rows")
        for role in rp.ROLES
        for section in report_plan.sections_of(spark, root, role)
    ]
    return reduce(DataFrame.unionAll, counts)


@query("""SELECT o_orderkey, CASE WHEN x >= 1e9 THEN printf('%.1fB', x / 1e9) WHEN x >= 1e6 THEN printf('%.0fM', x / 1e6)
    WHEN x >= 1e3 THEN printf('%.0fK', x / 1e3) ELSE printf('%.0f', x) END AS shown
    FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_totalprice * 10007 WHEN 'O' THEN o_totalprice * 103
          ELSE o_totalprice END AS x FROM orders)""")
def magnitude_texts(spark, folder):
    price = F.col("o_totalprice")
    status = F.col("o_orderstatus")
    x = F.when(status == "F", price * 10007).when(status == "O", price * 103).otherwise(price)
    return tb.table(spark, folder, "orders").select("o_orderkey", magnitude(x).alias("shown"))


@query()
def kmeans_tickers(spark, folder):
    """Three clusters of suppliers by mean close and volume; labels carry no order."""
    return analytics.cluster_tickers(materialised(tb.bars_by_supplier(spark, folder), "bars"))


_GROUP = "CAST(regexp_extract(ticker, '[0-9]+$') AS BIGINT) % 3"


@query(f"SELECT DISTINCT ticker, {_GROUP} AS cluster FROM ({tb.BARS_SUPPLIER})")
def kmeans_of_separate_groups(spark, folder):
    """Suppliers in three price levels far apart; clusters numbered by the order of their centres."""
    level = F.regexp_extract("ticker", "[0-9]+$", 0).cast("bigint") % 3
    apart = tb.bars_by_supplier(spark, folder).withColumn("close", F.col("close") + level * 1e7)
    clustered = materialised(analytics.cluster_tickers(materialised(apart, "bars")), "clusters")
    centres = analytics.cluster_centres(clustered)
    ranked = centres.select("cluster", (F.row_number().over(Window.orderBy("close")) - 1).cast("bigint").alias("rank"))
    return clustered.join(ranked, "cluster").select("ticker", F.col("rank").alias("cluster"))
