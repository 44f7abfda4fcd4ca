"""Cleaning rules, deduplication and the silver projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelake.functions.dates import to_utc
from quotelake.functions.numeric import blank_non_finite
from quotelake.operators import cleaning, dedup, tables
from quotelake.operators.indicators import compute_indicators
from quotelake.operators.sizing import materialised
from quotelake.plans import testbed as tb
from quotelake.plans.catalog.registry import query, rounded_as
from quotelake.plans.catalog.indicators import INDICATORS_SQL
from quotelake.sources.files import union_by_name

NUMBER = "CASE WHEN NOT isnan(TRY_CAST({c} AS DOUBLE)) THEN TRY_CAST({c} AS DOUBLE) END AS {c}"
NUMBERS = ", ".join(NUMBER.format(c=c) for c in ("open", "high", "low", "close", "volume"))
COERCED = f"SELECT ticker, TRY_CAST(date AS DATE) AS date, {NUMBERS}, extraction_timestamp FROM ({tb.DIRTY})"
PRESENT = f"SELECT * FROM ({COERCED}) WHERE close IS NOT NULL AND date IS NOT NULL"
PLAUSIBLE = "high >= low AND high >= open AND high >= close AND low <= open AND low <= close"
BAR = "ticker, date, open, high, low, close, volume"
ARRIVAL = ("extraction_timestamp", "open", "high", "low", "close", "volume")
FIRST_COPY = ", ".join(f"{c} ASC NULLS FIRST" for c in ARRIVAL)
LAST_COPY = ", ".join(f"{c} DESC NULLS LAST" for c in ARRIVAL)
DEDUPED = f"""SELECT * FROM ({PRESENT})
    QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY {FIRST_COPY}) = 1"""


def fenced(source: str, by: str = "") -> str:
    group, same = (f"GROUP BY {by}", f"b.{by} = f.{by}") if by else ("", "TRUE")
    pick = f"{by}," if by else ""
    return f"""WITH b AS ({source}),
    q AS (SELECT {pick} quantile_cont(close, 0.25) AS q1, quantile_cont(close, 0.75) AS q3 FROM b {group}),
    f AS (SELECT {pick} q1 - 3 * (q3 - q1) AS lo, q3 + 3 * (q3 - q1) AS hi FROM q)
    SELECT b.* FROM b JOIN f ON {same} WHERE close BETWEEN lo AND hi"""


CLEAN_BARS = fenced(tb.BARS_TYPE)


def typed(spark, folder):
    return cleaning.coerce_types(tb.dirty_bars(spark, folder)).withColumn("date", F.to_date("date"))


def stored_bars(spark, folder):
    """Bars written once, for queries that pass over them more than once."""
    return materialised(tb.bars_by_type(spark, folder), "bars")


def clean_bars(spark, folder):
    return cleaning.within_fences(stored_bars(spark, folder))


@query(tb.BARS_TYPE)
def daily_bars(spark, folder):
    return tb.bars_by_type(spark, folder)


@query(COERCED)
def coerce_types(spark, folder):
    return typed(spark, folder).toDF("ticker", "date", "open", "high", "low", "close", "volume", "extraction_timestamp")


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL
                 ELSE date_trunc('second', ts) + INTERVAL 4 HOUR END AS utc,
          CASE WHEN event_id % 5 = 0 THEN NULL
               ELSE date_trunc('second', ts) + INTERVAL 13 HOUR END AS tokyo FROM events""")
def utc_timestamps(spark, folder):
    """Text with a UTC offset to UTC; unreadable text to NULL; the wall clock of an exchange on request."""
    text = F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss'-04:00'"))
    events = tb.table(spark, folder, "events").select("event_id", text.alias("t"))
    local = to_utc(F.col("t"), "Asia/Tokyo")
    return events.select("event_id", to_utc(F.col("t")).alias("utc"), local.alias("tokyo"))


@query(PRESENT)
def drop_null_keys(spark, folder):
    return cleaning.drop_missing(typed(spark, folder)).toDF(
        "ticker", "date", "open", "high", "low", "close", "volume", "extraction_timestamp"
    )


@query(f"SELECT {BAR} FROM ({COERCED}) WHERE {PLAUSIBLE}")
def ohlc_filter(spark, folder):
    return cleaning.plausible_bars(typed(spark, folder)).select(*[F.col(c).alias(c) for c in BAR.split(", ")])


@query(CLEAN_BARS)
def iqr_filter_global(spark, folder):
    return clean_bars(spark, folder)


@query(fenced(tb.BARS_TYPE, "ticker"))
def iqr_filter_by_ticker(spark, folder):
    return cleaning.within_fences(stored_bars(spark, folder), ["ticker"])


@query(
    f"""SELECT ticker, {rounded_as(4, p05='quantile_cont(close, 0.05)', p50='quantile_cont(close, 0.5)',
                                   p95='quantile_cont(close, 0.95)')} FROM ({tb.BARS_TYPE}) GROUP BY 1""",
    digits=4,
)
def quantiles_by_ticker(spark, folder):
    bars = stored_bars(spark, folder)
    return cleaning.exact_quantiles(bars, "close", {"p05": 0.05, "p50": 0.5, "p95": 0.95}, ["ticker"])


@query(f"SELECT {rounded_as(4, q1='quantile_cont(l_extendedprice, 0.25)', q3='quantile_cont(l_extendedprice, 0.75)')} FROM lineitem", digits=4)
def quantiles_of_all_trades(spark, folder):
    """Exact quartiles over every trade, not only over bars."""
    lines = tb.table(spark, folder, "lineitem")
    return cleaning.exact_quantiles(lines, "l_extendedprice", {"q1": 0.25, "q3": 0.75})


@query(f"SELECT {BAR} FROM ({DEDUPED})")
def dedup_first(spark, folder):
    rows = cleaning.drop_missing(typed(spark, folder))
    return dedup.keep_first(rows, ["ticker", "date"], ARRIVAL).select(*[F.col(c).alias(c) for c in BAR.split(", ")])


@query(f"""SELECT {BAR} FROM ({PRESENT})
    QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY {LAST_COPY}) = 1""")
def dedup_last(spark, folder):
    rows = cleaning.drop_missing(typed(spark, folder))
    return dedup.keep_last(rows, ["ticker", "date"], ARRIVAL).select(*[F.col(c).alias(c) for c in BAR.split(", ")])


@query(f"SELECT ticker, CAST(count(*) - count(DISTINCT date) AS BIGINT) AS removed FROM ({PRESENT}) GROUP BY 1")
def duplicates_removed(spark, folder):
    rows = cleaning.drop_missing(typed(spark, folder))
    return dedup.duplicate_counts(rows, ["ticker", "date"], ["ticker"])


@query(f"SELECT {BAR} FROM ({fenced(f'SELECT * FROM ({DEDUPED}) WHERE {PLAUSIBLE}')})")
def clean_prices(spark, folder):
    """All cleaning steps in order."""
    clean = cleaning.clean_prices(tb.dirty_bars(spark, folder), store=materialised).withColumn("date", F.to_date("date"))
    return clean.select(*[F.col(c).alias(c) for c in BAR.split(", ")])


@query("""SELECT event_id, CASE WHEN event_id % 7 < 3 THEN NULL ELSE value END AS value,
          CAST(event_id % 7 AS BIGINT) AS kind FROM events""")
def nan_inf_to_null(spark, folder):
    kind = F.col("event_id") % 7
    damaged = (
        F.when(kind == 0, F.lit(float("nan")))
        .when(kind == 1, F.lit(float("inf")))
        .when(kind == 2, F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    return blank_non_finite(
        tb.table(spark, folder, "events").select("event_id", damaged.alias("value"), kind.alias("kind"))
    )


@query(f"""SELECT ticker, date, CAST(year(date) AS INTEGER) AS year,
           {rounded_as(2, open='open', high='high', low='low', close='close')}, volume,
           {rounded_as(2, adj_close='close')} FROM ({CLEAN_BARS})""")
def price_history(spark, folder):
    return tables.price_history(clean_bars(spark, folder))


@query(tb.MASTER.replace("SELECT", "SELECT DISTINCT", 1))
def stocks_master(spark, folder):
    info = tb.company_info(spark, folder)
    return tables.stocks_master(info.unionAll(info))


@query(f"""SELECT ticker, date, CAST(year(date) AS INTEGER) AS year,
           {rounded_as(2, **{c: c for c in ('sma_20', 'sma_50', 'atr', 'rsi', 'macd', 'bb_upper', 'bb_lower')})}
           FROM ({INDICATORS_SQL(CLEAN_BARS)})""")
def technical_projection(spark, folder):
    return tables.technical_indicators(compute_indicators(clean_bars(spark, folder)))


@query("""SELECT s_name AS name, 'supplier' AS kind, CAST(s_acctbal AS VARCHAR) AS balance, NULL AS segment FROM supplier
          UNION ALL SELECT c_name, 'customer', CAST(c_custkey AS VARCHAR), c_mktsegment FROM customer""")
def union_with_drift(spark, folder):
    """Union by name where one side lacks a column and a shared column changes its type."""
    suppliers = tb.table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance")
    )
    customers = tb.table(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("segment"),
        F.col("c_custkey").alias("balance"),
        F.lit("customer").alias("kind"),
        F.col("c_name").alias("name"),
    )
    return union_by_name([suppliers, customers])


@query("""SELECT CAST(s_nationkey AS BIGINT) AS nation, s_name AS name FROM supplier
          UNION ALL SELECT CAST(c_nationkey AS BIGINT), c_name FROM customer""")
def shared_columns(spark, folder):
    """Only the columns both frames have, in the order of the second."""
    left = tb.table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").cast("bigint").alias("nation"), "s_acctbal"
    )
    right = tb.table(spark, folder, "customer").select(
        F.col("c_nationkey").cast("bigint").alias("nation"), F.col("c_name").alias("name"), "c_mktsegment"
    )
    a, b = dedup.same_columns(left, right)
    return a.unionByName(b)
