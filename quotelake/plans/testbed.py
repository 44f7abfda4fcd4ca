"""Domain inputs derived from the TPC-H-like tables, with the same derivations in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


TRADE_ORDER = ("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")


def _price(trade: Column) -> Column:
    return trade["l_extendedprice"] / trade["l_quantity"]


def _daily(trades: DataFrame, ticker: str) -> DataFrame:
    """Trades to one bar a day; open and close are the first and last trade in the trade order.

    Trades that tie on the whole order have the same price, so the bars do not depend on row order.
    """
    trade = F.struct(*TRADE_ORDER)
    price = _price(trade)
    return trades.groupBy(F.col(ticker).alias("ticker"), F.to_date("l_shipdate").alias("date")).agg(
        _price(F.min(trade)).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        _price(F.max(trade)).alias("close"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
    )


def bars_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars with the part type as the ticker."""
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    lines = table(spark, folder, "lineitem").select(*TRADE_ORDER, "l_partkey", "l_shipdate")
    return _daily(lines.join(parts, "l_partkey"), "p_type")


def bars_by_supplier(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars with the supplier name as the ticker."""
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    lines = table(spark, folder, "lineitem").select(*TRADE_ORDER, "l_suppkey", "l_shipdate")
    return _daily(lines.join(suppliers, "l_suppkey"), "s_name")


def bars_by_event(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars with the event type as the ticker and the event value as the price."""
    price = F.col("value")
    return (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("ticker"), F.to_date("ts").alias("date"))
        .agg(
            F.min_by(price, F.struct("ts", "event_id")).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, F.struct("ts", "event_id")).alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )


def company_info(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as companies: region as sector, nation as industry."""
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    regions = table(spark, folder, "region").select("r_regionkey", "r_name")
    return (
        table(spark, folder, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_name").alias("ticker"),
            F.col("s_name").alias("longName"),
            F.col("r_name").alias("sector"),
            F.col("n_name").alias("industry"),
        )
    )


def master(spark: SparkSession, folder: str) -> DataFrame:
    return company_info(spark, folder).withColumnRenamed("longName", "company_name")


def dirty_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Type bars as text with repeatable damage: unreadable and missing values, swapped high and low, and a
    later, slightly different copy of some bars."""
    day = F.datediff("date", F.lit("1970-01-01").cast("date"))
    bars = bars_by_type(spark, folder).withColumn("n", day + F.length("ticker"))
    n = F.col("n")
    swapped = n % 11 == 0
    text = bars.select(
        "ticker",
        F.when(n % 29 == 0, F.lit("not a date")).otherwise(F.date_format("date", "yyyy-MM-dd")).alias("Date"),
        F.col("open").cast("string").alias("Open"),
        F.when(swapped, F.col("low")).otherwise(F.col("high")).cast("string").alias("High"),
        F.when(swapped, F.col("high")).otherwise(F.col("low")).cast("string").alias("Low"),
        F.when(n % 13 == 0, F.lit("bad"))
        .when(n % 17 == 0, F.lit("NaN"))
        .when(n % 19 == 0, F.lit("1.0d"))
        .when(n % 23 != 0, F.col("close").cast("string"))
        .alias("Close"),
        F.when(n % 31 == 0, F.lit(" 7 ")).otherwise(F.col("volume").cast("string")).alias("Volume"),
        F.lit("2024-01-01T00:00:00").alias("extraction_timestamp"),
        "n",
    )
    copies = text.where(n % 7 == 0).withColumns({
        "Close": F.col("Open"),
        "extraction_timestamp": F.lit("2024-01-02T00:00:00"),
    })
    return text.unionByName(copies).drop("n")


_TRADE_ROW = "(l_orderkey, l_linenumber, l_extendedprice, l_quantity)"


def _daily_sql(ticker: str, join: str) -> str:
    return f"""
    SELECT {ticker} AS ticker, CAST(l_shipdate AS DATE) AS date,
           arg_min(l_extendedprice / l_quantity, {_TRADE_ROW}) AS open,
           max(l_extendedprice / l_quantity) AS high,
           min(l_extendedprice / l_quantity) AS low,
           arg_max(l_extendedprice / l_quantity, {_TRADE_ROW}) AS close,
           CAST(sum(l_quantity) AS BIGINT) AS volume
    FROM lineitem {join} GROUP BY 1, 2"""


BARS_TYPE = _daily_sql("p_type", "JOIN part ON l_partkey = p_partkey")
BARS_SUPPLIER = _daily_sql("s_name", "JOIN supplier ON l_suppkey = s_suppkey")
BARS_EVENT = """
    SELECT event_type AS ticker, CAST(ts AS DATE) AS date,
           arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
           arg_max(value, (ts, event_id)) AS close, count(*) AS volume
    FROM events GROUP BY 1, 2"""
MASTER = """
    SELECT s_name AS ticker, s_name AS company_name, r_name AS sector, n_name AS industry
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
DIRTY = f"""
    WITH b AS (SELECT *, date_diff('day', DATE '1970-01-01', date) + length(ticker) AS n FROM ({BARS_TYPE})),
    t AS (
      SELECT ticker,
             CASE WHEN n % 29 = 0 THEN 'not a date' ELSE strftime(date, '%Y-%m-%d') END AS date,
             CAST(open AS VARCHAR) AS open,
             CAST(CASE WHEN n % 11 = 0 THEN low ELSE high END AS VARCHAR) AS high,
             CAST(CASE WHEN n % 11 = 0 THEN high ELSE low END AS VARCHAR) AS low,
             CASE WHEN n % 13 = 0 THEN 'bad' WHEN n % 17 = 0 THEN 'NaN' WHEN n % 19 = 0 THEN '1.0d'
                  WHEN n % 23 <> 0 THEN CAST(close AS VARCHAR) END AS close,
             CASE WHEN n % 31 = 0 THEN ' 7 ' ELSE CAST(volume AS VARCHAR) END AS volume,
             '2024-01-01T00:00:00' AS extraction_timestamp, n
      FROM b)
    SELECT * EXCLUDE (n) FROM t
    UNION ALL BY NAME
    SELECT * EXCLUDE (n) REPLACE (open AS close, '2024-01-02T00:00:00' AS extraction_timestamp) FROM t WHERE n % 7 = 0"""
