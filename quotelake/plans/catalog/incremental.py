"""Watermarks, look-back and merges of a batch into a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators import history, merge, state
from quotelake.operators.sizing import materialised
from quotelake.operators.tables import price_history, technical_indicators
from quotelake.plans import testbed as tb
from quotelake.plans.catalog.indicators import INDICATORS_SQL, fenced_bars
from quotelake.plans.catalog.registry import query, rounded, rounded_as
from quotelake.plans.bronze import land_prices, land_snapshot
from quotelake.plans.silver import refresh_silver, run_silver
from quotelake.schemas import BRONZE_PRICES, PRICE_HISTORY, STOCKS_MASTER, TECHNICAL
from quotelake.session import work_folder
from quotelake.sources import commits, control
from quotelake.sources.files import newest_file_time, read_table, scan_new_files
from quotelake.sources.paths import listing, literal, set_modified
from quotelake.sources.sinks import upsert_partitioned, write_partitioned
from quotelake.streaming.silver_stream import stream_silver

# Where the stored history ends and where the batch begins; they overlap by a month.
STORED_TO, BATCH_FROM = "2000-07-01", "2000-06-01"
STORED_SQL = f"SELECT * FROM ({tb.BARS_TYPE}) WHERE date < DATE '{STORED_TO}'"
# Corrected prices for two thirds of the tickers.
BATCH_SQL = f"""SELECT * REPLACE (close + 1 AS close) FROM ({tb.BARS_TYPE})
    WHERE date >= DATE '{BATCH_FROM}' AND length(ticker) <> 5"""


def stored(bars):
    return bars.where(F.col("date") < F.lit(STORED_TO).cast("date"))


def arriving(bars):
    fresh = bars.where((F.length("ticker") != 5) & (F.col("date") >= F.lit(BATCH_FROM).cast("date")))
    return fresh.withColumn("close", F.col("close") + 1)


def both(spark, folder):
    """The stored table and the batch, from bars written once."""
    bars = materialised(tb.bars_by_type(spark, folder), "bars")
    return stored(bars), arriving(bars)


@query(f"SELECT * FROM ({tb.BARS_TYPE}) WHERE date > DATE '{STORED_TO}'")
def highwater_filter(spark, folder):
    return history.after_watermark(tb.bars_by_type(spark, folder), F.lit(STORED_TO).cast("date"))


@query(f"""WITH m AS (SELECT ticker, max(date) AS last_date FROM ({STORED_SQL}) WHERE length(ticker) <> 5 GROUP BY 1)
    SELECT b.* FROM ({tb.BARS_TYPE}) b LEFT JOIN m ON b.ticker = m.ticker
    WHERE last_date IS NULL OR date > last_date""")
def highwater_by_ticker(spark, folder):
    """Tickers without a watermark keep their whole history."""
    bars = materialised(tb.bars_by_type(spark, folder), "bars")
    known = stored(bars).where(F.length("ticker") != 5)
    marks = known.groupBy("ticker").agg(F.max("date").alias("last_date"))
    return history.after_ticker_watermarks(bars, marks)


@query(f"SELECT greatest(max(date), DATE '{BATCH_FROM}') AS last_date FROM ({STORED_SQL})")
def watermark_next(spark, folder):
    return history.next_watermark(stored(tb.bars_by_type(spark, folder)), F.lit(BATCH_FROM).cast("date"))


@query(f"""SELECT ticker, max(date) AS last_date FROM
    (SELECT ticker, date FROM ({STORED_SQL}) UNION ALL SELECT ticker, date FROM ({BATCH_SQL})) GROUP BY 1""")
def watermarks_by_ticker(spark, folder):
    table, batch = both(spark, folder)
    marks = table.groupBy("ticker").agg(F.max("date").alias("last_date"))
    return history.next_ticker_watermarks(batch, marks)


LOOKBACK_SQL = f"""SELECT h.* FROM ({STORED_SQL}) h
    JOIN (SELECT ticker, min(date) AS first FROM ({BATCH_SQL}) GROUP BY 1) f ON h.ticker = f.ticker AND date < first
    QUALIFY row_number() OVER (PARTITION BY h.ticker ORDER BY date DESC) <= 60"""


@query(LOOKBACK_SQL)
def lookback_tail(spark, folder):
    return history.lookback(*both(spark, folder))


@query(f"""SELECT * FROM ({tb.BARS_TYPE})
    QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 5""")
def tail_rows(spark, folder):
    return history.tail_rows(tb.bars_by_type(spark, folder), 5)


@query(f"""SELECT s.* FROM ({STORED_SQL}) s
    WHERE EXISTS (SELECT 1 FROM ({BATCH_SQL}) b WHERE b.ticker = s.ticker AND b.date = s.date)""")
def batch_dates_semi(spark, folder):
    return history.in_batch(*both(spark, folder))


_RUNUP = f"""SELECT ticker, date, open, high, low, close, volume FROM ({LOOKBACK_SQL})
    UNION ALL SELECT ticker, date, open, high, low, close, volume FROM ({BATCH_SQL})"""
_INDICATORS = {c: c for c in ("sma_20", "sma_50", "atr", "rsi", "macd", "bb_upper", "bb_lower")}


@query(f"""SELECT ticker, date, {rounded_as(4, **_INDICATORS)} FROM ({INDICATORS_SQL(_RUNUP)})
    WHERE date >= DATE '{BATCH_FROM}'""", digits=4)
def incremental_indicators(spark, folder):
    done = history.incremental_indicators(*both(spark, folder), digits=None)
    return done.select("ticker", "date", *_INDICATORS)


UPSERT_SQL = f"""SELECT ticker, date, open, high, low, close, volume FROM (
      SELECT *, 0 AS p FROM ({STORED_SQL}) UNION ALL SELECT *, 1 AS p FROM ({BATCH_SQL}))
    QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY p DESC) = 1"""


@query(UPSERT_SQL)
def upsert_keep_last(spark, folder):
    return merge.upsert(*both(spark, folder), ["ticker", "date"], ["close"])


@query(f"""SELECT ticker, date, CAST(year(date) AS INTEGER) AS year,
    {rounded_as(2, open='open', high='high', low='low', close='close')}, volume, {rounded_as(2, adj_close='close')}
    FROM ({UPSERT_SQL})""")
def upsert_partitions(spark, folder):
    """The same upsert through stored (ticker, year) folders, of which only the touched ones are rewritten."""
    path = work_folder(spark, "upsert")
    table, batch = both(spark, folder)
    write_partitioned(price_history(table), path, PRICE_HISTORY)
    upsert_partitioned(price_history(batch), path, PRICE_HISTORY, ["ticker", "date"], ["close"])
    return read_table(spark, path, PRICE_HISTORY).withColumn("date", F.to_date("date"))


@query(f"""SELECT * FROM ({STORED_SQL}) WHERE date NOT IN (SELECT date FROM ({BATCH_SQL}))
    UNION ALL SELECT * FROM ({BATCH_SQL})""")
def slice_replace(spark, folder):
    """Whole dates are replaced, so tickers the batch lacks leave the touched dates."""
    return merge.replace_slices(*both(spark, folder), ["date"])


@query(f"""SELECT * FROM ({STORED_SQL}) s
    WHERE NOT EXISTS (SELECT 1 FROM ({BATCH_SQL}) b WHERE b.date = s.date AND b.ticker = s.ticker)
    UNION ALL SELECT * FROM ({BATCH_SQL})""")
def slice_replace_by_ticker(spark, folder):
    return merge.replace_slices(*both(spark, folder), ["date", "ticker"])


_MEMBERS = "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer"


def members(spark, folder):
    return tb.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


def _merged(spark, folder, update):
    known = members(spark, folder).where(F.col("id") % 3 != 0)
    given = members(spark, folder).where(F.col("id") % 2 == 0).select(
        "id", F.upper("name").alias("name"), F.lit("NEW").alias("segment")
    )
    return merge.merge_dimension(known, given, ["id"], ["name"], update)


@query(f"""SELECT id, CASE WHEN id % 2 = 0 THEN upper(name) ELSE name END AS name,
    CASE WHEN id % 2 = 0 THEN 'NEW' ELSE segment END AS segment,
    CASE WHEN id % 3 <> 0 THEN balance END AS balance FROM ({_MEMBERS}) WHERE id % 3 <> 0 OR id % 2 = 0""")
def merge_dimension(spark, folder):
    """Matched members take every column of the batch; new ones lack what the batch lacks."""
    return _merged(spark, folder, None)


@query(f"""SELECT id, CASE WHEN id % 2 = 0 THEN upper(name) ELSE name END AS name,
    CASE WHEN id % 2 = 0 AND id % 3 = 0 THEN 'NEW' ELSE segment END AS segment,
    CASE WHEN id % 3 <> 0 THEN balance END AS balance FROM ({_MEMBERS}) WHERE id % 3 <> 0 OR id % 2 = 0""")
def merge_dimension_some_columns(spark, folder):
    """Only the name of matched members changes."""
    return _merged(spark, folder, ["name"])


def _landed(spark, folder):
    """Bars as landed price files."""
    path = work_folder(spark, "landing")
    bars = tb.bars_by_type(spark, folder).select(
        F.col("date").cast("timestamp").alias("Date"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        F.col("volume").alias("Volume"),
        "ticker",
        F.lit("2024-01-01T00:00:00").alias("extraction_timestamp"),
    )
    bars.write.parquet(path)
    return path


_SILVER_SQL = f"""SELECT ticker, date, CAST(year(date) AS INTEGER) AS year, {rounded_as(2, **_INDICATORS)}
    FROM ({INDICATORS_SQL(fenced_bars())})"""


@query(f"SELECT * FROM ({tb.BARS_TYPE})")
def new_files_scan(spark, folder):
    """Files written after a moment: all of them after the epoch, none after the newest."""
    path = _landed(spark, folder)
    newest = newest_file_time(spark.read.schema(BRONZE_PRICES).parquet(path))
    fresh = scan_new_files(spark, path, "*.parquet", BRONZE_PRICES, "1970-01-01 00:00:00")
    none = scan_new_files(spark, path, "*.parquet", BRONZE_PRICES, newest)
    return fresh.unionAll(none).select(
        "ticker",
        F.to_date("Date").alias("date"),
        *[F.col(c).alias(c) for c in ("open", "high", "low", "close", "volume")],
    )


@query(_SILVER_SQL)
def silver_refresh(spark, folder):
    """The whole batch job on stored tables, then the indicator table read back."""
    bronze = spark.read.schema(BRONZE_PRICES).parquet(_landed(spark, folder))
    root = work_folder(spark, "silver")
    refresh_silver(bronze, None, root)
    return read_table(spark, f"{root}/technical_indicators", TECHNICAL).withColumn("date", F.to_date("date"))


@query(_SILVER_SQL)
def stream_available_now(spark, folder):
    """The same hop as a file stream that takes what has landed and stops."""
    landing, root = _landed(spark, folder), work_folder(spark, "silver")
    stream_silver(spark, landing, root, work_folder(spark, "checkpoint")).awaitTermination()
    return read_table(spark, f"{root}/technical_indicators", TECHNICAL).withColumn("date", F.to_date("date"))


_SECOND_FROM = "2001-01-01"
_PERIODS = [f"SELECT * FROM ({tb.BARS_TYPE}) WHERE date {sign} DATE '{_SECOND_FROM}'" for sign in ("<", ">=")]


@query(" UNION ALL ".join(f"SELECT ticker, date, {rounded('close', 2)} AS close FROM ({fenced_bars(sql)})" for sql in _PERIODS))
def silver_second_run(spark, folder):
    """Two landings with a silver run after each; the second run takes what landed last and keeps the rest."""
    bronze, silver = work_folder(spark, "bronze"), work_folder(spark, "silver")
    bars = spark.read.schema(BRONZE_PRICES).parquet(_landed(spark, folder)).drop("extraction_timestamp")
    for period in (F.col("Date") < _SECOND_FROM, F.col("Date") >= _SECOND_FROM):
        land_prices(bars.where(period), bronze)
        run_silver(spark, bronze, silver)
    return read_table(spark, f"{silver}/price_history", PRICE_HISTORY).select("ticker", F.to_date("date").alias("date"), "close")


_MOVED = "CAST(regexp_extract(s_name, '[0-9]+$') AS BIGINT) % 3 = 0"


@query(f"""SELECT s_name AS ticker, CASE WHEN {_MOVED} THEN 'A ' || s_name ELSE s_name END AS company_name,
    CASE WHEN {_MOVED} THEN 'APPS' ELSE r_name END AS sector, n_name AS industry
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def master_latest_wins(spark, folder):
    """Company attributes that change between two landings: the row extracted last stands, whatever its text."""
    bronze, silver = work_folder(spark, "bronze"), work_folder(spark, "silver")
    info = tb.company_info(spark, folder)
    moved = F.regexp_extract("ticker", "[0-9]+$", 0).cast("bigint") % 3 == 0
    later = info.withColumns({
        "longName": F.when(moved, F.concat(F.lit("A "), "longName")).otherwise(F.col("longName")),
        "sector": F.when(moved, F.lit("APPS")).otherwise(F.col("sector")),
    })
    for snapshot in (info, later):
        land_snapshot(snapshot, bronze, "ticker", "info", "ticker")
        run_silver(spark, bronze, silver)
    return read_table(spark, f"{silver}/stocks_master", STOCKS_MASTER)


def _as_bar(df):
    return df.select("ticker", F.to_date("date").alias("date"), "close")


_CLOSE2 = rounded("close", 2)


@query(f"""SELECT 'before' AS seen, ticker, date, {_CLOSE2} AS close FROM ({STORED_SQL})
    UNION ALL SELECT 'after', ticker, date, {_CLOSE2} FROM ({UPSERT_SQL})""")
def half_written_upsert(spark, folder):
    """A writer dies with its data written and nothing committed; then the upsert is repeated and goes through."""
    path = work_folder(spark, "commits")
    table, batch = both(spark, folder)
    write_partitioned(price_history(table), path, PRICE_HISTORY)
    left = price_history(batch).withColumn(commits.VERSION, F.lit("000000000002-left"))
    left.write.mode("append").partitionBy("ticker", "year", commits.VERSION).parquet(path)
    before = _as_bar(read_table(spark, path, PRICE_HISTORY)).select(F.lit("before").alias("seen"), "*")
    upsert_partitioned(price_history(batch), path, PRICE_HISTORY, ["ticker", "date"], ["close"])
    return before.unionAll(_as_bar(read_table(spark, path, PRICE_HISTORY)).select(F.lit("after").alias("seen"), "*"))


@query(f"""SELECT CASE WHEN month(date) % 3 = 0 THEN 1 WHEN month(date) % 3 = 1 THEN 2 ELSE 3 END AS run, ticker, date, close
    FROM ({tb.BARS_TYPE})""")
def late_files_taken_once(spark, folder):
    """Files land in three rounds: the second with the times of the first, the third with older ones. Each is taken by the next run, and only then."""
    landing, ctl = work_folder(spark, "landing"), work_folder(spark, "control")
    bars, taken = materialised(tb.bars_by_type(spark, folder), "bars"), []
    for run, month in enumerate((0, 1, 2), 1):
        before = {r["path"] for r in listing(spark, landing).collect()}
        bars.where(F.month("date") % 3 == month).repartition(4, "ticker").write.mode("append").parquet(landing)
        for r in listing(spark, landing).collect():
            if r["path"] not in before:
                set_modified(spark, f"{landing}/{r['path']}", 1_700_000_000_000 if run < 3 else 1_600_000_000_000)
        files = control.unseen_files(spark, ctl, "bars", landing)
        rows = spark.read.schema(bars.schema).parquet(*[literal(f"{landing}/{r['path']}") for r in files.collect()])
        taken.append(rows.select(F.lit(run).alias("run"), "ticker", "date", "close"))
        control.record_files(files, ctl, "bars")
        assert control.unseen_files(spark, ctl, "bars", landing).isEmpty()
    return taken[0].unionAll(taken[1]).unionAll(taken[2])


@query(f"SELECT ticker, date, {rounded_as(4, **_INDICATORS)} FROM ({INDICATORS_SQL(tb.BARS_TYPE)})", digits=4)
def indicators_from_state(spark, folder):
    """Four batches, each going on from the state that the one before left; no history is read."""
    bars = materialised(tb.bars_by_type(spark, folder), "bars")
    states, done, start = spark.createDataFrame([], state.STATE).drop("bucket"), [], "1900-01-01"
    for end in ("1994-01-01", "1996-07-01", "1996-07-15", "2100-01-01"):
        batch = bars.where((F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.lit(end).cast("date")))
        done.append(materialised(state.indicators_behind_state(batch, states, digits=None), "technical"))
        fresh = materialised(state.states_after(batch, states), "fresh")
        states = materialised(fresh.unionByName(states.join(fresh.select("ticker"), "ticker", "left_anti").select(*fresh.columns)), "states")
        start = end
    return reduce(DataFrame.unionByName, done).select("ticker", F.to_date("date").alias("date"), *_INDICATORS)
