"""Silver job: clean a batch of landed rows, compute indicators with run-up, upsert the three tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions.names import column
from quotelake.operators.cleaning import clean_prices
from quotelake.operators.dedup import keep_last
from quotelake.operators.history import LOOKBACK, incremental_indicators, years_for_lookback
from quotelake.operators.merge import upsert
from quotelake.operators.sizing import broadcast_if_small, materialised
from quotelake.operators.snapshots import EXTRACTED
from quotelake.operators.state import STATE, bucket_of, indicators_behind_state, late_tickers, states_after
from quotelake.operators.tables import price_history, technical_indicators
from quotelake.schemas import PRICE_HISTORY, STOCKS_MASTER, TECHNICAL
from quotelake.sources import commits
from quotelake.sources.control import record_files, unseen_files
from quotelake.sources.files import read_bronze_files, read_table
from quotelake.sources.sinks import rewrite_table, upsert_partitioned

BAR_KEY = ("ticker", "date")


def read_states(spark: SparkSession, path: str, batch: DataFrame) -> DataFrame:
    """The stored states of the batch's tickers; only the folders they can be in are read."""
    tickers = batch.select("ticker").distinct()
    found = commits.read(spark, path, STATE, only=tickers.select(bucket_of().alias("bucket")))
    return found.join(broadcast_if_small(tickers), "ticker", "left_semi").select(*STATE.fieldNames())


def write_states(states: DataFrame, path: str, source: str | None = None) -> None:
    fresh = materialised(states.withColumn("bucket", bucket_of()).select(*STATE.fieldNames()), "states")
    upsert_partitioned(fresh, path, STATE, ("ticker",), ["last_date"], ("bucket",), source)


def refresh_silver(
    prices: DataFrame,
    info: DataFrame | None,
    root: str,
    lookback: int = LOOKBACK,
    exchange_tz: str | None = None,
    fences_by: tuple[str, ...] = (),
    source: str | None = None,
) -> bool:
    """Merge one batch into silver; False when there is nothing new.

    The clean batch is stored once in the work folder and everything else reads it from there. A repeated
    run of the same batch leaves the same tables.
    """
    done = refresh_master(info, root) if info is not None else False
    return refresh_prices(prices, root, lookback, exchange_tz, fences_by, source) or done


def refresh_master(info: DataFrame, root: str) -> bool:
    """Company attributes: of each ticker the row that was extracted last; False when there is none."""
    spark = info.sparkSession
    if info.isEmpty():
        return False
    path = f"{root}/stocks_master"
    names = STOCKS_MASTER.fieldNames()
    others = [n for n in names if n != "ticker"]
    extracted = column(EXTRACTED) if EXTRACTED in info.columns else F.lit("")
    dated = info.select("ticker", F.col("longName").alias("company_name"), "sector", "industry", extracted.alias(EXTRACTED))
    latest = keep_last(dated, ["ticker"], [EXTRACTED, *others]).select(*names)
    rewrite_table(upsert(read_table(spark, path, STOCKS_MASTER), latest, ["ticker"], others), path)
    return True


def refresh_prices(
    prices: DataFrame,
    root: str,
    lookback: int = LOOKBACK,
    exchange_tz: str | None = None,
    fences_by: tuple[str, ...] = (),
    source: str | None = None,
) -> bool:
    """Merge one batch of bars into the price history, the indicators and their state; False when it is empty.

    Tickers whose bars follow what is stored go on from the state of their averages and their last bars, and no history is read.
    Tickers with bars at or before their last stored date (late or corrected ones) are computed behind ``lookback`` stored rows, and their state is
    made anew from the stored prices. ``source`` names what the batch came from: a table that has a commit of it is left alone.
    """
    spark = prices.sparkSession
    if prices.isEmpty():
        return False
    history_path, technical_path, state_path = (f"{root}/{name}" for name in ("price_history", "technical_indicators", "indicator_state"))
    if source is not None and commits.has_source(spark, state_path, source):
        return False
    clean = materialised(
        clean_prices(prices, exchange_tz=exchange_tz, fences_by=fences_by, store=materialised), "clean"
    )
    stored = materialised(read_states(spark, state_path, clean), "states")
    late = materialised(late_tickers(clean, stored), "late")
    behind = broadcast_if_small(late)
    ahead, back = (clean.join(behind, "ticker", kind).select(*clean.columns) for kind in ("left_anti", "left_semi"))
    states = stored.join(behind, "ticker", "left_anti").select(*stored.columns)
    some_late = not late.isEmpty()

    technical = indicators_behind_state(ahead, states)
    if some_late:
        history = years_for_lookback(read_table(spark, history_path, PRICE_HISTORY), back, lookback)
        technical = technical.unionByName(incremental_indicators(history, back, lookback), allowMissingColumns=True)
    technical = materialised(technical_indicators(technical), "technical")

    if source is None or not commits.has_source(spark, history_path, source):
        upsert_partitioned(price_history(clean), history_path, PRICE_HISTORY, BAR_KEY, ["close"], source=source)
    if source is None or not commits.has_source(spark, technical_path, source):
        upsert_partitioned(technical, technical_path, TECHNICAL, BAR_KEY, ["rsi"], source=source)
    # last, so a run that dies is repeated behind the state it started from
    fresh = states_after(ahead, states)
    if some_late:
        again = read_table(spark, history_path, PRICE_HISTORY).join(behind, "ticker", "left_semi")
        fresh = fresh.unionByName(states_after(again, states.limit(0)))
    write_states(fresh, state_path, source)
    return True


def run_silver(spark: SparkSession, bronze: str, silver: str, lookback: int = LOOKBACK) -> bool:
    """Merge the bronze files that no earlier run took into silver; False when there are none.

    Prices and company attributes have a ledger each: the path, length and time of every file taken, entered after the tables are
    written. So a failed run is repeated, and a file that lands late is taken whatever its time. Only the new files are opened; their
    names go into the scan.
    """
    done = False
    for kind, refresh in (("info", refresh_master), ("prices", lambda df, root: refresh_prices(df, root, lookback))):
        files = unseen_files(spark, silver, f"silver_{kind}", f"{bronze}/ticker", within=F.col("path").contains(f"/kind={kind}/"))
        names = [r["path"] for r in files.select("path").collect()]
        if names:
            done = refresh(read_bronze_files(spark, bronze, "ticker", kind, names), silver) or done
            record_files(files, silver, f"silver_{kind}")
    return done
