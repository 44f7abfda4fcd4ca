"""Landing job: prices behind a watermark, snapshots only when their content changed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.operators.history import after_ticker_watermarks, after_watermark
from quotelake.operators.sizing import materialised
from quotelake.operators.snapshots import changed_rows, compare_digests, content_digests, tag_extraction
from quotelake.sources.control import (
    load_hashes,
    load_ticker_watermarks,
    load_watermark,
    save_hashes,
    save_ticker_watermarks,
    save_watermark,
)
from quotelake.sources.sinks import save_raw

# The kinds of snapshots, with the area each lands in and its logical key.
SNAPSHOTS = {
    "info": ("ticker", "ticker"),
    "calendar": ("ticker", "ticker"),
    "status": ("market", "market"),
    "summary": ("market", "market"),
    "sector": ("sector_industry", "sector"),
    "industry": ("sector_industry", "industry"),
    "statements": ("equity", "ticker"),
    "funds": ("funds", "ticker"),
}

# Fixed value: where price history starts when nothing has landed yet.
START_DATE = "2016-01-01"


def land_prices(prices: DataFrame, root: str, per_ticker: bool = True) -> int:
    """Append the price rows that are newer than what has landed; returns how many.

    By default each ticker has its own watermark, so a late or new ticker keeps its history;
    ``per_ticker=False`` uses one for all. Watermarks are saved after the rows: a run that dies in between
    lands its rows again, and cleaning keeps one copy.
    """
    spark = prices.sparkSession
    mark = load_watermark(spark, root, "prices", START_DATE)
    if per_ticker:
        fresh = after_ticker_watermarks(prices, load_ticker_watermarks(spark, root))
    else:
        fresh = after_watermark(prices, F.lit(mark).cast("date"))
    batch = materialised(tag_extraction(fresh), "prices")
    seen = batch.agg(F.count(F.lit(1)).alias("n"), F.max(F.to_date("Date")).cast("string").alias("last")).head()
    if seen["n"] == 0:
        return 0
    save_raw(batch, root, "ticker", "prices")
    save_ticker_watermarks(batch, root)
    if seen["last"] is not None and seen["last"] > mark:
        save_watermark(spark, root, "prices", seen["last"])
    return seen["n"]


def land_snapshot(snapshot: DataFrame, root: str, area: str, kind: str, key: str) -> DataFrame:
    """Append the rows of logical keys whose content is new or changed; returns the comparison."""
    spark: SparkSession = snapshot.sparkSession
    stored = load_hashes(spark, root, f"{area}_{kind}", [key])
    compared = materialised(compare_digests(content_digests(snapshot, [key]), stored, [key]), "hashes")
    if compared.where(F.col("status") != "unchanged").isEmpty():
        return compared
    save_raw(tag_extraction(changed_rows(snapshot, compared, [key])), root, area, kind, key)
    save_hashes(compared, root, f"{area}_{kind}", [key])
    return compared


def land_snapshots(snapshots: Mapping[str, DataFrame], root: str) -> dict[str, dict[str, int]]:
    """Land several kinds, each where its content is new or changed; returns the number of keys by kind and status.

    A kind that fails does not keep the others from landing; the failures are raised together at the end.
    """
    unknown = sorted(set(snapshots) - set(SNAPSHOTS))
    if unknown:
        raise ValueError(f"unknown kinds of snapshots: {', '.join(unknown)}")
    counts, failures = {}, []
    for kind, rows in snapshots.items():
        try:
            compared = land_snapshot(rows, root, SNAPSHOTS[kind][0], kind, SNAPSHOTS[kind][1])
            # three statuses at most
            counts[kind] = {r["status"]: r["count"] for r in compared.groupBy("status").count().collect()}
        except Exception as error:
            error.add_note(f"snapshots of kind {kind}")
            failures.append(error)
    if failures:
        raise ExceptionGroup(f"{len(failures)} of {len(snapshots)} kinds of snapshots did not land", failures)
    return counts
