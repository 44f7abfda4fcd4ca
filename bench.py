"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Every query is run once to warm up the JVM
and then timed in full: it starts from the given Parquet files and its result is consumed whole.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from quotelake.plans.catalog import QUERIES
from quotelake.session import local_session

HEADLINE = (
    "daily_bars",
    "iqr_filter_global",
    "clean_prices",
    "indicators_full",
    "incremental_indicators",
    "upsert_keep_last",
    "slice_replace",
    "dim_ticker",
    "fact_prices",
    "star_prices",
    "star_indicators",
    "fact_predicted",
    "describe_close",
    "rolling_vol_30",
    "portfolio_summary",
    "returns_correlation",
    "indicator_correlation",
    "entitled_sections",
    "snapshot_hash",
    "log_scan",
    "flatten_nested",
    "quantiles_of_all_trades",
    "insert_accepted",
)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    # stands in for the folder that a cluster's executors share
    shared = tempfile.mkdtemp(prefix="quotelake-bench-")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "quotelake-bench", **{"spark.checkpoint.dir": shared})
    times: dict[str, float] = {}
    for name in HEADLINE:
        consume(QUERIES[name](spark, folder))
        start = time.perf_counter()
        consume(QUERIES[name](spark, folder))
        times[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else folder,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
