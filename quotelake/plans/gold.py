"""Gold job: dimensions, facts, prediction import and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions.numeric import blank_non_finite
from quotelake.operators.constraints import split_stored
from quotelake.operators.sizing import materialised
from quotelake.operators.star import (
    add_dates,
    denormalised,
    dim_industry,
    dim_sector,
    dim_ticker,
    export_order,
    fact_predicted,
    one_fact_per_key,
    shaped_prices,
    shaped_technical,
    ticker_keys,
)
from quotelake.operators.merge import split_valid
from quotelake.schemas import (
    DIM_DATE,
    DIM_INDUSTRY,
    DIM_SECTOR,
    DIM_TICKER,
    FACT_PREDICTED,
    FACT_PRICES,
    FACT_TECHNICAL,
    PRICE_HISTORY,
    STOCKS_MASTER,
    TECHNICAL,
    TableSpec,
)
from quotelake.sources import commits
from quotelake.sources.control import load_watermark, save_watermark
from quotelake.sources.files import read_table
from quotelake.sources.sinks import conform, export_csv, load_slices, rewrite_table, write_export_log


def read_gold(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    return read_table(spark, f"{root}/{spec.name}", spec.schema)


def refresh_dimensions(spark: SparkSession, root: str, master: DataFrame, days: DataFrame) -> None:
    """Bring all four dimensions up to date; members keep the keys they have."""
    rewrite_table(add_dates(read_gold(spark, root, DIM_DATE), days), f"{root}/{DIM_DATE.name}")
    for build, spec in ((dim_sector, DIM_SECTOR), (dim_industry, DIM_INDUSTRY), (dim_ticker, DIM_TICKER)):
        rewrite_table(build(master, read_gold(spark, root, spec)), f"{root}/{spec.name}")


def refresh_gold(
    spark: SparkSession,
    root: str,
    prices: DataFrame,
    technical: DataFrame,
    master: DataFrame,
    slices: Sequence[str] = ("DateId", "TickerId"),
) -> bool:
    """Load new silver rows into the star; False when there are none.

    Facts replace their slices. The default slice is the full key, which is safe for batches with some of
    the tickers; ``("DateId",)`` clears whole dates.
    """
    if prices.isEmpty() and technical.isEmpty():
        return False
    refresh_dimensions(spark, root, master, prices)
    lookup = ticker_keys(*(read_gold(spark, root, s) for s in (DIM_TICKER, DIM_SECTOR, DIM_INDUSTRY)))
    for rows, shape, spec in ((prices, shaped_prices, FACT_PRICES), (technical, shaped_technical, FACT_TECHNICAL)):
        if not rows.isEmpty():
            load_facts(shape(blank_non_finite(rows), lookup), root, spec, slices)
    return True


def load_facts(shaped: DataFrame, root: str, spec: TableSpec, slices: Sequence[str] = ("DateId", "TickerId")) -> dict[str, int]:
    """Load the rows that keep the table's rules; returns and logs the number of rows inserted and refused, by reason.

    Refused rows go to ``refused/<table>`` with their reason. Rows are judged, split and counted in the pass that stores them.
    """
    spark = shaped.sparkSession
    passed, refused, counts = split_stored(shaped, spec)
    stored = materialised(one_fact_per_key(passed), spec.name)
    load_slices(stored, f"{root}/{spec.name}", spec, slices)
    if counts:
        refused.withColumn("refused_at", F.current_timestamp()).write.mode("append").parquet(f"{root}/refused/{spec.name}")
    inserted = stored.count()
    duplicates = passed.count() - inserted
    counts = {"inserted": inserted, **counts} | ({"duplicate key": duplicates} if duplicates else {})
    lines = [(spec.name, outcome, n) for outcome, n in counts.items()]
    log = spark.createDataFrame(lines, "table string, outcome string, rows bigint").withColumn("at", F.current_timestamp())
    log.coalesce(1).write.mode("append").json(f"{root}/load_log")
    return counts


def run_gold(spark: SparkSession, silver: str, gold: str) -> bool:
    """Load the silver folders that commits since the last run wrote; False when there are none.

    Each table's commit number is saved once the facts are loaded, so a failed run is repeated. The master table is always read whole, so dimension lookups are complete.
    """
    fresh, marks = [], {}
    for name, schema in (("price_history", PRICE_HISTORY), ("technical_indicators", TECHNICAL)):
        path, mark = f"{silver}/{name}", f"gold_{name}"
        done, last = int(load_watermark(spark, gold, mark, "0")), commits.last_number(spark, path)
        fresh.append(commits.read(spark, path, schema, last, after=done))
        if last > done:
            marks[mark] = last
    if not marks:
        return False
    master = read_table(spark, f"{silver}/stocks_master", STOCKS_MASTER)
    done = refresh_gold(spark, gold, *fresh, master)
    for mark, last in marks.items():
        save_watermark(spark, gold, mark, str(last))
    return done


def import_predictions(spark: SparkSession, root: str, predictions: DataFrame) -> DataFrame:
    """Append predictions whose members are known; returns the refused rows with reasons.

    Dates the dimension lacks are added first, with all their parts. The given rows are read once.
    """
    predictions = materialised(predictions, "predictions")
    days = predictions.select("date").unionByName(predictions.select(F.col("exportDate").alias("date")))
    rewrite_table(add_dates(read_gold(spark, root, DIM_DATE), days), f"{root}/{DIM_DATE.name}")
    stored = read_gold(spark, root, FACT_PREDICTED)
    dims = [read_gold(spark, root, s) for s in (DIM_TICKER, DIM_SECTOR, DIM_INDUSTRY)]
    accepted, refused = fact_predicted(predictions, *dims, table=stored, store=materialised)
    kept, rejected = materialised(accepted, "accepted"), materialised(refused, "refused")
    commits.append(kept, f"{root}/{FACT_PREDICTED.name}")
    return rejected


def append_rows(batch: DataFrame, root: str, spec: TableSpec) -> DataFrame:
    """Append the rows a keyed insert accepts; returns the refused ones."""
    table = read_gold(batch.sparkSession, root, spec)
    names = spec.schema.fieldNames()
    others = [n for n in names if n not in spec.key]
    accepted, refused = split_valid(
        blank_non_finite(batch.select(*names)), spec.key, others, spec.required, spec.lengths, table
    )
    rejected = materialised(refused, "refused")
    commits.append(conform(materialised(accepted, "accepted"), spec.schema), f"{root}/{spec.name}", spec.partition)
    return rejected


def export_star(spark: SparkSession, root: str, target: str) -> dict[str, int]:
    """Write both denormalised facts as CSV, in export order, and log their row counts."""
    dims = [read_gold(spark, root, s) for s in (DIM_DATE, DIM_TICKER, DIM_SECTOR, DIM_INDUSTRY)]
    names = {"stock_prices_daily": FACT_PRICES, "technical_indicators_daily": FACT_TECHNICAL}
    counts = {
        name: export_csv(export_order(denormalised(read_gold(spark, root, spec), *dims)), f"{target}/{name}")
        for name, spec in names.items()
    }
    write_export_log(spark, f"{target}/export_log", counts)
    return counts
