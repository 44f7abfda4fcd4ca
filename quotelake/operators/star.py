"""The gold star schema: dimensions, facts and the joins that read it back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.dates import calendar_parts, date_from_parts, date_key
from quotelake.operators.dedup import keep_first, keep_first_stored
from quotelake.operators.keys import assign_keys
from quotelake.operators.merge import split_valid
from quotelake.operators.sizing import broadcast_if_small, materialised

FOREIGN_KEYS = ("DateId", "TickerId", "SectorId", "IndustryId")
FACT_KEY = ("DateId", "TickerId")

PRICE_MEASURES = {
    "OpenPrice": "open",
    "HighPrice": "high",
    "LowPrice": "low",
    "ClosePrice": "close",
    "AdjustedClosePrice": "adj_close",
}
TECHNICAL_MEASURES = {
    "sma20": "sma_20",
    "sma50": "sma_50",
    "atr": "atr",
    "rsi": "rsi",
    "macd": "macd",
    "bollinger_bands_down": "bb_lower",
    "bollinger_bands_up": "bb_upper",
}


# Dimensions


def dim_date(days: DataFrame, column: str = "date") -> DataFrame:
    """One member per distinct calendar day, with all its parts."""
    distinct = days.select(F.to_date(column).alias("_day")).where(F.col("_day").isNotNull()).distinct()
    return distinct.select(*[part.cast("int").alias(n) for n, part in calendar_parts(F.col("_day")).items()])


def add_dates(dimension: DataFrame, days: DataFrame, column: str = "date") -> DataFrame:
    """The date dimension with a member for every day named; present members stay as they are."""
    missing = dim_date(days, column).join(dimension.select("DateId"), "DateId", "left_anti")
    return dimension.unionByName(missing)


def dim_sector(master: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return assign_keys(known, master.select(F.col("sector").alias("Sector")), "SectorId", "Sector")


def dim_industry(master: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return assign_keys(known, master.select(F.col("industry").alias("Industry")), "IndustryId", "Industry")


def dim_ticker(master: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One member per symbol. Attributes follow the master; members the master lacks keep theirs."""
    attributes = keep_first(
        master.select(
            F.col("ticker").alias("Symbol"),
            F.col("company_name").alias("Name"),
            F.col("sector").alias("Sector"),
            F.col("industry").alias("Industry"),
        ).where(F.col("ticker").isNotNull()),
        ["Symbol"],
        ["Name", "Sector", "Industry"],
    )
    names = ("Name", "Sector", "Industry")
    keyed = assign_keys(known, attributes, "TickerId", "Symbol").join(
        attributes.withColumn("_given", F.lit(True)), "Symbol", "left"
    )
    if known is None:
        return keyed.select("TickerId", "Symbol", *names)
    stored = known.select("TickerId", *[F.col(n).alias(f"_{n}") for n in names])
    return keyed.join(stored, "TickerId", "left").select(
        "TickerId", "Symbol", *[F.when(F.col("_given"), F.col(n)).otherwise(F.col(f"_{n}")).alias(n) for n in names]
    )


# Facts


def ticker_keys(tickers: DataFrame, sectors: DataFrame, industries: DataFrame) -> DataFrame:
    """Symbol to all foreign keys.

    The two-step lookup (ticker to sector name to sector key) runs among the dimensions, so a fact table
    is joined once instead of three times.
    """
    return (
        tickers.join(sectors, "Sector", "left")
        .join(industries, "Industry", "left")
        .select(F.col("Symbol").alias("ticker"), "TickerId", "SectorId", "IndustryId")
    )


def _shaped(rows: DataFrame, lookup: DataFrame, measures: dict[str, str], extra: Sequence[str] = ()) -> DataFrame:
    """Rows as their fact has them, with the date they came from; a key is NULL where a member is unknown."""
    keyed = rows.join(broadcast_if_small(lookup), "ticker", "left").withColumn("DateId", date_key(F.col("date")))
    return keyed.select(
        *FOREIGN_KEYS,
        *[F.col(source).cast("decimal(18,2)").alias(name) for name, source in measures.items()],
        *extra,
        F.col("date").alias("_date"),
    )


def shaped_prices(prices: DataFrame, lookup: DataFrame) -> DataFrame:
    return _shaped(prices.withColumn("Volume", F.col("volume").cast("bigint")), lookup, PRICE_MEASURES, ["Volume"])


def shaped_technical(technical: DataFrame, lookup: DataFrame) -> DataFrame:
    return _shaped(technical, lookup, TECHNICAL_MEASURES)


def one_fact_per_key(stored: DataFrame) -> DataFrame:
    """Of stored shaped rows with one key, the first by date and measures."""
    others = [c for c in stored.columns if c not in FACT_KEY]
    return keep_first_stored(stored, FACT_KEY, ["_date", *[c for c in others if c not in ("_date", *FOREIGN_KEYS)]]).drop("_date")


def fact_prices(prices: DataFrame, lookup: DataFrame) -> DataFrame:
    return one_fact_per_key(materialised(shaped_prices(prices, lookup).dropna(subset=list(FOREIGN_KEYS)), "prices"))


def fact_technical(technical: DataFrame, lookup: DataFrame) -> DataFrame:
    return one_fact_per_key(materialised(shaped_technical(technical, lookup).dropna(subset=list(FOREIGN_KEYS)), "technical"))


def resolve_predictions(
    predictions: DataFrame, tickers: DataFrame, sectors: DataFrame, industries: DataFrame
) -> DataFrame:
    """Predictions with the keys found, a NULL where a member is unknown."""
    return (
        predictions.join(
            broadcast_if_small(tickers.select(F.col("Symbol").alias("ticker"), "TickerId")), "ticker", "left"
        )
        .join(broadcast_if_small(sectors.select(F.col("Sector").alias("sector"), "SectorId")), "sector", "left")
        .join(
            broadcast_if_small(industries.select(F.col("Industry").alias("industry"), "IndustryId")),
            "industry",
            "left",
        )
        .select(
            date_key(F.to_date("date")).alias("DateId"),
            "TickerId",
            "SectorId",
            "IndustryId",
            date_key(F.to_date("exportDate")).alias("PredictionDateId"),
            F.col("close").cast("double").alias("PredictedPrice"),
            "ticker",
            "sector",
            "industry",
        )
    )


PREDICTION_COLUMNS = (*FOREIGN_KEYS, "PredictionDateId", "PredictedPrice")


def fact_predicted(
    predictions: DataFrame,
    tickers: DataFrame,
    sectors: DataFrame,
    industries: DataFrame,
    table: DataFrame | None = None,
    store: Callable[[DataFrame, str], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Accepted prediction facts and the refused rows with the first reason against them. ``store``: as in ``split_valid``."""
    resolved = resolve_predictions(predictions, tickers, sectors, industries)
    reason = (
        F.when(F.col("DateId").isNull() | F.col("PredictionDateId").isNull(), "unreadable date")
        .when(F.col("TickerId").isNull(), "unknown ticker")
        .when(F.col("SectorId").isNull(), "unknown sector")
        .when(F.col("IndustryId").isNull(), "unknown industry")
    )
    judged = resolved.withColumn("reason", reason)
    accepted, refused = split_valid(
        judged.where(F.col("reason").isNull()).select(*PREDICTION_COLUMNS),
        FACT_KEY,
        ["PredictionDateId"],
        FOREIGN_KEYS,
        table=table,
        store=store,
    )
    names = ("ticker", "sector", "industry")
    unresolved = (
        judged.where(F.col("reason").isNotNull())
        .groupBy(*PREDICTION_COLUMNS, *names, "reason")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return accepted, unresolved.unionByName(refused, allowMissingColumns=True)


# Reading the star back


def denormalised(
    fact: DataFrame, dates: DataFrame, tickers: DataFrame, sectors: DataFrame, industries: DataFrame
) -> DataFrame:
    """Inner star join with the attributes of all four dimensions in front of the measures."""
    measures = [c for c in fact.columns if c not in FOREIGN_KEYS]
    parts = ("Year", "Quarter", "Month", "Week", "Day")
    # The day is made from text, once per member of the dimension and not once per fact.
    days = dates.select("DateId", date_from_parts(F.col("Year"), F.col("Month"), F.col("Day")).alias("DateKey"), *parts)
    return (
        fact.join(broadcast_if_small(days), "DateId")
        .join(broadcast_if_small(tickers.select("TickerId", "Symbol", "Name")), "TickerId")
        .join(broadcast_if_small(sectors), "SectorId")
        .join(broadcast_if_small(industries), "IndustryId")
        .select("DateKey", *parts, "Symbol", "Name", "Sector", "Industry", *measures)
    )


def export_order(star: DataFrame) -> DataFrame:
    return star.orderBy("Year", "Month", "Day", "Symbol")
