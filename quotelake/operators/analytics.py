"""Statistics over price series: descriptions, returns, volatility, correlation, clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.functions.names import column
from quotelake.functions.numeric import growth
from quotelake.functions.rolling import rolling_std
from quotelake.operators.quantiles import exact_quantiles
from quotelake.operators.series import BLOCK, BLOCK_ROWS, chunked, in_chunk, unchunked, with_earlier, with_sized_block, within_block
from quotelake.operators.sizing import materialised

# Trading days in a year, rows of the volatility window, clusters and their seed.
TRADING_DAYS = 252
VOLATILITY_ROWS = 30
CLUSTERS, CLUSTER_SEED = 3, 42

# Tickers of a tile of the correlation matrix: a task sums at most the square of it at a time for each tile pair.
TILE = 64

# The indicators that are correlated, in the report's order.
INDICATOR_COLUMNS = ("sma_20", "sma_50", "rsi", "macd", "atr", "bb_upper", "bb_lower")


def describe_close(prices: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of the close per ticker."""
    moments = prices.groupBy("ticker").agg(
        F.count("close").alias("count"),
        F.avg("close").alias("mean"),
        F.stddev_samp("close").alias("std"),
        F.min("close").alias("min"),
        F.max("close").alias("max"),
    )
    quartiles = exact_quantiles(prices, "close", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["ticker"])
    return moments.join(quartiles, "ticker", "left").select(
        "ticker", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def with_returns(prices: DataFrame, by: Sequence[str] = ("ticker",), rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``ret``, the relative change of the close to the previous bar.

    Inside a calendar block the previous bar is one row up; the first bar of a block takes the last close
    of the block before, which arrives with the block summaries.
    """
    blocked = with_earlier(
        with_sized_block(prices, by, rows=rows), by, {"_last": (F.max_by("close", "date"), F.last)}
    )
    window = within_block(by, ["date"])
    previous = F.when(F.row_number().over(window) == 1, F.col("_last")).otherwise(F.lag("close").over(window))
    return blocked.withColumn("ret", growth(F.col("close"), previous)).drop("_last", BLOCK)


def with_running_peak(prices: DataFrame, by: Sequence[str] = ("ticker",), rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``peak``, the highest close up to each bar."""
    blocked = with_earlier(with_sized_block(prices, by, rows=rows), by, {"_peak": (F.max("close"), F.max)})
    own = F.max("close").over(within_block(by, ["date"]))
    return blocked.withColumn("peak", F.greatest("_peak", own)).drop("_peak", BLOCK)


def return_volatility(prices: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """Sample deviation of the returns per ticker."""
    return with_returns(prices, rows=rows).groupBy("ticker").agg(F.stddev_samp("ret").alias("volatility"))


def feature_means(prices: DataFrame) -> DataFrame:
    return prices.groupBy("ticker").agg(F.avg("close").alias("close"), F.avg("volume").alias("volume"))


def rolling_volatility(prices: DataFrame) -> DataFrame:
    """30-bar sample deviation of the returns, annualised."""
    window = in_chunk()
    out = chunked(prices.select("ticker", "date", "close"), lookback=64)
    out = out.withColumn("ret", growth(F.col("close"), F.lag("close").over(window)))
    annual = rolling_std(F.col("ret"), VOLATILITY_ROWS, window) * F.sqrt(F.lit(float(TRADING_DAYS)))
    return unchunked(out.withColumn("volatility", annual)).select("ticker", "date", "volatility")


def drawdowns(prices: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """Largest fall from a running peak per ticker."""
    fall = F.try_divide("close", "peak") - 1.0
    return with_running_peak(prices, rows=rows).groupBy("ticker").agg(F.min(fall).alias("max_drawdown"))


def series_names(prices: DataFrame) -> list[str]:
    """The tickers in order, for results that have a column for each."""
    return [r[0] for r in prices.select("ticker").distinct().orderBy("ticker").collect()]


def _pearson(x: str, y: str) -> Column:
    """Aggregate: the correlation of two columns; NULL if one does not vary or there is no row."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlation_matrix(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns as (a, b, corr), over rows without NULL.

    A row becomes its pairs of values, which are summed by pair before the shuffle, so the plan is the same for any number of columns.
    """
    complete = rows.select(*[column(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).dropna()
    values = complete.select(F.array(*complete.columns).alias("_v"))
    first = values.select("_v", F.posexplode("_v").alias("i", "x"))
    pairs = first.select("i", "x", F.posexplode("_v").alias("j", "y")).where("i <= j")
    found = pairs.groupBy("i", "j").agg(_pearson("x", "y").alias("corr"))
    both = found.unionByName(found.where("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "corr"))
    names = F.array(*[F.lit(c) for c in columns])
    size = F.lit(len(columns) - 1)
    # all pairs of the given names, also when no row is complete
    cells = rows.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), size)).alias("i")).select("i", F.explode(F.sequence(F.lit(0), size)).alias("j"))
    return cells.join(both, ["i", "j"], "left").select(
        F.element_at(names, F.col("i") + 1).alias("a"), F.element_at(names, F.col("j") + 1).alias("b"), "corr"
    )


def tiled_pairs(returns: DataFrame, tickers: int, tile: int = TILE) -> DataFrame:
    """Correlation of each two tickers (a <= b) over dates that hold all of them, as (ticker_a, ticker_b, corr).

    Tickers are dealt to tiles. A date's returns of a tile travel as one array to each tile pair it is part of, so a date ships tickers * tiles
    values; the pairs of values of two tiles meet in one task per month, which has the sums of that block only and passes on a row per pair.
    """
    tiles = max(1, -(-tickers // tile))
    named = returns.where(F.col("ticker").isNotNull()).withColumn("_tile", F.pmod(F.xxhash64("ticker"), F.lit(tiles)).cast("int"))
    # at most about a tile's width of values in a list
    lists = named.groupBy("date", "_tile").agg(F.collect_list(F.struct("ticker", "ret")).alias("_items"))
    sent = lists.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).select(
        F.least("_tile", "_other").alias("_i"), F.greatest("_tile", "_other").alias("_j"), F.date_trunc("month", F.col("date").cast("timestamp")).alias("_month"), "date", "_tile", "_items"
    )
    blocks = (
        sent.repartition("_i", "_j", "_month")
        .groupBy("_i", "_j", "_month", "date")
        .agg(F.sort_array(F.collect_list(F.struct("_tile", "_items"))).alias("_sides"))
        # a tile may have no ticker at all
        .where((F.col("_i") == F.col("_j")) | (F.size("_sides") == 2))
        .select("_i", "_j", F.element_at("_sides", 1)["_items"].alias("_left"), F.element_at("_sides", -1)["_items"].alias("_right"))
    )
    pairs = blocks.select("_i", "_j", F.explode("_left").alias("_x"), "_right").select("_i", "_j", "_x", F.explode("_right").alias("_y"))
    pairs = pairs.where((F.col("_i") < F.col("_j")) | (F.col("_x.ticker") <= F.col("_y.ticker")))
    a, b = F.col("_x.ticker"), F.col("_y.ticker")
    values = pairs.select(F.least(a, b).alias("ticker_a"), F.greatest(a, b).alias("ticker_b"), F.col("_x.ret").alias("x"), F.col("_y.ret").alias("y"))
    return values.groupBy("ticker_a", "ticker_b").agg(_pearson("x", "y").alias("corr"))


def returns_correlation(prices: DataFrame, tile: int = TILE) -> DataFrame:
    """Correlation of returns between tickers on the common calendar, as (ticker_a, ticker_b, corr).

    A return needs both its date and the date before in the calendar of all tickers, and only dates with every ticker's return count.
    All in long form: pairs meet by tiles of tickers and are summed by pair before the shuffle. Tickers whose returns don't vary, and all of them if no
    date is complete, have NULL.
    """
    closes = materialised(prices.groupBy("date", "ticker").agg(F.avg("close").alias("close")), "closes")
    # one row per day of the calendar
    calendar = closes.select("date").distinct().select("date", F.lag("date").over(Window.orderBy("date")).alias("_prior"))
    tickers = materialised(closes.select("ticker").distinct(), "tickers")
    before = closes.select(F.col("date").alias("_prior"), "ticker", F.col("close").alias("_before"))
    returns = (
        closes.join(calendar, "date")
        .join(before, ["_prior", "ticker"])
        .select("date", "ticker", growth(F.col("close"), F.col("_before")).alias("ret"))
        .where(F.col("ret").isNotNull() & ~F.isnan("ret"))
    )
    whole = returns.groupBy("date").agg(F.count(F.lit(1)).alias("_n")).join(tickers.agg(F.count(F.lit(1)).alias("_all")), F.col("_n") == F.col("_all"))
    kept = materialised(returns.join(whole.select("date"), "date", "left_semi"), "returns")
    half = tiled_pairs(kept, tickers.count(), tile)
    other = half.where("ticker_a < ticker_b").select(F.col("ticker_b").alias("ticker_a"), F.col("ticker_a").alias("ticker_b"), "corr")
    # the matrix has a cell for each two tickers, so this is its size
    cells = tickers.select(F.col("ticker").alias("ticker_a")).crossJoin(tickers.select(F.col("ticker").alias("ticker_b")))
    return cells.join(half.unionByName(other), ["ticker_a", "ticker_b"], "left")


def indicator_correlation(technical: DataFrame) -> DataFrame:
    present = [c for c in INDICATOR_COLUMNS if c in technical.columns]
    return correlation_matrix(technical, present).toDF("indicator_a", "indicator_b", "corr")


def cluster_tickers(prices: DataFrame, k: int = CLUSTERS, seed: int = CLUSTER_SEED, scaled: bool = False) -> DataFrame:
    """K-means over the mean close and volume per ticker. Labels are arbitrary numbers."""
    # The iterations read the stored means, one row per ticker, and not the bars.
    means = materialised(feature_means(prices), "features")
    features = VectorAssembler(inputCols=["close", "volume"], outputCol="raw").transform(means)
    if scaled:
        scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True)
        features = scaler.fit(features).transform(features)
    else:
        features = features.withColumnRenamed("raw", "features")
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(features)
    return model.transform(features).select("ticker", "close", "volume", "cluster")


def cluster_centres(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("members"), F.avg("close").alias("close"), F.avg("volume").alias("volume")
    )
