"""Bounded choices of rows that no task has to put in order as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotelake.session import work_folder

# Rows that a Python task gets at once: whole texts, so a few megabytes.
ARROW_ROWS = 2000

_BINS = 64
_SPAN = 1 << 62


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Keep what a Python task holds of long texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def sample(rows: DataFrame, column: str, most: int, seed: int) -> DataFrame:
    """The rows (at most ``most``) with the lowest hash of a column whose values are distinct.

    Rows whose hash is above the share that is needed are left out before any are put in order.
    """
    n = rows.count()
    if n <= most:
        return rows
    place = F.pmod(F.xxhash64(F.lit(seed), column), F.lit(_SPAN))
    share = min(1.0, (most + 4 * most**0.5 + 8) / n)
    return rows.where(place < int(share * _SPAN)).orderBy(place, column).limit(most)


def commonest(counts: DataFrame, most: int) -> DataFrame:
    """Rows with the highest n, at most ``most``: those above a bound on n, which a histogram of log n gives. counts: n of 1 or more."""
    place = F.floor(F.log2("n") * _BINS).cast("int")
    # 64 bins for each power of two, so a few thousand rows at any size of the corpus
    bins = counts.groupBy(place.alias("bin")).agg(F.count("*").alias("rows")).collect()
    total, least = 0, 1 << 30
    for row in sorted(bins, key=lambda row: -row["bin"]):
        total += row["rows"]
        if total > most:
            break
        least = row["bin"]
    return counts.where(place >= least)


def one_each(rows: DataFrame, key: str, text: str, *same: str) -> DataFrame:
    """One row per key, so that a bound on keys binds the rows: of several texts, that of the least hash. ``same``: columns with one value per key."""
    return rows.groupBy(key, *same).agg(F.min_by(text, F.xxhash64(text)).alias(text))


def within(rows: DataFrame, key: str, text: str, most_chars: int) -> DataFrame:
    """Rows in the order of a hash of their key as long as their texts have ``most_chars`` in all. A bounded table of distinct keys, which is stored."""
    spark = rows.sparkSession
    store = work_folder(spark, "sample")
    rows.select(key, text).write.parquet(store)
    stored = spark.read.schema(rows.select(key, text).schema).parquet(store)
    order = Window.orderBy(F.xxhash64(F.lit(7), key), key)
    # numbers only, and no more than a sample has rows
    kept = stored.select(key, F.sum(F.length(text)).over(order).alias("chars")).where(F.col("chars") <= most_chars).select(key)
    return stored.join(kept, key, "left_semi")
