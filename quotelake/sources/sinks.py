"""Writing landed files, stored tables and exports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.functions.text import fixed
from quotelake.operators.dedup import keep_first
from quotelake.operators.merge import replace_slices, upsert
from quotelake.operators.sizing import broadcast_if_small
from quotelake.operators.snapshots import as_text
from quotelake.schemas import TableSpec
from quotelake.sources import commits

SILVER_PARTITIONS = ("ticker", "year")
LISTING_TASKS = 64
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _storable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _storable(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _storable(dtype.keyType) and _storable(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return len(dtype) > 0 and all(_storable(f.dataType) for f in dtype)
    return not isinstance(dtype, (T.NullType, T.CalendarIntervalType))


def save_raw(df: DataFrame, root: str, area: str, kind: str, key: str = "ticker") -> str:
    """Append landed rows, one folder per kind. Frames that Parquet cannot hold become all text.

    Typed and text files live apart, so each can be scanned with one schema. The key is a column: files hold whole keys as long as these are small, so
    their number goes by the rows and not by the keys. An empty key is read as missing.
    """
    storable = all(_storable(f.dataType) for f in df.schema)
    encoding = "typed_rows" if storable else "text_rows"
    path = f"{root}/{area}/encoding={encoding}/kind={kind}"
    named = F.col(key).cast("string")
    keyed = (df if storable else as_text(df)).withColumn("key", F.when(named != "", named))
    keyed.hint("rebalance", "key").sortWithinPartitions("key").write.mode("append").parquet(path)
    return path


def write_partitioned(
    df: DataFrame, path: str, schema: T.StructType, by: Sequence[str] = SILVER_PARTITIONS
) -> None:
    """Commit a whole table, one folder per partition.

    Commits gather the rows of a partition into few files and still split a hot one.
    """
    commits.replace(conform(df, schema), path, by)


def upsert_partitioned(
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Sequence[str],
    by: Sequence[str] = SILVER_PARTITIONS,
    source: str | None = None,
) -> None:
    """Upsert into a partitioned table in one commit, rewriting only partitions that occur in the batch.

    Give a stored or materialised batch: it is read more than once.
    """
    rows = conform(batch, schema)
    stored = commits.read(batch.sparkSession, path, schema, only=rows.select(*by))
    commits.replace_touched(upsert(stored, rows, keys, order), path, by, source)


def rewrite_table(df: DataFrame, path: str) -> None:
    """Commit new content of a small unpartitioned table that it may have been read from."""
    commits.replace(df, path)


def load_slices(
    batch: DataFrame, path: str, spec: TableSpec, slices: Sequence[str] = ("DateId",)
) -> None:
    """Replace slices of a fact table stored by date, in one commit.

    Replacing whole dates only writes. Narrower slices first bring along what else the dates hold.
    """
    rows = conform(batch, spec.schema)
    if set(slices) != set(spec.partition):
        stored = commits.read(batch.sparkSession, path, spec.schema, only=rows.select(*spec.partition))
        rows = replace_slices(stored, rows, slices)
    commits.replace_touched(rows, path, spec.partition)


def create_tables(spark: SparkSession, root: str, specs: Sequence[TableSpec]) -> list[str]:
    """Create the tables that do not exist yet, empty; returns their names."""
    made = []
    for spec in specs:
        path = f"{root}/{spec.name}"
        if not commits.is_committed(spark, path):
            commits.replace(spark.createDataFrame([], spec.schema), path, spec.partition)
            made.append(spec.name)
    return made


def four_decimals(df: DataFrame) -> DataFrame:
    """Fractions and decimals as text with four places, other columns as they are."""

    def shown(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return fixed(F.col(f.name).cast("double"), "%.4f").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("decimal(38,4)").cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*[shown(f) for f in df.schema])


def export_csv(df: DataFrame, path: str) -> int:
    """Write CSV parts with a header; returns the number of rows, counted while writing."""
    counter = Observation()
    counted = four_decimals(df).observe(counter, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").option("header", "true").csv(path)
    return counter.get["rows"]


def write_export_log(spark: SparkSession, path: str, counts: dict[str, int]) -> None:
    """Row counts per exported file, one JSON line each."""
    now = dt.datetime.now(dt.timezone.utc).isoformat()
    rows = [(name, int(n), now) for name, n in counts.items()]
    spark.createDataFrame(rows, "file string, rows bigint, exported_at string").coalesce(1).write.mode("append").json(path)


def consolidated(prices: DataFrame, master: DataFrame) -> DataFrame:
    """One row per ticker and date, with the sector and industry of the ticker."""
    others = [c for c in prices.columns if c not in ("ticker", "date")]
    once = keep_first(prices, ["ticker", "date"], others)
    attributes = keep_first(master.select("ticker", "sector", "industry"), ["ticker"], ["sector", "industry"])
    return once.join(broadcast_if_small(attributes), "ticker", "left")


def export_per_ticker(prices: DataFrame, master: DataFrame, path: str) -> int:
    """A folder per ticker with date-sorted files.

    Rows are spread by ranges of (ticker, date): a small ticker fills one file and a hot one several that
    follow each other in time.
    """
    counter = Observation()
    spread = consolidated(prices, master).repartitionByRange("ticker", "date").sortWithinPartitions("ticker", "date")
    # Counted above the range exchange, which samples what lies below it.
    counted = spread.observe(counter, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("ticker").parquet(path)
    return counter.get["rows"]


def read_per_ticker(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``export_per_ticker`` wrote. Its folders are listed by LISTING_TASKS tasks; else each folder is one, up to 10,000."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(LISTING_TASKS))
    try:
        return spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(_LISTING, before)


def convert_files(spark: SparkSession, source: str, source_format: str, target: str, target_format: str) -> None:
    """CSV to Parquet or back. A CSV source needs a header; its types are inferred."""
    for name in (source_format, target_format):
        if name not in ("csv", "parquet"):
            raise ValueError("formats must be 'csv' or 'parquet'")
    if source_format == "csv":
        df = spark.read.option("header", "true").option("inferSchema", "true").csv(source)
    else:
        df = spark.read.parquet(source)
    if target_format == "csv":
        df.write.option("header", "true").csv(target)
    else:
        df.write.parquet(target)
