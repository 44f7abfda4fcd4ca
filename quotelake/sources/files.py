"""Reading landed files and stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.functions.names import column
from quotelake.functions.numeric import fractional_fields, nan_to_null
from quotelake.operators.snapshots import text_column
from quotelake.sources import commits
from quotelake.sources.paths import literal

Moment = dt.datetime | int | str | None

# Landed files by their encoding. The first two are of lakes that had a folder per key.
ENCODINGS = ("typed", "text", "typed_rows", "text_rows")


def _missing(error: AnalysisException) -> bool:
    return (error.getCondition() or "") in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, partitioned or not; empty when nothing was written yet. Committed tables are read as of the last commit.

    The declared schema also keeps partition values such as 007 or 1e5 the text they are.
    """
    if commits.is_committed(spark, path):
        return commits.read(spark, path, schema)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if _missing(error):
            return spark.createDataFrame([], schema)
        raise


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stored JSON lines; empty when nothing was written yet."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if _missing(error):
            return spark.createDataFrame([], schema)
        raise


def scan_files(
    spark: SparkSession, root: str, pattern: str = "*.parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Every matching Parquet file below ``root``, by column name, with NaN read as missing."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    return nan_as_missing(reader.parquet(root))


def modified_after(df: DataFrame, moment: Moment) -> DataFrame:
    """Only rows of files written after ``moment``; other files are pruned when the scan is planned.

    ``moment``: microseconds since 1970 in UTC (as a number or its text, what ``newest_file_time`` gives), or a
    time in the session's zone.
    """
    if moment is None:
        return df
    if isinstance(moment, int) or (isinstance(moment, str) and moment.isdecimal()):
        limit = F.timestamp_micros(F.lit(int(moment)))
    else:
        limit = F.lit(moment).cast("timestamp")
    return df.where(F.col("_metadata.file_modification_time") > limit)


def newest_file_time(df: DataFrame) -> int | None:
    """Latest write time among the files of a scan: the next watermark, taken from what was read.

    Microseconds since 1970 in UTC, so neither the driver's nor the session's time zone has a part in it.
    """
    return df.agg(F.max(F.unix_micros("_metadata.file_modification_time")).alias("t")).head()["t"]


def scan_new_files(
    spark: SparkSession, root: str, pattern: str, schema: T.StructType, since: Moment
) -> DataFrame:
    """Incremental scan of landed files; empty when there are none."""
    try:
        reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        return nan_as_missing(modified_after(reader.schema(schema).parquet(root), since))
    except AnalysisException as error:
        if _missing(error):
            return spark.createDataFrame([], schema)
        raise


def text_partitions(spark: SparkSession, path: str, partitions: Sequence[str], only: Sequence[str] = ()) -> DataFrame:
    """A partitioned table with open columns, its partition values read as text; ``only`` some of its files, where given."""
    reader = spark.read.option("basePath", path)
    files = [literal(f"{path}/{name}") for name in only] or [path]
    found = reader.option("mergeSchema", "true").parquet(*files).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name in partitions else f for f in found]
    return spark.read.option("basePath", path).schema(T.StructType(fields)).parquet(*files)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union over drifting columns: absent ones are NULL, columns whose types differ become text."""
    types: dict[str, set[str]] = {}
    for df in frames:
        for f in df.schema:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    mixed = {name for name, seen in types.items() if len(seen) > 1}

    def unified(df: DataFrame) -> DataFrame:
        return df.select(*[text_column(f) if f.name in mixed else column(f.name) for f in df.schema])

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [unified(df) for df in frames])


def bronze_frames(spark: SparkSession, root: str, area: str, kind: str) -> list[DataFrame]:
    """The landed files of a kind: a scan of each encoding that is present."""
    frames = []
    for encoding in ENCODINGS:
        try:
            frames.append(text_partitions(spark, f"{root}/{area}/encoding={encoding}/kind={kind}", ["key"]))
        except AnalysisException as error:
            if not _missing(error):
                raise
    return frames


def read_bronze_files(spark: SparkSession, root: str, area: str, kind: str, names: Sequence[str]) -> DataFrame:
    """Landed rows of the given files of a kind (paths below the area's folder); there is at least one."""
    frames = []
    for encoding in ENCODINGS:
        below = f"encoding={encoding}/kind={kind}/"
        own = [name.removeprefix(below) for name in names if name.startswith(below)]
        if own:
            frames.append(text_partitions(spark, f"{root}/{area}/{below}".rstrip("/"), ["key"], own))
    return nan_as_missing(union_by_name(frames))


def read_bronze(
    spark: SparkSession, root: str, area: str, kind: str, since: Moment = None
) -> DataFrame:
    """Landed rows of a kind, all of them or those in files written after ``since``."""
    frames = bronze_frames(spark, root, area, kind)
    if not frames:
        raise FileNotFoundError(f"nothing landed for {area}/{kind} below {root}")
    return nan_as_missing(union_by_name([modified_after(df, since) for df in frames]))


def nan_as_missing(df: DataFrame) -> DataFrame:
    """NaN is missing from here on; infinities stay until a table is loaded."""
    names = fractional_fields(df)
    return df.withColumns({c: nan_to_null(column(c)) for c in names}) if names else df


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Prediction CSV files with a header, columns found by name, dates as yyyy-MM-dd text."""
    raw = spark.read.option("header", "true").csv(path)
    day = {c: F.date_format(F.col(c).try_cast("date"), "yyyy-MM-dd").alias(c) for c in ("date", "exportDate")}
    return raw.select(
        *day.values(), "ticker", "sector", "industry", F.col("close").try_cast("double").alias("close")
    )


def read_log_lines(spark: SparkSession, path: str, pattern: str = "*.log") -> DataFrame:
    """One row per line of every log file, with its file name."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return reader.text(path).select(
        F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("file"), F.col("value").alias("line")
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    fetch_rows: int = 50_000,
    partition: tuple[str, int, int, int] | None = None,
    **options: str,
) -> DataFrame:
    """A database query, fetched in batches.

    ``partition`` = (numeric column, lower, upper, parts) splits the read over executors.
    """
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_rows).options(**options)
    if partition is None:
        return reader.option("query", query).load()
    column, lower, upper, parts = partition
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", parts)
        .load()
    )
