"""File manifests, their verification, log rules and the chain of custody."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.operators import large_files
from quotelake.sources.paths import literal, relative_path

# What marks a log line as critical.
CRITICAL_TEXTS = ("FATAL", "CRITICAL", "Traceback", "Exception:", "PermissionError", "ConnectionRefused")
CRITICAL_PATTERNS = (r"(?i)\b0 rows\b",)

# A file that is hashed whole travels as one row, which holds at most 2 GiB.
MAX_FILE_BYTES = 2**31 - 1024

# Files that a scan is given by name; a list of names is on the driver.
MAX_NAMED = 100_000


class IntegrityError(RuntimeError):
    """A gate found missing, altered or suspicious output."""


def file_hashes(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, sha256, length) of every matching file below ``root``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return _hashed(reader.load(root), root)


def hashes_of(spark: SparkSession, root: str, files: DataFrame, pattern: str = "*.parquet") -> DataFrame:
    """(path, sha256, length) of the given files (column path) below ``root``; no other file is opened.

    Their names go into the scan; beyond MAX_NAMED files the whole folder is scanned instead.
    """
    named = [r["path"] for r in files.select("path").limit(MAX_NAMED + 1).collect()]
    if len(named) > MAX_NAMED:
        return file_hashes(spark, root, pattern).join(files.select("path"), "path", "left_semi")
    if not named:
        return spark.createDataFrame([], "path string, sha256 string, length long")
    return _hashed(spark.read.format("binaryFile").load([literal(f"{root.rstrip('/')}/{name}") for name in named]), root)


def _hashed(files: DataFrame, root: str) -> DataFrame:
    """The files' hashes; files above ``large_files.RANGE_BYTES`` are hashed at once, a range a task, the others when the result is read."""
    checked = F.when(
        F.col("length") > MAX_FILE_BYTES, F.raise_error(F.concat(F.lit("file too large to hash: "), F.col("path")))
    ).otherwise(F.sha2("content", 256))
    spark, limit, name = files.sparkSession, large_files.RANGE_BYTES, relative_path(F.col("path"), root).alias("path")
    large = [
        large_files.LargeFile(r["path"], r["length"], r["uri"])
        for r in files.where(F.col("length") > limit).select("path", "length", F.col("_metadata.file_path").alias("uri")).collect()
    ]
    if not large:
        return files.select(name, checked.alias("sha256"), "length")
    found = files.where(F.col("length") <= limit).select(name, checked.alias("sha256"), "length")
    packed = [f.path for f in large if f.path.endswith(large_files.PACKED)]
    if packed:
        rows = spark.read.format("binaryFile").load([literal(p) for p in packed])
        found = found.unionAll(rows.select(name, checked.alias("sha256"), "length"))
    plain = [f for f in large if not f.path.endswith(large_files.PACKED)]
    if plain:
        hashes = large_files.sha256_by_ranges(spark, plain)
        rows = [(f.path, h, f.length) for f, h in zip(plain, hashes, strict=True)]
        found = found.unionAll(spark.createDataFrame(rows, "path string, sha256 string, length long").select(name, "sha256", "length"))
    return found


def _lines_hash(lines: Column) -> Column:
    return F.sha2(F.array_join(F.sort_array(F.collect_list(lines)), "\n"), 256)


def manifest_hash(files: DataFrame) -> DataFrame:
    """One row: the composite hash over the files and their number.

    The "path:sha256" lines are hashed in order per bucket (the first four hex digits of the path's md5), then the "bucket:sha256" lines
    in order. So no task holds all lines, and the hash means the same at any number of files.
    """
    return tree_hash(bucket_hashes(files))


def bucket_of(path: str = "path") -> Column:
    """The bucket of a file: the first four hex digits of its path's md5. The first two are the prefix that buckets are stored by."""
    return F.substring(F.md5(path), 1, 4)


def bucket_hashes(files: DataFrame) -> DataFrame:
    """prefix, bucket, sha256, n: the inner nodes of a manifest."""
    line = F.concat_ws(":", "path", "sha256")
    nodes = files.groupBy(bucket_of().alias("bucket")).agg(_lines_hash(line).alias("sha256"), F.count(F.lit(1)).alias("n"))
    return nodes.select(F.substring("bucket", 1, 2).alias("prefix"), "bucket", "sha256", "n")


def tree_hash(nodes: DataFrame) -> DataFrame:
    """One row: the composite hash over the buckets (65536 at most) and the number of files."""
    return nodes.agg(
        _lines_hash(F.concat_ws(":", "bucket", "sha256")).alias("manifest_hash"), F.coalesce(F.sum("n"), F.lit(0)).alias("file_count")
    )


def compare_listing(recorded: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Recorded files (path, sha256, length, modified) that are there as they were, and found files whose length or time changed."""
    there = found.select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    both = recorded.join(there, "path")
    same = (F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified"))
    return both.where(same).select("path", "sha256"), both.where(~same).select("path")


def compare_files(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """(path, status) for every recorded or found file: ok, tampered, missing or unlisted."""
    old = recorded.select("path", F.col("sha256").alias("_old"))
    new = found.select("path", F.col("sha256").alias("_new"))
    status = (
        F.when(F.col("_new").isNull(), "missing")
        .when(F.col("_old").isNull(), "unlisted")
        .when(F.col("_old") == F.col("_new"), "ok")
        .otherwise("tampered")
    )
    return old.join(new, "path", "full_outer").select("path", status.alias("status"))


def require_intact(compared: DataFrame) -> None:
    """Raise when a recorded file is missing or altered. Unlisted files do not matter."""
    bad = compared.where(F.col("status").isin("missing", "tampered"))
    counts = {r["status"]: r["n"] for r in bad.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts:
        shown = [f"{r['path']} ({r['status']})" for r in bad.orderBy("path").limit(20).collect()]
        raise IntegrityError(f"manifest check failed {counts}: " + ", ".join(shown))


def is_critical(line: Column) -> Column:
    low = F.lower(line)
    hit = F.lit(False)
    for text in CRITICAL_TEXTS:
        hit = hit | low.contains(text.lower())
    for pattern in CRITICAL_PATTERNS:
        hit = hit | line.rlike(pattern)
    return hit


def text_lines(texts: DataFrame, text: str = "text") -> DataFrame:
    """Documents to one row per line, in column ``line``."""
    others = [c for c in texts.columns if c != text]
    return texts.select(*others, F.explode(F.split(text, "\r\n|\r|\n")).alias("line"))


def log_issues(lines: DataFrame, line: str = "line") -> DataFrame:
    """The critical lines, trimmed."""
    return lines.where(is_critical(F.col(line))).withColumn(line, F.trim(line))


def log_status(lines: DataFrame, line: str = "line") -> DataFrame:
    """One row: OK or CRITICAL, and the number of critical lines."""
    hits = F.count_if(is_critical(F.col(line)))
    return lines.agg(F.when(hits > 0, "CRITICAL").otherwise("OK").alias("status"), hits.alias("issues"))
