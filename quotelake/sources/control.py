"""Control tables: watermarks, ledgers of files, content hashes, manifests and the chain of custody.

All are append-only and written after the data they describe, so a run that dies in between is repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.operators.integrity import (
    IntegrityError,
    bucket_hashes,
    compare_files,
    compare_listing,
    file_hashes,
    hashes_of,
    log_issues,
    require_intact,
    tree_hash,
)
from quotelake.operators.sizing import broadcast_if_small, materialised
from quotelake.schemas import CUSTODY, CUSTODY_ISSUES, LEAVES, MANIFEST, NODES, TAKEN, TICKER_WATERMARK, WATERMARK
from quotelake.sources import commits
from quotelake.sources.files import read_json, read_table
from quotelake.sources.paths import listing


def load_watermark(spark: SparkSession, root: str, name: str, default: str | None = None) -> str | None:
    marks = read_table(spark, f"{root}/watermarks", WATERMARK).where(F.col("name") == name)
    row = marks.agg(F.max_by("value", "saved_at").alias("value")).head()
    return row["value"] if row["value"] is not None else default


def save_watermark(spark: SparkSession, root: str, name: str, value: str) -> None:
    row = spark.range(1).select(
        F.lit(name).alias("name"), F.lit(value).alias("value"), F.current_timestamp().alias("saved_at")
    )
    row.write.mode("append").parquet(f"{root}/watermarks")


def load_ticker_watermarks(spark: SparkSession, root: str) -> DataFrame:
    """The last landed date of every ticker."""
    rows = read_table(spark, f"{root}/ticker_watermarks", TICKER_WATERMARK)
    return rows.groupBy("ticker").agg(F.max("last_date").alias("last_date"))


def save_ticker_watermarks(batch: DataFrame, root: str, date: str = "date") -> None:
    """Append the last date per ticker of a batch; tickers it lacks keep theirs."""
    marks = batch.groupBy("ticker").agg(F.max(F.to_date(date)).alias("last_date"))
    marks.where(F.col("last_date").isNotNull()).write.mode("append").parquet(f"{root}/ticker_watermarks")


def unseen(found: DataFrame, taken: DataFrame) -> DataFrame:
    """Files (path, length, modified) that are not in a ledger of taken ones, whatever their time.

    Folders whose files are as many and hash to the same sum on both sides are left out first, so the files of folders at rest are not compared one by one.
    """
    folder = F.regexp_extract("path", r"^(.*?)[^/]*$", 1).alias("_folder")
    key = F.xxhash64("path", "length", "modified").cast("decimal(20,0)")

    def sums(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(folder).agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(key).alias("sum")).alias(name))

    there, before = found.select("path", "length", "modified"), taken.select("path", "length", "modified").distinct()
    both = sums(there, "_now").join(sums(before, "_then"), "_folder", "left")
    moved = broadcast_if_small(materialised(both.where(~F.col("_now").eqNullSafe(F.col("_then"))).select("_folder"), "folders"))
    fresh, old = (rows.withColumn("_folder", folder).join(moved, "_folder", "left_semi").drop("_folder") for rows in (there, before))
    return fresh.join(old, ["path", "length", "modified"], "left_anti")


def unseen_files(
    spark: SparkSession, control: str, name: str, root: str, pattern: str = "*.parquet", within: Column | None = None
) -> DataFrame:
    """Files below ``root`` (those that ``within`` holds for) that the ledger ``name`` does not hold; stored, so they can be read and then recorded."""
    taken, found = read_table(spark, f"{control}/ledgers/{name}", TAKEN), listing(spark, root, pattern)
    return materialised(unseen(found if within is None else found.where(within), taken), "unseen")


def record_files(files: DataFrame, control: str, name: str) -> None:
    """Enter files into a ledger, once what they hold is stored. Now and then the ledger's small files become few, in order of their folders."""
    spark, path = files.sparkSession, f"{control}/ledgers/{name}"
    number = commits.append(files.select(*TAKEN.fieldNames()), path)
    if number % commits.COMPACT_EVERY == 0:
        commits.replace(read_table(spark, path, TAKEN).distinct().repartitionByRange("path").sortWithinPartitions("path"), path)


def _hash_schema(keys: Sequence[str]) -> T.StructType:
    names = [*keys, "content_hash"]
    columns = [T.StructField(n, T.StringType()) for n in names]
    return T.StructType([*columns, T.StructField("run_ts", T.TimestampType())])


def load_hashes(spark: SparkSession, root: str, name: str, keys: Sequence[str]) -> DataFrame:
    """The latest content hash per logical key."""
    rows = read_table(spark, f"{root}/content_hashes/{name}", _hash_schema(keys))
    return rows.groupBy(*keys).agg(F.max_by("content_hash", "run_ts").alias("content_hash"))


def save_hashes(compared: DataFrame, root: str, name: str, keys: Sequence[str]) -> None:
    fresh = compared.where(F.col("status") != "unchanged")
    rows = fresh.select(
        *[F.col(k).cast("string").alias(k) for k in keys], "content_hash", F.current_timestamp().alias("run_ts")
    )
    rows.write.mode("append").parquet(f"{root}/content_hashes/{name}")


def build_manifest(
    spark: SparkSession, data: str, control: str, stage: str, pattern: str = "*.parquet", full: bool = False
) -> str:
    """Bring the manifest of a stage up to date with its output files; returns the composite hash.

    The manifest is a hash tree. Files that the last one lists with the same length and time keep their hash, so only new and
    changed files are opened, and only the buckets they are in are hashed and written anew. ``full`` opens every file. The
    head is written last: a build that dies leaves the manifest as it was.
    """
    made = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    root = f"{control}/manifests/{stage}"
    head = _newest_head(spark, control, stage)
    numbers = {"leaves": head["leaves"], "nodes": head["nodes"]} if head else {"leaves": 0, "nodes": 0}
    known = commits.read(spark, f"{root}/leaves", LEAVES, numbers["leaves"])
    found = materialised(listing(spark, data, pattern), "listing")
    same = ["path", "length", "modified"]
    trusted = known if head and not full and _same_folder(head["output_dir"], data) else known.limit(0)
    kept = found.join(trusted.select(*same, "sha256"), same)
    fresh = found.join(trusted.select(*same), same, "left_anti")
    hashed = materialised(hashes_of(spark, data, fresh, pattern).drop("length").join(fresh, "path"), "hashed")
    gone = known.select(*same).join(found, same, "left_anti")
    prefix = F.substring(F.md5("path"), 1, 2).alias("prefix")
    touched = materialised(hashed.select(prefix).union(gone.select(prefix)).distinct(), "touched")
    rows = kept.unionByName(hashed).select(prefix, "path", "sha256", "length", "modified")
    if any(commits.last_number(spark, f"{root}/{name}") != n for name, n in numbers.items()) or head is None:
        # the first build, or one after a build that died between its commits: the tree is written whole
        numbers["leaves"] = commits.replace(materialised(rows, "leaves"), f"{root}/leaves", ("prefix",))
        leaves = commits.read(spark, f"{root}/leaves", LEAVES, numbers["leaves"])
        numbers["nodes"] = commits.replace(bucket_hashes(leaves), f"{root}/nodes", ("prefix",))
    elif not touched.isEmpty():
        leaves = materialised(rows.join(F.broadcast(touched), "prefix", "left_semi"), "leaves")  # 256 prefixes at most
        numbers["leaves"] = commits.replace_touched(leaves, f"{root}/leaves", ("prefix",), gone=touched)
        numbers["nodes"] = commits.replace_touched(bucket_hashes(leaves), f"{root}/nodes", ("prefix",), gone=touched)
    whole = tree_hash(commits.read(spark, f"{root}/nodes", NODES, numbers["nodes"])).select(
        F.lit(stage).alias("stage"),
        F.lit(made).alias("generated_at"),
        F.lit(data).alias("output_dir"),
        "manifest_hash",
        "file_count",
        F.lit(hashed.count()).cast("long").alias("hashed"),
        *[F.lit(n).cast("long").alias(name) for name, n in numbers.items()],
    )
    whole.write.mode("append").json(f"{root}/heads")
    return load_manifest(spark, control, stage)[0]["manifest_hash"]


def _same_folder(one: str, other: str) -> bool:
    plain = [f"/{p.split(':', 1)[-1] if ':' in p else p}".replace("//", "/").replace("//", "/").rstrip("/") for p in (one, other)]
    return plain[0] == plain[1]


def _newest_head(spark: SparkSession, control: str, stage: str):
    heads = read_json(spark, f"{control}/manifests/{stage}/heads", MANIFEST)
    return heads.orderBy(F.col("generated_at").desc()).head()


def load_manifest(spark: SparkSession, control: str, stage: str):
    """The newest manifest head of a stage and its file list."""
    head = _newest_head(spark, control, stage)
    if head is None:
        raise IntegrityError(f"stage {stage} has no manifest")
    return head, commits.read(spark, f"{control}/manifests/{stage}/leaves", LEAVES, head["leaves"])


def verify_manifest(
    spark: SparkSession, control: str, stage: str, expected: str | None = None, pattern: str = "*.parquet", full: bool = False
) -> str:
    """Check the listed files; raise when one is missing or altered, or the composite differs.

    A file with the length and time it had counts as unaltered; others are hashed again. ``full`` hashes every listed file, and so
    finds what kept both.
    """
    head, recorded = load_manifest(spark, control, stage)
    if full:
        hashes = file_hashes(spark, head["output_dir"], pattern).join(recorded.select("path"), "path", "left_semi")
        nodes = bucket_hashes(recorded)
    else:
        same, changed = compare_listing(recorded, listing(spark, head["output_dir"], pattern))
        hashes = same.unionByName(hashes_of(spark, head["output_dir"], changed, pattern).drop("length"))
        nodes = commits.read(spark, f"{control}/manifests/{stage}/nodes", NODES, head["nodes"])
    require_intact(compare_files(recorded, hashes))
    actual = tree_hash(nodes).head()["manifest_hash"]
    if actual != head["manifest_hash"] or (expected is not None and actual != expected):
        wanted = expected or head["manifest_hash"]
        raise IntegrityError(f"composite hash of stage {stage} is {actual}, expected {wanted}")
    return actual


def record_custody(spark: SparkSession, control: str, stage: str, log_lines: DataFrame | None) -> str:
    """Append one custody record about the newest manifest and the log; returns PASSED or FAILED.

    Issues are stored as rows and the files stay in the manifest listing, so neither list is ever
    gathered into one record.
    """
    head, _ = load_manifest(spark, control, stage)
    now = dt.datetime.now(dt.timezone.utc).isoformat()
    issue_count = 0
    if log_lines is not None:
        issues = log_issues(log_lines).select(F.lit(stage).alias("stage"), F.lit(now).alias("timestamp"), "line")
        issues.write.mode("append").json(f"{control}/custody_issues")
        issue_count = custody_issues(spark, control, stage, now).count()
    record = spark.range(1).select(
        F.lit(stage).alias("stage"),
        F.lit(head["manifest_hash"]).alias("manifest_hash"),
        F.lit(head["file_count"]).cast("bigint").alias("file_count"),
        F.lit(head["generated_at"]).alias("manifest"),
        F.lit(now).alias("timestamp"),
        F.lit("CRITICAL" if issue_count else "OK").alias("log_analysis"),
        F.lit(issue_count).cast("bigint").alias("issue_count"),
        F.lit("FAILED" if issue_count else "PASSED").alias("verdict"),
    )
    record.write.mode("append").json(f"{control}/custody")
    return "FAILED" if issue_count else "PASSED"


def custody_tail(spark: SparkSession, control: str, n: int = 5) -> DataFrame:
    """The last entries of the chain of custody."""
    entries = spark.read.schema(CUSTODY).json(f"{control}/custody")
    return entries.orderBy(F.col("timestamp").desc()).limit(n)


def custody_issues(spark: SparkSession, control: str, stage: str, timestamp: str) -> DataFrame:
    """The critical log lines behind one custody record."""
    rows = spark.read.schema(CUSTODY_ISSUES).json(f"{control}/custody_issues")
    return rows.where((F.col("stage") == stage) & (F.col("timestamp") == timestamp))


def gate(
    spark: SparkSession, control: str, stage: str, log_lines: DataFrame | None, expected: str | None = None, full: bool = False
) -> None:
    """Verify the manifest (``full``: hash every file), record custody, and raise when the log holds a critical line."""
    verify_manifest(spark, control, stage, expected, full=full)
    if record_custody(spark, control, stage, log_lines) == "FAILED":
        entry = custody_tail(spark, control, 1).head()
        shown = custody_issues(spark, control, stage, entry["timestamp"]).limit(20).collect()
        raise IntegrityError(
            f"stage {stage} blocked by {entry['issue_count']} log lines:\n" + "\n".join(f"  - {r['line']}" for r in shown)
        )
