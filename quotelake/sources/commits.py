"""Tables that change by commits: readers see the table as one commit left it, never half a write.

Layout of a table folder::

    ticker=A/year=2024/version=<v>/*.parquet     data, never changed once written
    _commits/folders/<v>/*.parquet               which folders a commit fills, and whether it replaces what they held
    _commits/<number>.json                       the commit itself

A writer adds data below a version of its own, lists the folders it filled, and then creates the numbered file by a rename that fails when the
number is taken. That file is what makes a commit: whatever a writer that died left behind is in no list, so nobody reads it. Two writers that started
from the same commit ask for the same number, and the later one gets ``Conflict``.

Readers resolve the log: a folder holds its versions from the last commit that replaced it on. Every COMPACT_EVERY commits one lists all live folders
again, so a reader never goes through more than that. The list of live folders is on the driver while a scan is planned, as the listing of any partitioned
table is.

Needs a file system with an atomic rename (HDFS, local disks). ``unreferenced`` lists the folders that nobody reads any more.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.sources.paths import create_once, names

LOG = "_commits"
VERSION = "version"
COMPACT_EVERY = 20

FOLDERS = "folder string, keys map<string,string>, version string, number long, replaces boolean"


class Conflict(RuntimeError):
    """Another writer committed first; read again and repeat."""


# --- reading


def last_number(spark: SparkSession, path: str) -> int:
    """The number of the last commit; 0 when there is none."""
    numbers = [n for n in names(spark, f"{path}/{LOG}") if n.endswith(".json") and not n.startswith("_")]
    return int(numbers[-1].split(".")[0]) if numbers else 0


def _entry(path: str, number: int) -> str:
    return f"{path}/{LOG}/{number:012d}.json"


def _entries(spark: SparkSession, path: str, numbers: Sequence[int]) -> list[dict]:
    lines = spark.read.option("wholetext", "true").text([_entry(path, n) for n in numbers]).collect()
    return sorted((json.loads(r["value"]) for r in lines), key=lambda e: e["number"])


def live_folders(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """folder, keys, version, number of every folder version that readers of a commit (the last one) see."""
    number = last_number(spark, path) if number is None else number
    if number == 0:
        return spark.createDataFrame([], FOLDERS).drop("replaces")
    base = _entries(spark, path, [number])[0]["base"]
    versions = [e["version"] for e in _entries(spark, path, range(base, number + 1))]
    rows = spark.read.schema(FOLDERS).parquet(*[f"{path}/{LOG}/folders/{v}" for v in versions])
    cut = rows.where("replaces").groupBy(F.col("folder").alias("_f")).agg(F.max("number").alias("_cut"))
    seen = rows.join(cut, F.col("folder") == F.col("_f"), "left").where("_cut is null or number >= _cut")
    # a replaced folder that got nothing has a row without a version
    return seen.where("version is not null").select("folder", "keys", "version", "number")


def read(
    spark: SparkSession, path: str, schema: T.StructType, number: int | None = None, after: int = 0, only: DataFrame | None = None
) -> DataFrame:
    """The table as of a commit (the last one). ``after``: only what later commits than that wrote and still stands.
    ``only``: a frame with partition columns; folders of other values are not read."""
    live = live_folders(spark, path, number).where(F.col("number") > after)
    if only is not None:
        wanted = only.select(*[F.col(c).cast("string").alias(f"_w{k}") for k, c in enumerate(only.columns)]).distinct()
        same = [F.col("keys")[c].eqNullSafe(F.col(f"_w{k}")) for k, c in enumerate(only.columns)]
        live = live.join(wanted, same, "left_semi")
    folders = [f"{path}/{r['folder']}{VERSION}={r['version']}" for r in live.select("folder", "version").collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    # names are kept as text, whatever they look like
    declared = T.StructType([*schema, T.StructField(VERSION, T.StringType())])
    return spark.read.schema(declared).option("basePath", path).parquet(*sorted(folders)).select(*schema.fieldNames())


def is_committed(spark: SparkSession, path: str) -> bool:
    return last_number(spark, path) > 0


def has_source(spark: SparkSession, path: str, source: str) -> bool:
    """Whether a commit already recorded this source (a stream's query and batch)."""
    if not is_committed(spark, path):
        return False
    entries = spark.read.schema("source string").json(f"{path}/{LOG}/[0-9]*.json")
    return not entries.where(F.col("source") == source).isEmpty()


# --- writing


def _write_data(df: DataFrame, path: str, by: Sequence[str], version: str) -> None:
    rows = (df.hint("rebalance", *by) if by else df).withColumn(VERSION, F.lit(version))
    rows.write.mode("append").partitionBy(*by, VERSION).parquet(path)


def _filled(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str], version: str, number: int, replaces: bool) -> DataFrame:
    """A row per folder that a version filled."""
    places = "/*" * len(by)
    fields = [f for f in schema if f.name in by]
    try:
        found = spark.read.schema(T.StructType([*fields, T.StructField(VERSION, T.StringType())])).option("basePath", path).parquet(f"{path}{places}/{VERSION}={version}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FOLDERS)
    # rows are counted by file, so nothing is made of a path for each row; a partition's folder is the end of its files' paths
    files = found.groupBy(F.col("_metadata.file_path").alias("_file"), *[F.col(c).cast("string").alias(f"_k{k}") for k, c in enumerate(by)]).count()
    part = re.compile(r"((?:[^/]+/){%d})" % len(by) + f"{VERSION}=[^/]+/[^/]+$")
    folders = {part.search(r["_file"]).group(1): {c: r[f"_k{k}"] for k, c in enumerate(by)} or None for r in files.collect()}
    # the scan tells paths as URIs; the log keeps them as the file system has them
    plain = [(unquote(folder), keys, version, number, replaces) for folder, keys in folders.items()]
    return spark.createDataFrame(plain, FOLDERS)


def _list_folders(rows: DataFrame, path: str, version: str) -> None:
    rows.coalesce(1).write.parquet(f"{path}/{LOG}/folders/{version}")


def _publish(spark: SparkSession, path: str, entry: dict) -> None:
    if not create_once(spark, _entry(path, entry["number"]), json.dumps(entry)):
        raise Conflict(f"commit {entry['number']} of {path} was made by another writer")


def _emptied(spark: SparkSession, path: str, before: int, gone: DataFrame, number: int) -> DataFrame:
    """A row without a version for every live folder of the given partitions."""
    values = gone.select(*[F.col(c).cast("string").alias(f"_w{k}") for k, c in enumerate(gone.columns)]).distinct()
    same = [F.col("keys")[c].eqNullSafe(F.col(f"_w{k}")) for k, c in enumerate(gone.columns)]
    found = live_folders(spark, path, before).join(values, same, "left_semi")
    empty = F.lit(None).cast("string").alias("version")
    return found.dropDuplicates(["folder"]).select("folder", "keys", empty, F.lit(number).cast("long").alias("number"), F.lit(True).alias("replaces"))


def _commit(
    df: DataFrame, path: str, by: Sequence[str], replaces: bool, everything: bool, source: str | None, gone: DataFrame | None = None
) -> int:
    spark = df.sparkSession
    before = last_number(spark, path)
    number = before + 1
    if before == 0 and any(n != LOG and not n.startswith((".", "_")) and not _versions_only(spark, f"{path}/{n}", len(by)) for n in names(spark, path)):
        raise RuntimeError(f"{path} holds files that no commit made")
    version = f"{number:012d}-{uuid.uuid4().hex}"
    _write_data(df, path, by, version)
    rows = _filled(spark, path, df.schema, by, version, number, replaces)
    if gone is not None and before:
        emptied = _emptied(spark, path, before, gone, number).join(rows.select(F.col("folder").alias("_f")), F.col("folder") == F.col("_f"), "left_anti")
        rows = rows.unionByName(emptied)
    base = before and _entries(spark, path, [before])[0]["base"]
    if everything:
        base = number
    elif before == 0 or number - base >= COMPACT_EVERY:
        old = live_folders(spark, path, before).withColumn("replaces", F.lit(False))
        if replaces:
            old = old.join(rows.select(F.col("folder").alias("_f")), F.col("folder") == F.col("_f"), "left_anti")
        rows = old.unionByName(rows.where("version is not null").withColumn("replaces", F.lit(False)))
        base = number
    _list_folders(rows, path, version)
    made = dt.datetime.now(dt.timezone.utc).isoformat()
    _publish(spark, path, {"number": number, "version": version, "base": base, "source": source, "at": made})
    return number


def _versions_only(spark: SparkSession, folder: str, depth: int) -> bool:
    """Whether a folder is what a writer that died before the first commit may have left."""
    if depth == 0:
        return folder.rsplit("/", 1)[-1].startswith(f"{VERSION}=")
    return all(_versions_only(spark, f"{folder}/{n}", depth - 1) for n in names(spark, folder))


def replace(df: DataFrame, path: str, by: Sequence[str] = (), source: str | None = None) -> int:
    """Commit a whole new content, which may have been read from the table; returns the commit's number."""
    return _commit(df, path, by, True, True, source)


def replace_touched(df: DataFrame, path: str, by: Sequence[str], source: str | None = None, gone: DataFrame | None = None) -> int:
    """Commit new content of the partitions that occur in ``df``; those that occur in ``gone`` only lose theirs, the others stay."""
    return _commit(df, path, by, True, False, source, gone)


def append(df: DataFrame, path: str, by: Sequence[str] = (), source: str | None = None) -> int:
    """Commit further rows."""
    return _commit(df, path, by, False, False, source)


def unreferenced(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str] = ()) -> DataFrame:
    """folder, version of data that the last commit does not read: older versions, and what writers that died left. A writer at work is among them."""
    fields = [T.StructField(c, T.StringType()) for c in (*by, VERSION)]
    found = spark.read.schema(T.StructType(fields)).option("basePath", path).parquet(f"{path}{'/*' * len(by)}/{VERSION}=*")
    part = r"((?:[^/]+/){%d})" % len(by) + f"{VERSION}=[^/]+/[^/]+$"
    there = found.select(F.regexp_extract("_metadata.file_path", part, 1).alias("folder"), VERSION).distinct()
    plain = F.url_decode(F.replace("folder", F.lit("+"), F.lit("%2B")))
    live = live_folders(spark, path).select("folder", VERSION)
    return there.withColumn("folder", plain).join(live, ["folder", VERSION], "left_anti")
