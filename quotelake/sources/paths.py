"""Names and times of files, through the file system that Spark reads and writes with."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = "path string, length long, modified long"


def _place(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, by name; empty when it does not exist."""
    files, where = _place(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content at once; False when it exists already."""
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/_draft-{uuid.uuid4().hex}-{name}"
    files, where = _place(spark, draft)
    out = files.create(where, False)
    out.write(bytearray(text.encode()))
    out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(where, _place(spark, path)[1], plain)
    except Py4JJavaError as error:
        files.delete(where, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def set_modified(spark: SparkSession, path: str, milliseconds: int) -> None:
    """Date a file back or forth, as a copy that keeps times does."""
    files, where = _place(spark, path)
    files.setTimes(where, milliseconds, -1)


def remove(spark: SparkSession, path: str) -> None:
    """Delete one file."""
    files, where = _place(spark, path)
    files.delete(where, False)


def relative_path(path: Column, root: str) -> Column:
    """The part of a file path below ``root``, whatever scheme either is written with."""
    plain_root = root.split(":", 1)[-1] if "://" in root or root.startswith("file:") else root
    plain_root = "/" + plain_root.strip("/") + "/"
    plain = F.regexp_replace(path, r"^[a-z0-9]+:/*", "/")
    return F.substring(plain, len(plain_root) + 1, 1_000_000)


def literal(path: str) -> str:
    """A path that stands for itself where patterns are allowed."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def listing(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """path (below ``root``), length and modified (microseconds since 1970) of every matching file; nothing is opened. Empty when there is no such folder."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE)
    return files.select(relative_path(F.col("path"), root).alias("path"), "length", F.unix_micros("modificationTime").alias("modified"))
