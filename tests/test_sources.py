import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake import session
from quotelake.operators.profile import columns_of, date_column, preview, profile, stage_counts
from quotelake.plans.bronze import land_prices
from quotelake.schemas import BRONZE_PRICES, PRICE_HISTORY
from quotelake.sources import control, files, sinks


def history(spark, *data):
    full = [(t, d, d.year, c, c, c, c, 1, c) for t, d, c in data]
    return spark.createDataFrame(full, PRICE_HISTORY)


D = dt.datetime


def test_partition_values_stay_text(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitioned(history(spark, ("007", D(2024, 1, 1), 1.0), ("1e5", D(2024, 1, 1), 2.0)), path, PRICE_HISTORY)
    assert {r["ticker"] for r in files.read_table(spark, path, PRICE_HISTORY).collect()} == {"007", "1e5"}
    raw = spark.createDataFrame([("007", 1.0)], "ticker string, v double")
    sinks.save_raw(raw, str(tmp_path / "b"), "ticker", "x")
    assert files.read_bronze(spark, str(tmp_path / "b"), "ticker", "x").head()["key"] == "007"


def test_upsert_rewrites_touched_partitions_only(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    base = history(spark, ("A", D(2023, 5, 1), 1.0), ("A", D(2024, 5, 1), 2.0), ("B", D(2024, 5, 1), 3.0))
    sinks.upsert_partitioned(base, path, PRICE_HISTORY, ["ticker", "date"], ["close"])
    untouched = os.path.join(path, "ticker=A", "year=2023")
    before = {f: os.stat(os.path.join(untouched, f)).st_mtime_ns for f in os.listdir(untouched)}
    batch = history(spark, ("A", D(2024, 5, 1), 9.0), ("A", D(2024, 5, 2), 4.0), ("C", D(2024, 1, 1), 5.0))
    for _ in range(2):
        sinks.upsert_partitioned(batch, path, PRICE_HISTORY, ["ticker", "date"], ["close"])
        got = files.read_table(spark, path, PRICE_HISTORY)
        assert rows(got, "ticker", "year", "close") == [
            ("A", 2023, 1.0),
            ("A", 2024, 4.0),
            ("A", 2024, 9.0),
            ("B", 2024, 3.0),
            ("C", 2024, 5.0),
        ]
    assert {f: os.stat(os.path.join(untouched, f)).st_mtime_ns for f in os.listdir(untouched)} == before


def test_save_raw_falls_back_to_text(spark, tmp_path):
    root = str(tmp_path)
    typed = spark.createDataFrame([("A", 1.5)], "ticker string, v double")
    sinks.save_raw(typed, root, "ticker", "info")
    odd = spark.range(1).select(
        F.lit("B").alias("ticker"), F.lit(2).alias("v"), F.lit(None).alias("nothing"), F.array(F.lit(1)).alias("list")
    )
    sinks.save_raw(odd, root, "ticker", "info")
    got = {r["ticker"]: (r["v"], r["list"]) for r in files.read_bronze(spark, root, "ticker", "info").collect()}
    assert got == {"A": ("1.5", None), "B": ("2", "[1]")}
    with pytest.raises(FileNotFoundError):
        files.read_bronze(spark, root, "ticker", "other")


def test_landed_files_do_not_grow_with_the_keys(spark, tmp_path):
    root = str(tmp_path)
    raw = spark.range(500).select(F.when(F.col("id") > 1, F.format_string("T%d", "id")).when(F.col("id") == 1, "").alias("ticker"), F.col("id").alias("v"))
    sinks.save_raw(raw, root, "ticker", "info")
    assert sum(name.endswith(".parquet") for _, _, names in os.walk(root) for name in names) < 50
    # what an older run landed in a folder per key is read as well
    raw.where("v = 7").withColumn("key", F.col("ticker")).write.partitionBy("key").parquet(f"{root}/ticker/encoding=typed/kind=info")
    got = files.read_bronze(spark, root, "ticker", "info").collect()
    assert sorted(r["v"] for r in got) == sorted([*range(500), 7])
    assert all(r["key"] == (r["ticker"] or None) for r in got)


def test_scans_by_pattern_and_time(spark, rows, tmp_path):
    root = str(tmp_path / "lake")
    df = spark.createDataFrame([(1, float("nan"))], "a int, x double")
    df.coalesce(1).write.parquet(f"{root}/one")
    first = files.newest_file_time(spark.read.parquet(f"{root}/one"))
    time.sleep(1.1)
    spark.createDataFrame([(2, 5.0)], "a int, x double").coalesce(1).write.parquet(f"{root}/two")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("x", T.DoubleType())])
    assert rows(files.scan_files(spark, root)) == [(1, None), (2, 5.0)]
    assert rows(files.scan_new_files(spark, root, "*.parquet", schema, first)) == [(2, 5.0)]
    assert rows(files.scan_new_files(spark, root, "*.parquet", schema, None)) == [(1, None), (2, 5.0)]
    assert files.scan_new_files(spark, f"{root}/none", "*.parquet", schema, None).isEmpty()
    assert files.read_table(spark, f"{root}/none", schema).isEmpty()


def test_union_of_drifting_frames(spark, rows):
    a = spark.createDataFrame([(1.5, "x")], "v double, s string")
    b = spark.createDataFrame([("bad", 7)], "v string, n int")
    assert rows(files.union_by_name([a, b]), "v", "s", "n") == [("1.5", "x", None), ("bad", None, 7)]


def test_watermarks(spark, tmp_path):
    root = str(tmp_path)
    assert control.load_watermark(spark, root, "silver", "never") == "never"
    control.save_watermark(spark, root, "silver", "2024-01-01")
    control.save_watermark(spark, root, "gold", "2020-01-01")
    control.save_watermark(spark, root, "silver", "2024-01-02")
    assert control.load_watermark(spark, root, "silver") == "2024-01-02"


def bronze(spark, *data):
    return spark.createDataFrame([(d, 1.0, 1.0, 1.0, 1.0, 1, t, "x") for t, d in data], BRONZE_PRICES).drop("extraction_timestamp")


def test_prices_land_once_and_late_tickers_keep_history(spark, tmp_path):
    root = str(tmp_path)
    first = bronze(spark, ("A", D(2024, 1, 1)), ("A", D(2024, 1, 2)))
    assert land_prices(first, root) == 2
    assert land_prices(first, root) == 0
    late = bronze(spark, ("A", D(2024, 1, 3)), ("B", D(2024, 1, 1)))
    assert land_prices(late, root) == 2
    assert control.load_watermark(spark, root, "prices") == "2024-01-03"
    assert files.read_bronze(spark, root, "ticker", "prices").count() == 4


def test_one_watermark_for_all(spark, tmp_path):
    root = str(tmp_path)
    data = bronze(spark, ("A", D(2015, 1, 1)), ("A", D(2024, 1, 2)))
    assert land_prices(data, root, per_ticker=False) == 1
    late = bronze(spark, ("B", D(2024, 1, 2)), ("B", D(2024, 1, 3)))
    assert land_prices(late, root, per_ticker=False) == 1


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_convert(spark, rows, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, 2.5)], "i int, s string, x double")
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    other = "parquet" if fmt == "csv" else "csv"
    df.write.option("header", "true").format(fmt).save(src)
    sinks.convert_files(spark, src, fmt, dst, other)
    assert rows(spark.read.option("header", "true").option("inferSchema", "true").format(other).load(dst)) == rows(df)
    with pytest.raises(ValueError):
        sinks.convert_files(spark, src, fmt, dst, "xlsx")


def test_export_per_ticker(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    data = history(spark, ("A", D(2024, 1, 2), 2.0), ("A", D(2024, 1, 1), 1.0), ("A", D(2024, 1, 1), 5.0), ("B", D(2024, 1, 1), 3.0))
    master = spark.createDataFrame([("A", "x", "tech", "chips")], "ticker string, company_name string, sector string, industry string")
    assert sinks.export_per_ticker(data, master, path) == 3
    assert sorted(d for d in os.listdir(path) if d.startswith("ticker")) == ["ticker=A", "ticker=B"]
    got = spark.read.parquet(path)
    assert rows(got, "ticker", "close", "sector") == [("A", 1.0, "tech"), ("A", 2.0, "tech"), ("B", 3.0, None)]


def test_exported_folders_are_listed_by_few_tasks(spark, tmp_path):
    path = str(tmp_path / "out")
    tickers = spark.range(100).select(F.concat(F.lit("t"), "id").alias("ticker"), F.col("id").cast("double").alias("close"))
    tickers.coalesce(1).write.partitionBy("ticker").parquet(path)
    before = spark.conf.get(sinks._LISTING)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        got = sinks.read_per_ticker(spark, path, "ticker string, close double")
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(k) for job in tracker.getJobIdsForGroup("listing") for k in tracker.getJobInfo(job).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages and all(s.numTasks <= sinks.LISTING_TASKS for s in stages)
    assert spark.conf.get(sinks._LISTING) == before and got.count() == 100 and got.columns == ["close", "ticker"]


def test_four_decimals_keep_nulls(spark):
    df = spark.createDataFrame([(1.23456, None, 3)], "x double, y double, n int")
    assert tuple(sinks.four_decimals(df).head()) == ("1.2346", None, 3)


def test_log_lines(spark, rows, tmp_path):
    (tmp_path / "gold.log").write_text("one\n two \n")
    (tmp_path / "other.txt").write_text("no\n")
    assert rows(files.read_log_lines(spark, str(tmp_path))) == [("gold.log", " two "), ("gold.log", "one")]


class Recorder:
    """Stands in for the reader, as no database is at hand."""

    def __init__(self):
        self.options_seen = {}

    read = property(lambda self: self)

    def format(self, name):
        self.options_seen["format"] = name
        return self

    def option(self, key, value):
        self.options_seen[key] = value
        return self

    def options(self, **kwargs):
        self.options_seen.update(kwargs)
        return self

    def load(self):
        return self.options_seen


def test_jdbc_options():
    seen = files.read_jdbc(Recorder(), "jdbc:x", "select 1", driver="d")
    assert seen == {"format": "jdbc", "url": "jdbc:x", "fetchsize": 50_000, "driver": "d", "query": "select 1"}
    split = files.read_jdbc(Recorder(), "jdbc:x", "select 1", partition=("DateId", 1, 9, 4))
    assert (split["dbtable"], split["numPartitions"], split["partitionColumn"]) == ("(select 1) q", 4, "DateId")


def test_shared_folder_comes_from_the_session(spark):
    assert session.work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_shared_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_profile_and_counts(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, D(2024, 1, 1)), (None, D(2024, 1, 2))], "n int, TradeDate timestamp")
    df.repartition(2).write.parquet(path)
    stored = spark.read.parquet(path)
    assert tuple(profile(stored).head()) == (2, D(2024, 1, 1), D(2024, 1, 2), 1, 0)
    assert rows(stage_counts({"silver": stored})) == [("silver", 2, len(stored.inputFiles()))]
    assert columns_of(stored) == [("n", "int"), ("TradeDate", "timestamp")]
    assert preview(stored, 1, ["TradeDate"]).head()["n"] == 1
    assert date_column(["x", "Date", "date"]) == "date"
    assert date_column(["n", "TradeDate"]) == "TradeDate"
    assert date_column(["n"]) is None
