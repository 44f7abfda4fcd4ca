"""Landing of nested and wide snapshots, file formats, previews and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotelake.operators import profile, snapshots
from quotelake.plans import testbed as tb
from quotelake.plans.bronze import land_prices
from quotelake.plans.catalog.registry import query
from quotelake.session import work_folder
from quotelake.sources.files import read_bronze, read_log_lines, scan_files
from quotelake.sources.sinks import convert_files, export_per_ticker, read_per_ticker, save_raw


@query("SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def snapshot_rows(spark, folder):
    """One JSON object per row to columns."""
    return snapshots.parse_snapshot(tb.table(spark, folder, "events"), "props", "k bigint", ["event_id", "event_type"])


_K = "json_extract_string(props, '$.k')"


@query(f"""SELECT event_id, event_type AS category, 0 AS item, {_K} AS k, NULL AS user FROM events
    UNION ALL SELECT event_id, 'listed', 0, {_K}, NULL FROM events
    UNION ALL SELECT event_id, 'listed', 1, NULL, CAST(user_id AS VARCHAR) FROM events""")
def flatten_nested(spark, folder):
    """Categories that hold an object or a list of objects; scalars and scalar list items give nothing."""
    payload = F.format_string(
        '{"%s": %s, "listed": [%s, {"user": %d}, 5], "count": 2}',
        F.col("event_type"),
        F.col("props"),
        F.col("props"),
        F.col("user_id"),
    )
    events = tb.table(spark, folder, "events").select("event_id", payload.alias("payload"))
    flat = snapshots.flatten_categories(events, "payload", ["event_id"])
    return snapshots.widen(flat, "fields", ["k", "user"])


_QUARTERS = "SELECT o_orderpriority AS ticker, o_orderstatus AS item, quarter(o_orderdate) AS q, max(o_totalprice) AS v FROM orders GROUP BY 1, 2, 3"


@query(f"""SELECT ticker, 'Q' || q AS period, max(v) FILTER (WHERE item = 'F') AS F, max(v) FILTER (WHERE item = 'O') AS O,
    max(v) FILTER (WHERE item = 'P') AS P FROM ({_QUARTERS}) GROUP BY 1, 2""")
def statement_transpose(spark, folder):
    """Items by periods, turned to periods by items."""
    orders = tb.table(spark, folder, "orders").withColumn("q", F.concat(F.lit("Q"), F.quarter("o_orderdate")))
    by_item = orders.groupBy(F.col("o_orderpriority").alias("ticker"), F.col("o_orderstatus").alias("item"))
    statement = by_item.pivot("q").agg(F.max("o_totalprice"))
    return snapshots.transpose_statement(statement, ["ticker"], "item")


@query(f"""SELECT event_id, event_type AS kind, CASE WHEN event_id % 3 = 0 THEN {_K} ELSE event_type END AS top,
    {_K} AS k, CASE WHEN event_id % 2 = 0 THEN 'even' END AS even FROM events""")
def snapshot_merge(spark, folder):
    """Three maps laid over each other; the later wins, a missing one changes nothing."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k")
    base = F.create_map(F.lit("kind"), kind, F.lit("top"), kind, F.lit("k"), F.lit("-"))
    middle = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("even"), F.lit("even")))
    last = F.when(F.col("event_id") % 3 == 0, F.create_map(F.lit("top"), k, F.lit("k"), k)).otherwise(
        F.create_map(F.lit("k"), k)
    )
    merged = tb.table(spark, folder, "events").select("event_id", snapshots.overlay(base, middle, last).alias("m"))
    return snapshots.widen(merged, "m", ["kind", "top", "k", "even"])


@query("""SELECT n_name AS sector_key, min(s_name) AS ticker FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE n_name <> 'NATION_3' GROUP BY 1""")
def reference_keys(spark, folder):
    """Each key once with the first ticker that has it; missing and empty keys are skipped."""
    info = tb.company_info(spark, folder)
    key = F.when(F.col("industry") != "NATION_3", F.col("industry")).otherwise(F.lit(""))
    keyed = info.select("ticker", key.alias("sector_key"))
    return snapshots.reference_keys(keyed, "sector_key").select("sector_key", "ticker")


_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"


@query(_ORDERS)
def format_round_trip(spark, folder):
    """Parquet to CSV and back."""
    start, text, back = (work_folder(spark, "convert") for _ in range(3))
    orders = tb.table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate").write.parquet(start)
    convert_files(spark, start, "parquet", text, "csv")
    convert_files(spark, text, "csv", back, "parquet")
    read = spark.read.parquet(back)
    return read.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
    )


@query("""SELECT event_id, event_type AS ticker, value, event_type AS key FROM events
    UNION ALL SELECT event_id + 1000000000, event_type, value, event_type FROM events""")
def raw_append(spark, folder):
    """A typed run and a run with an untyped column, landed side by side and read as one."""
    root = work_folder(spark, "bronze")
    events = tb.table(spark, folder, "events").select("event_id", F.col("event_type").alias("ticker"), "value")
    save_raw(events, root, "ticker", "events")
    second = events.withColumn("event_id", F.col("event_id") + 1_000_000_000).withColumn("note", F.lit(None))
    save_raw(second, root, "ticker", "events")
    both = read_bronze(spark, root, "ticker", "events")
    return both.select(
        F.col("event_id").cast("bigint").alias("event_id"), "ticker", F.col("value").cast("double").alias("value"), "key"
    )


@query("SELECT event_id, event_type AS ticker, value FROM events")
def glob_scan(spark, folder):
    """Every file of a kind below a folder tree, other kinds left out."""
    root = work_folder(spark, "lake")
    events = tb.table(spark, folder, "events").select("event_id", F.col("event_type").alias("ticker"), "value")
    events.write.parquet(f"{root}/a/prices")
    events.write.json(f"{root}/b/other")
    return scan_files(spark, root, "*.parquet")


@query(f"SELECT ticker, max(date) AS last_date, CAST(count(*) AS BIGINT) AS rows FROM ({tb.BARS_TYPE}) GROUP BY 1")
def prices_landed_once(spark, folder):
    """Landing the same prices twice appends nothing the second time."""
    root = work_folder(spark, "bronze")
    bars = tb.bars_by_type(spark, folder).select(F.col("date").alias("Date"), F.col("close").alias("Close"), "ticker")
    land_prices(bars.where(F.year("Date") < 1999), root)
    land_prices(bars, root)
    land_prices(bars, root)
    landed = read_bronze(spark, root, "ticker", "prices")
    return landed.groupBy("ticker").agg(F.max("Date").alias("last_date"), F.count(F.lit(1)).alias("rows"))


@query(f"""SELECT b.ticker, date, open, high, low, close, volume, sector, industry FROM ({tb.BARS_SUPPLIER}) b
    JOIN ({tb.MASTER}) m ON b.ticker = m.ticker""")
def per_ticker_export(spark, folder):
    """One folder per ticker, copies removed, sector and industry added; read back whole."""
    path = work_folder(spark, "tickers")
    bars = tb.bars_by_supplier(spark, folder)
    copies = bars.where(F.dayofmonth("date") == 1)
    export_per_ticker(bars.unionAll(copies), tb.master(spark, folder), path)
    schema = "ticker string, date date, open double, high double, low double, close double, volume bigint, sector string, industry string"
    return read_per_ticker(spark, path, schema)


@query("""SELECT 'bronze' AS stage, CAST((SELECT count(*) FROM events) AS BIGINT) AS rows, CAST(1 AS BIGINT) AS files
    UNION ALL SELECT 'silver', CAST((SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) AS BIGINT), 2""")
def lake_row_counts(spark, folder):
    silver = spark.read.parquet(f"{folder}/orders.parquet", f"{folder}/lineitem.parquet")
    return profile.stage_counts({"bronze": tb.table(spark, folder, "events"), "silver": silver})


@query("""SELECT count(*) AS rows, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date,
    count(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey_nulls,
    count(*) FILTER (WHERE o_orderdate IS NULL) AS o_orderdate_nulls,
    count(*) FILTER (WHERE o_orderstatus = 'P') AS status_nulls FROM orders""")
def profile_columns(spark, folder):
    """Row count, date range and missing values; the date column is found by name."""
    orders = tb.table(spark, folder, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("o_orderdate"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
    )
    return profile.profile(orders)


@query("SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_quantity LIMIT 5")
def preview(spark, folder):
    return profile.preview(tb.table(spark, folder, "lineitem"), 5, tb.TRADE_ORDER)


@query("""SELECT 'stage.log' AS file, unnest(string_split(replace(text, chr(13), ''), chr(10))) AS line FROM conversations""")
def log_lines(spark, folder):
    """Text logs, a row per line with the file it came from (part names reduced to one)."""
    root = work_folder(spark, "logs")
    texts = tb.table(spark, folder, "conversations").select(F.replace("text", F.lit("\r"), F.lit("")).alias("value"))
    texts.write.text(root)
    lines = read_log_lines(spark, root, "*.txt")
    return lines.withColumn("file", F.regexp_replace("file", "^part-.*txt$", "stage.log"))
