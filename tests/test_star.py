import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotelake.functions.dates import date_from_parts
from quotelake.operators import constraints, star
from quotelake.operators.dedup import keep_first, keep_first_stored
from quotelake.operators.sizing import materialised
from quotelake.plans import gold
from quotelake.schemas import DIM_DATE, DIM_INDUSTRY, DIM_SECTOR, DIM_TICKER, FACT_PREDICTED, FACT_PRICES, FACT_TECHNICAL, GOLD_TABLES
from quotelake.sources.files import read_predictions
from quotelake.sources.sinks import create_tables
from tests.conftest import plan

D = dt.datetime


@pytest.fixture
def master(spark):
    return spark.createDataFrame(
        [("A", "Ay", "tech", "chips"), ("B", "Bee", "tech", "soft"), ("C", "Sea", None, "soft")],
        "ticker string, company_name string, sector string, industry string",
    )


def prices(spark, *data):
    ddl = "ticker string, date timestamp, year int, open double, high double, low double, close double, volume bigint, adj_close double"
    full = [(t, d, d and d.year, c, c, c, c, 10, c) for t, d, c in data]
    return spark.createDataFrame(full, ddl)


def technical(spark, *data):
    ddl = "ticker string, date timestamp, year int, sma_20 double, sma_50 double, atr double, rsi double, macd double, bb_upper double, bb_lower double"
    return spark.createDataFrame([(t, d, d.year, None, None, v, 50.0, v, v, v) for t, d, v in data], ddl)


def dims(master):
    return star.dim_ticker(master), star.dim_sector(master), star.dim_industry(master)


def test_dim_date(spark, rows):
    df = spark.createDataFrame([(D(2021, 1, 3, 4),), (D(2021, 1, 3, 5),), (D(2024, 12, 30),), (None,)], "date timestamp")
    assert rows(star.dim_date(df)) == [(20210103, 2021, 1, 1, 53, 3), (20241230, 2024, 4, 12, 1, 30)]


def test_add_dates_fills_every_part(spark, rows):
    old = star.dim_date(spark.createDataFrame([(D(2024, 1, 1),)], "date timestamp"))
    new = spark.createDataFrame([("2024-01-01",), ("2024-05-06",)], "date string")
    assert rows(star.add_dates(old, new)) == [(20240101, 2024, 1, 1, 1, 1), (20240506, 2024, 2, 5, 19, 6)]


def test_dimensions_keep_keys_and_follow_attributes(spark, master):
    known = star.dim_ticker(master.where("ticker <> 'A'"))
    before = {r["Symbol"]: r["TickerId"] for r in known.collect()}
    renamed = master.withColumn("company_name", F.upper("company_name")).where("ticker <> 'C'")
    after = {r["Symbol"]: r for r in star.dim_ticker(renamed, known).collect()}
    assert {s: after[s]["TickerId"] for s in before} == before
    assert after["A"]["TickerId"] == 3 and after["B"]["Name"] == "BEE" and after["C"]["Name"] == "Sea"


def test_facts(spark, rows, master):
    p = prices(
        spark, ("A", D(2024, 1, 2, 5), 1.25), ("A", D(2024, 1, 2, 4), 1.0), ("B", D(2024, 1, 2), 2.0), ("Z", D(2024, 1, 2), 3.0), ("C", D(2024, 1, 2), 4.0)
    )
    t, s, i = dims(master)
    facts = star.fact_prices(p, star.ticker_keys(t, s, i))
    ids = {r["Symbol"]: r["TickerId"] for r in t.collect()}
    # Unknown tickers and tickers without a sector are left out; the earliest bar of a day wins.
    assert {(r["TickerId"], float(r["ClosePrice"])) for r in facts.collect()} == {(ids["A"], 1.0), (ids["B"], 2.0)}
    assert [f.dataType for f in facts.schema] == [f.dataType for f in FACT_PRICES.schema]
    assert facts.columns == FACT_PRICES.schema.fieldNames()
    tech = star.fact_technical(technical(spark, ("A", D(2024, 1, 2), 1.5)), star.ticker_keys(t, s, i))
    assert tech.columns == FACT_TECHNICAL.schema.fieldNames() and tech.count() == 1


def test_star_joins_broadcast_checked_dimensions(spark, master):
    p = prices(spark, ("A", D(2024, 1, 2), 1.0))
    t, s, i = dims(master)
    joined = star.denormalised(star.fact_prices(p, star.ticker_keys(t, s, i)), star.dim_date(p), t, s, i)
    assert plan(joined).count("BroadcastHashJoin") >= 4
    row = joined.head()
    assert (row["DateKey"], row["Symbol"], row["Name"], row["Sector"], row["Industry"]) == (
        dt.date(2024, 1, 2),
        "A",
        "Ay",
        "tech",
        "chips",
    )


def test_day_of_the_star_is_made_per_date_and_not_per_fact(spark, master):
    p = prices(spark, ("A", D(2024, 1, 2), 1.0), ("B", D(2024, 1, 2), 2.0))
    t, s, i = dims(master)
    joined = star.denormalised(star.fact_prices(p, star.ticker_keys(t, s, i)), star.dim_date(p), t, s, i)
    # What stands before the first broadcast runs on facts: the joins and the output, with no text of a date.
    on_facts = plan(joined).split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in on_facts and "DateKey" in on_facts and "format_string" not in on_facts


def test_date_from_parts(spark):
    df = spark.createDataFrame([(2024, 2, 29), (2023, 2, 29), (None, 1, 1)], "y int, m int, d int")
    assert [r[0] for r in df.select(date_from_parts(F.col("y"), F.col("m"), F.col("d"))).collect()] == [
        dt.date(2024, 2, 29),
        None,
        None,
    ]


def test_gold_refresh_twice_and_one_ticker_batch(spark, rows, master, tmp_path):
    root = str(tmp_path / "gold")
    day1, day2 = D(2024, 1, 2), D(2024, 1, 3)
    p = prices(spark, ("A", day1, 1.0), ("B", day1, 2.0), ("A", day2, 3.0))
    t = technical(spark, ("A", day1, 1.0))
    assert gold.refresh_gold(spark, root, p, t, master)
    first = rows(gold.read_gold(spark, root, FACT_PRICES))
    assert gold.refresh_gold(spark, root, p, t, master)
    assert rows(gold.read_gold(spark, root, FACT_PRICES)) == first and len(first) == 3
    ids = rows(gold.read_gold(spark, root, DIM_TICKER))
    one = prices(spark, ("A", day1, 9.0))
    gold.refresh_gold(spark, root, one, t.limit(0), master)
    assert gold.read_gold(spark, root, FACT_PRICES).count() == 3
    assert rows(gold.read_gold(spark, root, DIM_TICKER)) == ids
    gold.refresh_gold(spark, root, one, t.limit(0), master, slices=["DateId"])
    left = gold.read_gold(spark, root, FACT_PRICES)
    assert sorted((r["DateId"], float(r["ClosePrice"])) for r in left.collect()) == [(20240102, 9.0), (20240103, 3.0)]
    assert not gold.refresh_gold(spark, root, p.limit(0), t.limit(0), master)
    counts = gold.export_star(spark, root, str(tmp_path / "out"))
    assert counts == {"stock_prices_daily": 2, "technical_indicators_daily": 1}
    text = spark.read.option("header", "true").csv(str(tmp_path / "out" / "stock_prices_daily"))
    assert [r["ClosePrice"] for r in text.orderBy("DateKey").collect()] == ["9.0000", "3.0000"]
    log = spark.read.json(str(tmp_path / "out" / "export_log"))
    assert {(r["file"], r["rows"]) for r in log.collect()} == set(counts.items())


def test_prediction_import(spark, rows, master, tmp_path):
    root = str(tmp_path / "gold")
    gold.refresh_dimensions(spark, root, master, prices(spark, ("A", D(2024, 1, 2), 1.0)))
    csv = tmp_path / "in"
    csv.mkdir()
    (csv / "p.csv").write_text(
        "ticker,date,exportDate,sector,industry,close\n"
        "A,2024-02-01,2024-01-02,tech,chips,1.5\n"
        "A,2024-02-01,2024-01-02,tech,chips,1.7\n"
        "Z,2024-02-02,2024-01-02,tech,chips,1.5\n"
        "B,2024-02-02,2024-01-02,food,soft,1.5\n"
        "B,2024-02-02,2024-01-02,tech,iron,1.5\n"
        "B,nope,2024-01-02,tech,soft,1.5\n"
    )
    refused = gold.import_predictions(spark, root, read_predictions(spark, str(csv)))
    assert rows(refused, "reason", "copies") == [
        ("duplicate key", 1),
        ("unknown industry", 1),
        ("unknown sector", 1),
        ("unknown ticker", 1),
        ("unreadable date", 1),
    ]
    stored = gold.read_gold(spark, root, FACT_PREDICTED).collect()
    assert [(r["DateId"], r["PredictionDateId"], r["PredictedPrice"]) for r in stored] == [(20240201, 20240102, 1.5)]
    parts = {r["DateId"]: r["Quarter"] for r in gold.read_gold(spark, root, DIM_DATE).collect()}
    assert parts[20240201] == 1 and parts[20240202] == 1
    again = gold.import_predictions(spark, root, read_predictions(spark, str(csv)))
    assert again.where("reason = 'key exists'").agg(F.sum("copies")).head()[0] == 2
    assert gold.read_gold(spark, root, FACT_PREDICTED).count() == 1


def test_create_tables_and_append(spark, rows, tmp_path):
    root = str(tmp_path)
    assert create_tables(spark, root, GOLD_TABLES) == [t.name for t in GOLD_TABLES]
    assert create_tables(spark, root, GOLD_TABLES) == []
    batch = spark.createDataFrame(
        [(1, "AAA", "n", "s", "i"), (2, "MUCHTOOLONGSYMBOL", "n", "s", "i"), (None, "B", "n", "s", "i")], DIM_TICKER.schema
    )
    assert rows(gold.append_rows(batch, root, DIM_TICKER), "reason") == [("missing: TickerId",), ("too long: Symbol",)]
    assert rows(gold.append_rows(batch, root, DIM_TICKER).where("TickerId = 1"), "reason") == [("key exists",)]
    assert rows(gold.read_gold(spark, root, DIM_TICKER), "Symbol") == [("AAA",)]


def test_checked_fact_load(spark, rows, master, tmp_path):
    root = str(tmp_path / "gold")
    p = prices(spark, ("A", D(2024, 1, 2), 1.0), ("A", D(2024, 1, 2), 7.0), ("Z", D(2024, 1, 2), 2.0), ("B", None, 3.0), ("B", D(2024, 1, 3), 4.0))
    gold.refresh_dimensions(spark, root, master, p)
    lookup = star.ticker_keys(*(gold.read_gold(spark, root, s) for s in (DIM_TICKER, DIM_SECTOR, DIM_INDUSTRY)))
    counts = gold.load_facts(star.shaped_prices(p, lookup), root, FACT_PRICES)
    assert counts == {"inserted": 2, "missing: DateId": 1, "missing: TickerId": 1, "duplicate key": 1}
    assert sorted(float(r["ClosePrice"]) for r in gold.read_gold(spark, root, FACT_PRICES).collect()) == [1.0, 4.0]
    refused = spark.read.parquet(f"{root}/refused/{FACT_PRICES.name}")
    assert sorted((r["reason"], float(r["ClosePrice"])) for r in refused.collect()) == [("missing: DateId", 3.0), ("missing: TickerId", 2.0)]
    log = spark.read.json(f"{root}/load_log")
    assert {(r["outcome"], r["rows"]) for r in log.collect()} == set(counts.items())


def test_rules_in_order(spark):
    df = spark.createDataFrame([(1, "AAA", "n", "s", "i"), (None, "MUCHTOOLONGSYMBOL", "n", "s", "i"), (2, "MUCHTOOLONGSYMBOL", "n" * 300, "s", "i")], DIM_TICKER.schema)
    passed, refused, counts = constraints.split_stored(df, DIM_TICKER)
    assert passed.columns == df.columns and [r["TickerId"] for r in passed.collect()] == [1]
    assert counts == {"missing: TickerId": 1, "too long: Symbol": 1} and refused.count() == 2


def test_repeated_keys_only_are_put_in_order(spark, rows):
    data = [(k, k % 3, float(k), str(k)) for k in range(50)] + [(7, 1, 3.0, "x"), (7, 1, 2.0, "y"), (None, 1, 5.0, "z"), (None, 1, 4.0, "z")]
    df = materialised(spark.createDataFrame(data, "a int, b int, x double, s string"), "rows")
    got = keep_first_stored(df, ["a", "b"], ["x", "s"])
    assert rows(got) == rows(keep_first(df, ["a", "b"], ["x", "s"]))
    single = df.where("a is not null and a <> 7")
    assert "Aggregate" not in plan(keep_first_stored(materialised(single), ["a", "b"], ["x"]))
