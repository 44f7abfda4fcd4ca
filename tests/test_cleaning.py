import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.functions.numeric import blank_non_finite, round_half_even, to_number
from quotelake.operators.cleaning import clean_prices, coerce_types, plausible_bars, within_fences
from quotelake.operators.dedup import duplicate_counts, keep_first, keep_last, same_columns
from quotelake.operators.tables import price_history, stocks_master


def test_number_texts(spark):
    texts = ["12.5", " 2 ", "bad", "", None, "NaN", "Infinity", "-inf", "1.0d", "1e3", ".5", "0x10", "1_000"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(to_number(F.col("t"), T.StringType())).collect()]
    inf = float("inf")
    assert got == [12.5, 2.0, None, None, None, None, inf, -inf, None, 1000.0, 0.5, None, None]


def test_typed_nan_is_missing_and_integers_become_double(spark):
    df = spark.createDataFrame([(float("nan"), 3), (1.5, None)], "Close double, Volume bigint")
    assert [tuple(r) for r in coerce_types(df).collect()] == [(None, 3.0), (1.5, None)]


def test_dates_to_utc(spark):
    texts = ["2024-03-15 00:00:00-04:00", "xx", None, "2024-03-15 00:00:00+09:00"]
    df = spark.createDataFrame([(t,) for t in texts], "Date string")
    got = [r[0] for r in coerce_types(df).select(F.col("Date").cast("string")).collect()]
    assert got == ["2024-03-15 04:00:00", None, None, "2024-03-14 15:00:00"]
    local = coerce_types(df, "Asia/Tokyo").select(F.to_date("Date").cast("string")).collect()
    assert local[3][0] == "2024-03-15"


def test_plausible_bars(spark):
    bars = [
        ("high<low", 1.0, 1.0, 2.0, 1.0),
        ("high<open", 3.0, 2.0, 1.0, 1.5),
        ("high<close", 1.5, 2.0, 1.0, 3.0),
        ("low>open", 1.0, 3.0, 2.0, 2.5),
        ("low>close", 2.5, 3.0, 2.0, 1.0),
        ("equal", 2.0, 2.0, 2.0, 2.0),
        ("missing", None, 2.0, 1.0, 1.5),
    ]
    df = spark.createDataFrame(bars, "name string, open double, high double, low double, close double")
    assert [r["name"] for r in plausible_bars(df).collect()] == ["equal"]


@pytest.mark.parametrize("closes, kept", [([5.0] * 8, 8), ([7.0], 1), ([1.0, 2.0, 3.0, 4.0, 5.0, 100.0], 5)])
def test_fences(spark, closes, kept):
    df = spark.createDataFrame([("A", c) for c in closes], "ticker string, close double")
    assert within_fences(df).count() == kept
    assert within_fences(df, ["ticker"]).count() == kept


def test_value_on_a_fence_stays(spark):
    # Quartiles 1 and 2 put the upper fence at 5.
    closes = [1.0, 1.0, 1.0, 1.5, 2.0, 2.0, 5.0, 1.0, 2.0]
    df = spark.createDataFrame([(c,) for c in closes], "close double")
    assert within_fences(df).where("close = 5").count() == 1
    assert within_fences(df.withColumn("close", F.col("close") + F.when(F.col("close") == 5, 0.001).otherwise(0))).count() == 8


def test_fences_of_one_ticker_do_not_touch_another(spark):
    data = [("cheap", float(c)) for c in range(1, 40)] + [("dear", 1000.0 + c) for c in range(3)]
    df = spark.createDataFrame(data, "ticker string, close double")
    assert within_fences(df).where("ticker = 'dear'").count() == 0
    assert within_fences(df, ["ticker"]).where("ticker = 'dear'").count() == 3


@pytest.mark.parametrize("turn", [False, True])
def test_dedup_does_not_depend_on_row_order(spark, turn):
    data = [("A", 1, 10.0), ("A", 2, 20.0), ("A", None, 5.0), ("B", 1, 1.0)]
    df = spark.createDataFrame(data[::-1] if turn else data, "k string, at int, v double").repartition(3)
    assert {tuple(r) for r in keep_first(df, ["k"], ["at", "v"]).collect()} == {("A", None, 5.0), ("B", 1, 1.0)}
    assert {tuple(r) for r in keep_last(df, ["k"], ["at", "v"]).collect()} == {("A", 2, 20.0), ("B", 1, 1.0)}
    assert {tuple(r) for r in duplicate_counts(df, ["k"], ["k"]).collect()} == {("A", 2), ("B", 0)}


def test_dedup_combines_before_the_shuffle(spark):
    from tests.conftest import plan

    df = spark.createDataFrame([("A", 1, 10.0)], "k string, at int, v double")
    text = plan(keep_first(df, ["k"], ["at"]))
    assert "partial_min" in text and text.index("Exchange") < text.index("partial_min")


def test_dedup_needs_an_order(spark):
    with pytest.raises(ValueError):
        keep_first(spark.range(1), ["id"], [])


def test_same_columns(spark):
    a, b = same_columns(spark.range(1).selectExpr("id", "1 x"), spark.range(1).selectExpr("2 y", "1 x", "id"))
    assert a.columns == b.columns == ["x", "id"]


def test_clean_prices_end_to_end(spark):
    def row(day, close="10", high="11", stamp="t1", ticker="A"):
        return (day, "10", high, "9", close, "100", ticker, stamp)

    data = [row(f"2024-01-{d:02d}", close=str(9.5 + d * 0.05)) for d in range(1, 20)]
    data += [row("2024-01-05", close="10.5", stamp="t0")]  # earlier copy wins
    data += [row("2024-01-20", close="bad"), row("nope"), row("2024-01-21", high="1")]
    data += [row("2024-01-22", close="9999", high="10000")]
    df = spark.createDataFrame(
        data, "Date string, Open string, High string, Low string, Close string, Volume string, ticker string, extraction_timestamp string"
    )
    clean = clean_prices(df)
    assert clean.count() == 19
    assert clean.where("date = timestamp'2024-01-05'").head()["Close"] == 10.5


def test_rounding_like_numpy(spark):
    values = [0.125, 1.005, 1.015, 104.445, -0.125, -0.001, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half_even(F.col("x"))).collect()]
    assert got == [0.12, 1.0, 1.01, 104.44, -0.12, 0.0, None]
    assert str(got[5]) == "0.0"


def test_blank_non_finite(spark):
    inf = float("inf")
    df = spark.createDataFrame([(float("nan"), 1), (inf, 2), (-inf, 3), (1.0, 4), (None, 5)], "x double, n int")
    assert [r["x"] for r in blank_non_finite(df).collect()] == [None, None, None, 1.0, None]


def test_projections(spark):
    df = spark.createDataFrame(
        [("A", dt.datetime(2024, 5, 6, 4), 1.005, 2.0, 0.5, 1.015, 7.0, "x")],
        "ticker string, Date timestamp, Open double, High double, Low double, Close double, Volume double, other string",
    )
    out = price_history(df)
    assert out.columns == ["ticker", "date", "year", "open", "high", "low", "close", "volume", "adj_close"]
    assert tuple(out.head())[2:] == (2024, 1.0, 2.0, 0.5, 1.01, 7, 1.01)
    info = spark.createDataFrame([("A", "Ay", "s", "i")] * 2, "ticker string, longName string, sector string, industry string")
    assert [tuple(r) for r in stocks_master(info).collect()] == [("A", "Ay", "s", "i")]
