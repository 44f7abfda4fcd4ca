import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quotelake.functions.text import magnitude
from quotelake.operators import analytics, reports, series
from quotelake.operators.indicators import compute_indicators
from quotelake.operators.tables import technical_indicators
from quotelake.plans import reports as report_plan
from tests.test_series import bars


@pytest.fixture(scope="module")
def pdf():
    return bars(800, tickers=("A", "B", "C"), step="3D").sort_values(["ticker", "date"]).reset_index(drop=True)


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf).repartition(3)


def test_describe(df, pdf):
    want = pdf.groupby("ticker")["close"].describe()
    got = analytics.describe_close(df).toPandas().set_index("ticker").sort_index()
    np.testing.assert_allclose(got.to_numpy(float), want.to_numpy(float), rtol=1e-9)


def test_returns_volatility_and_peaks(df, pdf):
    ret = pdf.groupby("ticker")["close"].pct_change(fill_method=None)
    got = analytics.with_returns(df).toPandas().sort_values(["ticker", "date"])
    np.testing.assert_allclose(got["ret"].to_numpy(float), ret.to_numpy(), rtol=1e-12)
    vol = analytics.return_volatility(df).toPandas().set_index("ticker")["volatility"].sort_index()
    np.testing.assert_allclose(vol, ret.groupby(pdf["ticker"]).std(), rtol=1e-9)
    peak = analytics.with_running_peak(df).toPandas().sort_values(["ticker", "date"])["peak"]
    np.testing.assert_array_equal(peak.to_numpy(), pdf.groupby("ticker")["close"].cummax().to_numpy())
    rolled = analytics.rolling_volatility(df).toPandas().sort_values(["ticker", "date"])["volatility"]
    want = ret.groupby(pdf["ticker"]).transform(lambda x: x.rolling(30).std()) * np.sqrt(252)
    np.testing.assert_allclose(rolled.to_numpy(float), want.to_numpy(), rtol=1e-8)


def test_zero_close_gives_no_return(spark):
    df = spark.createDataFrame([("A", "2024-01-0%d" % i, c) for i, c in ((1, 0.0), (2, 5.0), (3, 10.0))], "ticker string, date string, close double")
    got = analytics.with_returns(df.withColumn("date", F.col("date").cast("date"))).orderBy("date").collect()
    assert [r["ret"] for r in got] == [None, None, 1.0]


def test_return_after_a_missing_close(spark):
    data = [("2023-12-30", 4.0), ("2023-12-31", None), ("2024-01-01", 8.0), ("2024-01-02", 16.0)]
    df = spark.createDataFrame([("A", d, c) for d, c in data], "ticker string, date string, close double")
    got = analytics.with_returns(df.withColumn("date", F.col("date").cast("date"))).orderBy("date").collect()
    assert [r["ret"] for r in got] == [None, None, None, 1.0]


def test_summary(spark):
    """Five bars by hand: 100, 110, 99, 99, 148.5 give returns of +10 %, -10 %, 0 and +50 %."""
    closes, volumes = [100.0, 110.0, 99.0, 99.0, 148.5], [10, 20, 30, 40, 50]
    data = [("ENI.MI", f"2024-01-{k + 1:02d}", c, v) for k, (c, v) in enumerate(zip(closes, volumes, strict=True))]
    df = spark.createDataFrame(data, "ticker string, date string, close double, volume bigint").withColumn("date", F.col("date").cast("date"))
    row = reports.portfolio_summary(df).head()
    assert (row["days"], row["start_close"], row["end_close"], row["avg_volume"]) == (5, 100.0, 148.5, 30.0)
    assert row["total_return"] == pytest.approx(0.485) and row["max_drawdown"] == pytest.approx(-0.1)
    # mean 0.125; squares of the gaps: 0.000625, 0.050625, 0.015625, 0.140625; their sum over 3
    assert row["annual_volatility"] == pytest.approx((0.2075 / 3) ** 0.5 * 252**0.5)
    text = reports.summary_texts(reports.portfolio_summary(df)).head()
    assert (text["From"], text["To"], text["Total Return"], text["Max Drawdown"]) == ("2024-01-01", "2024-01-05", "48.5%", "-10.0%")


def test_normalised(df, pdf):
    got = reports.normalised_performance(df).toPandas().sort_values(["ticker", "date"])["indexed"]
    want = pdf.groupby("ticker")["close"].transform(lambda x: x / x.iloc[0] * 100)
    np.testing.assert_allclose(got, want)


def test_monthly_volume(spark, rows):
    data = [("ENI.MI", "2024-01-05", 10), ("ENI.MI", "2024-01-20", 30), ("ENI.MI", "2024-03-01", 7), ("B`C", "2024-02-02", 4)]
    df = spark.createDataFrame(data, "ticker string, date string, volume bigint").withColumn("date", F.col("date").cast("date"))
    wide = reports.monthly_volume(df)
    assert wide.columns == ["month", "B`C", "ENI.MI"]
    assert [tuple(r)[1:] for r in wide.orderBy("month").collect()] == [(0.0, 20.0), (4.0, 0.0), (0.0, 7.0)]
    long = {(str(r["month"])[:7], r["ticker"]): r["avg_volume"] for r in reports.monthly_volume_long(df).collect()}
    assert long == {
        ("2024-01", "B`C"): 0.0,
        ("2024-01", "ENI.MI"): 20.0,
        ("2024-02", "B`C"): 4.0,
        ("2024-02", "ENI.MI"): 0.0,
        ("2024-03", "B`C"): 0.0,
        ("2024-03", "ENI.MI"): 7.0,
    }


def pearson(x, y):
    x, y = np.array(x) - np.mean(x), np.array(y) - np.mean(y)
    return (x @ y) / np.sqrt((x @ x) * (y @ y))


def prices(spark, closes):
    """closes: ticker to one list of closes, or None, per day."""
    data = [(t, f"2024-01-{k + 1:02d}", float(c)) for t, own in closes.items() for k, c in enumerate(own) if c is not None]
    return spark.createDataFrame(data, "ticker string, date string, close double").withColumn("date", F.col("date").cast("date"))


def test_returns_correlation_with_gaps(spark):
    """Day 3 lacks B, so neither day 3 nor day 4 has all returns; the cell of day 6 that occurs twice is averaged."""
    df = prices(spark, {"ENI.MI": [10, 11, 12, 15, 12, 18, 9], "B": [20, 18, None, 27, 30, 28, 35]})
    df = df.where("not (ticker = 'B' and day(date) = 6)").union(prices(spark, {"B": [None] * 5 + [27]})).union(prices(spark, {"B": [None] * 5 + [29]}))
    a = [11 / 10 - 1, 12 / 15 - 1, 18 / 12 - 1, 9 / 18 - 1]
    b = [18 / 20 - 1, 30 / 27 - 1, 28 / 30 - 1, 35 / 28 - 1]
    got = {(r["ticker_a"], r["ticker_b"]): r["corr"] for r in analytics.returns_correlation(df).collect()}
    assert got.keys() == {("ENI.MI", "ENI.MI"), ("ENI.MI", "B"), ("B", "ENI.MI"), ("B", "B")}
    assert got["ENI.MI", "B"] == pytest.approx(pearson(a, b)) == got["B", "ENI.MI"]
    assert got["B", "B"] == pytest.approx(1.0)


@pytest.mark.parametrize("tickers", [6, 41, 120])
def test_flat_series_and_no_complete_date(spark, tickers):
    rng = np.random.default_rng(tickers)
    closes = {f"t{k}.X": (100 + rng.random(5)).tolist() for k in range(tickers)}
    closes["flat"] = [5.0] * 5
    got = {(r["ticker_a"], r["ticker_b"]): r["corr"] for r in analytics.returns_correlation(prices(spark, closes)).collect()}
    assert len(got) == (tickers + 1) ** 2
    assert all((corr is None) == ("flat" in pair) for pair, corr in got.items())
    assert got["t1.X", "t1.X"] == pytest.approx(1.0)
    closes["flat"] = [5.0, None, 5.0, None, 5.0]
    assert all(r["corr"] is None for r in analytics.returns_correlation(prices(spark, closes)).collect())


@pytest.mark.parametrize("columns", [3, 45])
def test_correlation_matrix_of_any_width(spark, columns):
    rng = np.random.default_rng(0)
    data = rng.random((40, columns))
    data[:, 1] = 7.0
    names = [f"c.{i}" for i in range(columns)]
    rows = [tuple(map(float, r)) for r in data] + [(None, *[1.0] * (columns - 1))]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names))
    got = {(r["a"], r["b"]): r["corr"] for r in analytics.correlation_matrix(df, names).collect()}
    assert len(got) == columns**2
    for i in range(columns):
        for j in range(columns):
            want = None if 1 in (i, j) else pytest.approx(pearson(data[:, i], data[:, j]))
            assert got[names[i], names[j]] == want
    assert all(r["corr"] is None for r in analytics.correlation_matrix(df.limit(0), names).collect())


def test_indicator_correlation(df):
    tech = compute_indicators(df, digits=None)
    want = tech.select(*analytics.INDICATOR_COLUMNS).toPandas().astype(float).dropna().corr()
    got = analytics.indicator_correlation(tech).toPandas()
    got = got.pivot(index="indicator_a", columns="indicator_b", values="corr").loc[want.index, want.columns]
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy(), atol=1e-9)


def test_panel_keeps_bars_without_indicators(df):
    tech = compute_indicators(df).where("ticker = 'A'")
    panel = reports.indicator_panel(df, tech)
    assert panel.count() == df.count()
    assert panel.where("ticker <> 'A' and (rsi_zone is not null or macd_sign is not null)").isEmpty()


def test_entitlement(spark, rows):
    report = spark.createDataFrame([("volume", 1), ("technical_indicators", 2), ("other", 3)], "section string, v int")
    allowed = reports.permissions(report)
    assert rows(reports.visible_rows(report, allowed, "basic"), "v") == [(1,)]
    assert rows(reports.visible_rows(report, allowed, "advanced"), "v") == [(1,), (2,)]
    access = {(r["section"], r["role"]): r["access"] for r in reports.section_access(report, allowed).collect()}
    assert access[("technical_indicators", "basic")] == "locked"
    assert access[("technical_indicators", "advanced")] == "visible"
    assert access[("other", "advanced")] == "locked"
    with pytest.raises(ValueError):
        reports.visible_rows(report, allowed, "guest")


def test_magnitudes(spark):
    df = spark.createDataFrame([(1.25e9,), (-5.6e6,), (7800.0,), (12.4,), (None,)], "x double")
    assert [r[0] for r in df.select(magnitude(F.col("x"))).collect()] == ["1.3B", "-6M", "8K", "12", None]


@pytest.mark.parametrize("scaled", [False, True])
def test_clusters_separate_obvious_groups(spark, scaled):
    data = [(f"t{i}", float(10 ** (i % 3 + 1)), 100.0 * 10 ** (i % 3)) for i in range(12)]
    df = spark.createDataFrame(data, "ticker string, close double, volume double")
    got = {r["ticker"]: r["cluster"] for r in analytics.cluster_tickers(df, scaled=scaled).collect()}
    groups = [{got[f"t{i}"] for i in range(k, 12, 3)} for k in range(3)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3
    assert analytics.cluster_centres(analytics.cluster_tickers(df, scaled=scaled)).count() == 3


@pytest.mark.parametrize("tile", [1, 3, 64])
def test_tiles_do_not_change_the_correlation(spark, tile):
    rng = np.random.default_rng(tile)
    wide = pd.DataFrame(100 + np.cumsum(rng.normal(0, 1, (60, 11)), axis=0), columns=[f"t{k}" for k in range(11)], index=pd.date_range("2020-01-20", periods=60))
    long = wide.rename_axis("date").reset_index().melt("date", var_name="ticker", value_name="close")
    want = wide.pct_change().corr()
    got = analytics.returns_correlation(spark.createDataFrame(long).repartition(3), tile=tile).collect()
    assert len(got) == 121
    for r in got:
        assert r["corr"] == pytest.approx(want.loc[r["ticker_a"], r["ticker_b"]], abs=1e-9)


def test_a_tick_feed_makes_no_large_block(spark):
    """All rows in one ticker and year, most of them in one second."""
    rng = np.random.default_rng(5)
    second = pd.date_range("2020-03-01 10:00:00", periods=3000, freq="300us")
    hours = pd.date_range("2020-05-01", periods=500, freq="7min")
    pdf = pd.DataFrame({"ticker": "A", "date": second.append(hours), "close": 50 + rng.random(3500), "volume": 1})
    ticks = spark.createDataFrame(pdf).repartition(5)
    blocked = series.with_sized_block(ticks, rows=100)
    sizes = [r["count"] for r in blocked.groupBy("ticker", series.BLOCK).count().collect()]
    assert sum(sizes) == 3500 and max(sizes) <= 100
    got = analytics.with_returns(ticks, rows=100).toPandas().sort_values("date")["ret"]
    np.testing.assert_allclose(got.to_numpy(float), pdf["close"].pct_change().to_numpy(), rtol=1e-12)
    fall = (pdf["close"] / pdf["close"].cummax() - 1).min()
    assert analytics.drawdowns(ticks, rows=100).head()["max_drawdown"] == pytest.approx(fall, rel=1e-12)
    found = reports.portfolio_summary(ticks, rows=100).head()
    assert found["days"] == 3500 and found["max_drawdown"] == pytest.approx(fall, rel=1e-12)
    assert found["annual_volatility"] == pytest.approx(pdf["close"].pct_change().std() * np.sqrt(252), rel=1e-9)
    indexed = reports.normalised_performance(ticks, rows=100).toPandas().sort_values("date")["indexed"]
    np.testing.assert_allclose(indexed.to_numpy(), (pdf["close"] / pdf["close"][0] * 100).to_numpy(), rtol=1e-12)


def test_rows_of_one_moment_stay_together(spark):
    ticks = spark.range(50).selectExpr("'A' ticker", "timestamp '2020-01-01 00:00:00' date", "1.0D close")
    assert series.with_sized_block(ticks, rows=10).select(series.BLOCK).distinct().count() == 1
    assert series.with_sized_block(ticks.limit(0), rows=10).count() == 0


def test_report_job(spark, df, rows, tmp_path):
    root = str(tmp_path)
    prices, technical = df.select("ticker", "date", "close", "volume"), technical_indicators(compute_indicators(df))
    report_plan.write_report(prices, technical, root)
    assert report_plan.sections_of(spark, root, "basic") == list(reports.BASIC_SECTIONS)
    assert set(report_plan.sections_of(spark, root, "advanced")) == set(report_plan.SECTIONS)
    with pytest.raises(PermissionError, match="technical_indicators"):
        report_plan.read_section(spark, root, "technical_indicators", "basic")
    with pytest.raises(ValueError, match="guest"):
        report_plan.sections_of(spark, root, "guest")
    for section in report_plan.SECTIONS:
        stored = report_plan.read_section(spark, root, section, "advanced")
        assert stored.columns == report_plan.SECTIONS[section].fieldNames()
        if section not in ("volatility", "technical_indicators", "price_correlation", "indicator_correlation"):
            assert rows(stored) == rows(report_plan.section_rows(prices, technical, section))
    assert report_plan.read_section(spark, root, "technical_indicators", "advanced").count() == df.count()
