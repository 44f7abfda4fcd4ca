import numpy as np
import pandas as pd
import pytest

from quotelake.operators import state
from quotelake.operators.indicators import INDICATORS, compute_indicators
from quotelake.operators.sizing import materialised
from quotelake.plans import silver as job
from quotelake.schemas import PRICE_HISTORY, TECHNICAL
from quotelake.sources import commits
from quotelake.sources.files import read_table
from tests.test_jobs import landed
from tests.test_series import bars


def test_small_batches_equal_one_rebuild(spark):
    """Batches of 1 to 200 bars, tickers that pause and one that starts late, against all bars at once."""
    pdf = bars(420, tickers=("A", "B")).sort_values(["ticker", "date"])
    late = pdf[(pdf["ticker"] == "B")].assign(ticker="C")
    pdf = pd.concat([pdf, late.tail(90)])
    whole_bars = spark.createDataFrame(pdf)
    whole = compute_indicators(whole_bars, digits=None).toPandas()
    days = np.sort(pdf["date"].unique())
    cuts = [0, 200, 201, 203, 240, 330, len(days)]
    states, parts = spark.createDataFrame([], state.STATE).drop("bucket"), []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        part = pdf[pdf["date"].isin(days[a:b]) & ~((pdf["ticker"] == "A") & (k == 2))]
        if k == 3:  # what the ticker missed comes with the next batch
            part = pd.concat([part, pdf[pdf["date"].isin(days[cuts[2] : cuts[3]]) & (pdf["ticker"] == "A")]])
        batch = spark.createDataFrame(part, whole_bars.schema)
        parts.append(state.indicators_behind_state(batch, states, digits=None).toPandas())
        fresh = materialised(state.states_after(batch, states))
        states = materialised(fresh.unionByName(states.join(fresh.select("ticker"), "ticker", "left_anti").select(*fresh.columns)))
    both = pd.concat(parts).merge(whole, on=["ticker", "date"], suffixes=("", "_w"))
    assert len(both) == len(pdf)
    for c in INDICATORS:
        assert np.allclose(both[c].astype(float), both[f"{c}_w"].astype(float), rtol=0, atol=1e-9, equal_nan=True), c
    sizes = {r["ticker"]: len(r["tail"]) for r in states.collect()}
    assert sizes == {"A": 50, "B": 50, "C": 50}


def test_a_long_batch_goes_through_chunks(spark):
    pdf = bars(5200, tickers=("A",)).sort_values("date")
    whole = compute_indicators(spark.createDataFrame(pdf), digits=None).toPandas().sort_values("date")
    first, rest = spark.createDataFrame(pdf.head(300)), spark.createDataFrame(pdf.iloc[300:])
    states = materialised(state.states_after(first, spark.createDataFrame([], state.STATE).drop("bucket")))
    got = state.indicators_behind_state(rest, states, digits=None).toPandas().sort_values("date")
    for c in INDICATORS:
        assert np.allclose(got[c].astype(float), whole[c].iloc[300:].astype(float), rtol=0, atol=1e-9), c


def test_silver_runs_read_no_history(spark, tmp_path, monkeypatch):
    root, pdf = str(tmp_path), bars(160, tickers=("A", "B")).sort_values("date")
    days = np.sort(pdf["date"].unique())
    monkeypatch.setattr(job, "clean_prices", lambda df, **_: df.selectExpr("ticker", "Date as date", "Open as open", "High as high", "Low as low", "Close as close", "Volume as volume"))
    monkeypatch.setattr(job, "years_for_lookback", lambda *_: pytest.fail("history was read"))
    for a, b in ((0, 100), (100, 101), (101, 160)):
        assert job.refresh_silver(landed(spark, pdf[pdf["date"].isin(days[a:b])]), None, root)
    whole = compute_indicators(spark.createDataFrame(pdf), digits=2).toPandas()
    got = read_table(spark, f"{root}/technical_indicators", TECHNICAL).toPandas()
    both = got.merge(whole, on=["ticker", "date"], suffixes=("", "_w"))
    assert len(both) == len(pdf)
    for c in INDICATORS:
        assert np.allclose(both[c].astype(float), both[f"{c}_w"].astype(float), rtol=0, atol=0.0100001, equal_nan=True), c


def test_corrected_bars_make_the_state_anew(spark, tmp_path):
    root, pdf = str(tmp_path), bars(120, tickers=("A", "B")).sort_values("date")
    job.refresh_silver(landed(spark, pdf), None, root)
    fixed = pdf[pdf["ticker"] == "A"].tail(3).copy()
    fixed[["open", "high", "low", "close"]] += 1.0
    job.refresh_silver(landed(spark, fixed), None, root)
    states = {r["ticker"]: r for r in job.read_states(spark, f"{root}/indicator_state", spark.createDataFrame([("A",), ("B",)], "ticker string")).collect()}
    prices = read_table(spark, f"{root}/price_history", PRICE_HISTORY)
    again = {r["ticker"]: r for r in state.states_after(prices, spark.createDataFrame([], state.STATE).drop("bucket")).collect()}
    assert [t["close"] for t in states["A"]["tail"]] == [t["close"] for t in again["A"]["tail"]]
    assert states["A"]["closes_26"] == pytest.approx(again["A"]["closes_26"], rel=1e-12)
    assert states["B"]["last_date"] == again["B"]["last_date"]


def test_a_replayed_source_does_nothing(spark, tmp_path, monkeypatch):
    root, pdf = str(tmp_path), bars(60, tickers=("A",)).sort_values("date")
    assert job.refresh_prices(landed(spark, pdf), root, source="q:0")
    numbers = [commits.last_number(spark, f"{root}/{t}") for t in ("price_history", "technical_indicators", "indicator_state")]
    monkeypatch.setattr(job, "clean_prices", lambda *_, **__: pytest.fail("the batch was worked on"))
    assert not job.refresh_prices(landed(spark, pdf), root, source="q:0")
    assert numbers == [commits.last_number(spark, f"{root}/{t}") for t in ("price_history", "technical_indicators", "indicator_state")] == [1, 1, 1]
