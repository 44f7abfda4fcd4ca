import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotelake.functions.rolling import rolling_mean
from quotelake.operators import quantiles
from quotelake.operators.indicators import INDICATORS, compute_indicators, with_signals
from quotelake.operators.quantiles import exact_quantiles, order_key
from quotelake.operators.series import POSITION, chunked, in_chunk, unchunked, with_position
from quotelake.operators.sizing import materialised
from tests.conftest import plan


def bars(n, seed=0, tickers=("A", "B"), start="2001-01-01", step="2D"):
    """Interleaved random walks; the first ticker holds most rows."""
    rng = np.random.default_rng(seed)
    frames = []
    for i, t in enumerate(tickers):
        size = n if i == 0 else max(n // 5, 3)
        close = 100 + np.cumsum(rng.normal(0, 1, size))
        frames.append(
            pd.DataFrame({
                "ticker": t,
                "date": pd.date_range(start, periods=size, freq=step),
                "open": close,
                "high": close + rng.random(size),
                "low": close - rng.random(size),
                "close": close,
                "volume": rng.integers(1, 1000, size),
            })
        )
    return pd.concat(frames).sample(frac=1, random_state=1).reset_index(drop=True)


def by_definition(pdf):
    """Each indicator of each bar, computed afresh from the bars its definition looks at."""
    out = pdf.sort_values(["ticker", "date"]).reset_index(drop=True)
    found = {name: np.full(len(out), np.nan) for name in INDICATORS}
    for _, rows in out.groupby("ticker").indices.items():
        close, span = out["close"].to_numpy()[rows], (out["high"] - out["low"]).to_numpy()[rows]

        def window(values, k, n):
            """The n values up to k, if there are as many and none is missing."""
            own = values[max(0, k - n + 1) : k + 1]
            return own if len(own) == n and not np.isnan(own).any() else None

        def smoothed(k, n):
            # weights fall by the same factor with each bar of age; the missing ones have none
            own = close[: k + 1]
            weights = np.where(np.isnan(own), 0.0, (1 - 2 / (n + 1)) ** np.arange(k, -1.0, -1.0))
            return (weights * np.nan_to_num(own)).sum() / weights.sum()

        steps = np.concatenate(([np.nan], close[1:] - close[:-1]))
        for k, row in enumerate(rows):
            for name, values, n in (("sma_20", close, 20), ("sma_50", close, 50), ("atr", span, 14)):
                own = window(values, k, n)
                if own is not None:
                    found[name][row] = own.sum() / n
            own = window(close, k, 20)
            if own is not None:
                width = 2 * np.sqrt(((own - own.mean()) ** 2).sum() / 19)
                found["bb_upper"][row], found["bb_lower"][row] = own.mean() + width, own.mean() - width
            found["macd"][row] = smoothed(k, 12) - smoothed(k, 26)
            own = window(steps, k, 14)
            gains, losses = (0.0, 0.0) if own is None else (own[own > 0].sum(), -own[own < 0].sum())
            found["rsi"][row] = 50.0 if losses == 0 else 100 * gains / (gains + losses)
    return out.assign(**found)


def compared(spark, pdf, **kwargs):
    done = compute_indicators(spark.createDataFrame(pdf), digits=None, **kwargs).toPandas()
    return by_definition(pdf), done.sort_values(["ticker", "date"]).reset_index(drop=True)


@pytest.mark.parametrize("n", [1, 13, 14, 20, 21, 700])
def test_indicators_by_definition(spark, n):
    want, got = compared(spark, bars(n))
    assert len(want) == len(got)
    for c in INDICATORS:
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), rtol=0, atol=1e-9, err_msg=c)


def test_long_series_crosses_chunks(spark):
    want, got = compared(spark, bars(3000, tickers=("A",), step="1D", start="1990-01-01"))
    for c in INDICATORS:
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), rtol=0, atol=1e-8, err_msg=c)


def test_missing_close_inside_a_window(spark):
    pdf = bars(90, tickers=("A",))
    pdf.loc[pdf["date"].rank() == 40, "close"] = np.nan
    want = by_definition(pdf)
    df = spark.createDataFrame(pdf).withColumn("close", F.when(~F.isnan("close"), F.col("close")))
    got = compute_indicators(df, digits=None).toPandas().sort_values("date").reset_index(drop=True)
    for c in ("sma_20", "sma_50", "macd", "bb_upper"):
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), atol=1e-9, err_msg=c)


@pytest.mark.parametrize("steps, expected", [(0.0, 50.0), (1.0, 50.0), (-1.0, 0.0)])
def test_rsi_edges(spark, steps, expected):
    pdf = bars(30, tickers=("A",)).sort_values("date")
    pdf["close"] = 100 + steps * np.arange(30)
    got = compute_indicators(spark.createDataFrame(pdf)).orderBy("date").toPandas()["rsi"]
    assert (got[:14] == 50).all() and (got[14:] == expected).all()


def test_rounded_set_and_signals(spark):
    done = compute_indicators(spark.createDataFrame(bars(60)))
    pdf = with_signals(done).toPandas()
    for c in (*INDICATORS, "close", "high"):
        assert np.allclose(pdf[c].dropna() * 100, np.round(pdf[c].dropna() * 100))
    assert set(pdf["rsi_zone"]) <= {"overbought", "oversold", "neutral"}
    assert ((pdf["macd"] >= 0) == (pdf["macd_sign"] == "positive")).all()


def test_result_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(bars(300))
    a = compute_indicators(df.repartition(1)).toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)
    b = compute_indicators(df.repartition(7)).toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(a[sorted(a)], b[sorted(b)])


def test_plan_keeps_a_series_out_of_one_task(spark):
    text = plan(compute_indicators(spark.createDataFrame(bars(30))))
    assert "Python" not in text and "SinglePartition" not in text
    # The only window over a bare ticker runs on block counts, not on bars.
    whole = [line for line in text.splitlines() if "Exchange hashpartitioning(ticker#" in line and ", _" not in line]
    assert len(whole) == 1


def test_positions_and_small_chunks(spark):
    pdf = bars(100, tickers=("A", "B"))
    df = spark.createDataFrame(pdf)
    got = with_position(df).toPandas().sort_values(["ticker", "date"])
    assert (got[POSITION] == got.groupby("ticker").cumcount()).all()
    cut = unchunked(chunked(df, lookback=4, rows=8).withColumn("m", rolling_mean(F.col("close"), 5, in_chunk())))
    got = cut.toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)
    want = pdf.sort_values(["ticker", "date"]).reset_index(drop=True)
    want = want.groupby("ticker")["close"].transform(lambda x: x.rolling(5).mean())
    assert len(got) == len(pdf)
    np.testing.assert_allclose(got["m"], want, atol=1e-9)


def test_fine_grained_feed_uses_finer_blocks(spark):
    pdf = bars(500, tickers=("A",), step="1min")
    got = with_position(spark.createDataFrame(pdf), grain="hour").toPandas().sort_values("date")
    assert (got[POSITION].to_numpy() == np.arange(500)).all()


def test_chunk_shorter_than_lookback_is_refused(spark):
    with pytest.raises(ValueError):
        chunked(spark.createDataFrame(bars(5)), lookback=9, rows=8)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0, 1.0000001, -3.5]), st.none()), min_size=1, max_size=60
    )
)
def test_quantiles_against_numpy(spark, values):
    rows = [("g" if i % 3 else "h", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g string, x double")
    probabilities = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    present = [v for v in values if v is not None]
    got = exact_quantiles(df, "x", probabilities).head()
    if present:
        want = np.quantile(np.array(present), list(probabilities.values()))
        np.testing.assert_allclose([got[k] for k in probabilities], want, rtol=1e-12, atol=1e-9)
    else:
        assert tuple(got) == (None,) * 5
    for r in exact_quantiles(df, "x", {"c": 0.5}, ["g"]).collect():
        own = [v for g, v in rows if g == r["g"] and v is not None]
        np.testing.assert_allclose(r["c"], np.median(own), rtol=1e-12, atol=1e-9)


def test_quantiles_of_a_hot_value(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 5.0).otherwise(F.col("id") / 7.0).alias("x"))
    x = df.toPandas()["x"]
    got = exact_quantiles(df, "x", {"a": 0.01, "b": 0.4, "c": 0.99}).head()
    np.testing.assert_allclose(tuple(got), np.quantile(x, [0.01, 0.4, 0.99]))


def test_order_keys(spark):
    tiny = 5e-324
    values = [-np.inf, -1.7976931348623157e308, -2.0, -np.nextafter(2.0, 0), -1.0, -2.3e-308, -tiny, 0.0, tiny, 3 * tiny, 2.2250738585072014e-308]
    values += [np.nextafter(2.2250738585072014e-308, 0), 1e-300, 0.1, np.nextafter(1.0, 0), 1.0, np.nextafter(1.0, 2), 3.0, 8.0, np.nextafter(8.0, 0), 1e300, np.inf, np.nan]
    values += [float(2.0**e) for e in range(-1074, 1024, 7)] + [float(np.nextafter(2.0**e, 0)) for e in range(-1000, 1024, 7)]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", order_key(F.col("v")).alias("k"))
    rows = df.collect()
    by_key = [r["v"] for r in sorted(rows, key=lambda r: r["k"])]
    assert str(by_key) == str([float(v) for v in np.sort(np.array(values))])
    assert len({r["k"] for r in rows}) == len({str(r["v"]) for r in rows})


@pytest.mark.parametrize("kind", ["tiny", "geometric", "near_equal", "one", "both_signs"])
def test_no_ordered_step_is_long(spark, monkeypatch, kind):
    """Whatever the values, what is put in order is cells: at most 65536 of a prefix, and four rounds."""
    random = np.random.default_rng(3)
    values = {
        "tiny": random.random(20_000) * 1e-9,
        "geometric": 2.0 ** random.uniform(-900, 900, 20_000),
        "near_equal": 100 + random.integers(0, 20_000, 20_000) * 1.4e-14,
        "one": np.full(20_000, 7.25),
        "both_signs": random.standard_cauchy(20_000),
    }[kind]
    stored = []

    def counted(df, purpose):
        done = materialised(df, purpose)
        stored.append(df._jdf.queryExecution().executedPlan().toString())
        return done

    monkeypatch.setattr(quantiles, "materialised", counted)
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(4)
    probabilities = {"a": 0.0, "b": 0.013, "c": 0.5, "d": 0.9, "e": 1.0}
    got = exact_quantiles(df, "x", probabilities).head()
    np.testing.assert_allclose(tuple(got), np.quantile(values, list(probabilities.values())), rtol=1e-15)
    assert len(stored) == (1 if kind == "one" else len(stored)) <= 4
    # windows run over counted cells only
    assert all("Window" in text and text.index("Window") < text.index("HashAggregate") for text in stored)
    cells = df.select((F.shiftright(order_key(F.col("x")), 48)).alias("c")).distinct().count()
    assert cells <= 65_536


def test_frames_of_indicators_are_short(spark):
    """A frame is gone through for each row."""
    empty = spark.createDataFrame([], "ticker string, date date, open double, high double, low double, close double, volume bigint")
    plan = compute_indicators(empty)._jdf.queryExecution().optimizedPlan().toString()
    frames = [int(n) for n in re.findall(r"RowFrame, -(\d+), currentrow", plan)]
    assert frames and max(frames) < 10
