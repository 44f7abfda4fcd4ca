"""Cleaning rules for raw daily bars."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.dates import to_utc
from quotelake.functions.numeric import to_number
from quotelake.operators.dedup import keep_first
from quotelake.operators.quantiles import exact_quantiles
from quotelake.operators.sizing import materialised

# The measures of a bar, and how many box widths a close may lie outside the box.
MEASURES = ("Open", "High", "Low", "Close", "Volume")
FENCE_WIDTHS = 3.0


def coerce_types(df: DataFrame, exchange_tz: str | None = None) -> DataFrame:
    """Measures to double and the date to a UTC timestamp; what cannot be read becomes NULL."""
    fields = {f.name.lower(): f for f in df.schema}
    changed: dict[str, Column] = {}
    for name in MEASURES:
        field = fields.get(name.lower())
        if field is not None:
            changed[field.name] = to_number(F.col(field.name), field.dataType)
    if "date" in fields:
        changed[fields["date"].name] = to_utc(F.col("date"), exchange_tz)
    return df.withColumns(changed)


def drop_missing(df: DataFrame, columns: Sequence[str] = ("close", "date")) -> DataFrame:
    return df.dropna(subset=list(columns))


def plausible_bars(df: DataFrame) -> DataFrame:
    """Keep bars whose high and low enclose open and close; a missing price fails."""
    return df.where(
        (F.col("high") >= F.col("low"))
        & (F.col("high") >= F.col("open"))
        & (F.col("high") >= F.col("close"))
        & (F.col("low") <= F.col("open"))
        & (F.col("low") <= F.col("close"))
    )


def price_fences(df: DataFrame, by: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Lower and upper fence of the close: three box widths below the first and above the third quartile."""
    if approximate:
        quartiles = df.groupBy(*by).agg(
            F.percentile_approx("close", 0.25, 100_000).alias("q1"),
            F.percentile_approx("close", 0.75, 100_000).alias("q3"),
        )
    else:
        quartiles = exact_quantiles(df, "close", {"q1": 0.25, "q3": 0.75}, by)
    width = (F.col("q3") - F.col("q1")) * FENCE_WIDTHS
    return quartiles.select(*by, (F.col("q1") - width).alias("lower_fence"), (F.col("q3") + width).alias("upper_fence"))


def within_fences(df: DataFrame, by: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Drop closes outside the fences (fence values stay).

    Without ``by`` the fences pool the whole batch and arrive as one scalar subquery; with ``by``
    each group has its own and the fence rows, stored and so of known size, are joined on.
    """
    fences = price_fences(df, by, approximate)
    if not by:
        both = fences.select(F.struct("lower_fence", "upper_fence")).scalar()
        return df.where((F.col("close") >= both["lower_fence"]) & (F.col("close") <= both["upper_fence"]))
    joined = df.join(materialised(fences, "fences"), list(by))
    return joined.where(F.col("close").between(F.col("lower_fence"), F.col("upper_fence"))).select(*df.columns)


def sound_bars(
    df: DataFrame, arrival: Sequence[str] = ("extraction_timestamp",), exchange_tz: str | None = None
) -> DataFrame:
    """Coerce, drop rows without close or date, keep the first copy of a bar, drop implausible bars.

    ``arrival`` orders copies of a bar; the measures break ties so the choice is repeatable.
    """
    typed = drop_missing(coerce_types(df, exchange_tz))
    once = keep_first(typed, ["date", "ticker"], [*arrival, "open", "high", "low", "close", "volume"])
    return plausible_bars(once)


def clean_prices(
    df: DataFrame,
    arrival: Sequence[str] = ("extraction_timestamp",),
    exchange_tz: str | None = None,
    fences_by: Sequence[str] = (),
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """All cleaning rules in order: sound bars, then the fences over them.

    The fences pass over the sound bars before they filter them. ``store`` (write and read back) lets jobs
    compute the sound bars once.
    """
    sound = sound_bars(df, arrival, exchange_tz)
    return within_fences(sound if store is None else store(sound), fences_by)
