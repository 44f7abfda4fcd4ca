"""Registration of queries and small helpers their SQL shares."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.functions.numeric import round_fractions
from quotelake.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, digits: int | None = None) -> Callable[[Query], Query]:
    """Register a function under its name. ``digits`` rounds floating columns, as ``rounded`` does in SQL."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(prepare(spark), folder)
            money = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
            df = df.withColumns({c: F.col(c).cast("double") for c in money}) if money else df
            return df if digits is None else round_fractions(df, digits)

        run.__doc__ = fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def rounded(expression: str, digits: int = 4) -> str:
    scale = f"1e{digits}"
    return f"(round_even(({expression}) * {scale}, 0) / {scale} + 0.0)"


def rounded_as(digits: int, **columns: str) -> str:
    return ", ".join(f"{rounded(e, digits)} AS {n}" for n, e in columns.items())
